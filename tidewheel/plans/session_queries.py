"""Session messages: history, recent context, chat requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import inference_log, sessions
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query

PROMPT = "You answer questions about papers."
ORDERED_SQL = f"""{inputs.MESSAGES_SQL},
ordered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY created_at, id) AS position,
  row_number() OVER (PARTITION BY session_id ORDER BY created_at DESC, id DESC) AS back FROM messages)"""


@query("session_history", f"WITH {ORDERED_SQL} SELECT * EXCLUDE (back) FROM ordered")
def session_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.history(inputs.message_log(spark, sf_dir))


@query(
    "session_context_last_n",
    f"""WITH {ORDERED_SQL}
    SELECT id, session_id, created_at, role, content, row_number() OVER (PARTITION BY session_id ORDER BY created_at, id) AS position
    FROM ordered WHERE back <= 3""",
)
def session_context_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.last_messages(inputs.message_log(spark, sf_dir), 3)


def chat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat request JSON, one per user message."""
    asked = inputs.table(spark, sf_dir, "conversations").where("role = 'user'")
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    ids = F.struct(
        F.concat(F.lit("session-"), F.col("conv_id").cast("string")).alias("session_id"),
        F.concat_ws("-", F.lit("req"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("request_id"),
    )
    return asked.select("conv_id", "turn", F.to_json(F.struct(F.array(message).alias("input"), ids.alias("custom_inputs"))).alias("request"))


@query(
    "chat_request_parse",
    """SELECT conv_id, turn, 'session-' || conv_id AS session_id, 'req-' || conv_id || '-' || turn AS chat_request_id,
      CAST(0 AS INTEGER) AS position, role, text AS content FROM conversations WHERE role = 'user'""",
)
def chat_request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference_log.parse_chat(chat_requests(spark, sf_dir))


@query(
    "session_context",
    f"""WITH {ORDERED_SQL},
    requests AS (SELECT DISTINCT 'session-' || conv_id AS session_id FROM conversations WHERE role = 'user')
    SELECT session_id, 0 AS part, CAST(1 AS BIGINT) AS position, 'system' AS role, '{PROMPT}' AS content FROM requests
    UNION ALL SELECT session_id, 1, row_number() OVER (PARTITION BY session_id ORDER BY created_at, id), role, content
    FROM ordered WHERE back <= 3 AND session_id IN (SELECT session_id FROM requests)
    UNION ALL SELECT 'session-' || conv_id, 2, turn, role, text FROM conversations WHERE role = 'user'""",
)
def session_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System prompt, last three messages, then the request messages."""
    requests = inference_log.parse_chat(chat_requests(spark, sf_dir)).select(
        "session_id", F.col("turn").alias("position"), "role", "content"
    )
    return sessions.context(PROMPT, inputs.message_log(spark, sf_dir), requests, 3)


@query(
    "session_saved_turns",
    """SELECT 'session-' || conv_id AS session_id, turn, role, text AS content FROM conversations WHERE role IN ('user', 'assistant')""",
)
def session_saved_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request and output items of each call, saved together as messages and read back."""
    talk = inputs.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("session-"), F.col("conv_id").cast("string")).alias("session_id"), "turn", "role",
        sessions.to_message(F.col("role"), F.col("text")).alias("message_data"),
    )
    saved = sessions.turns_to_save(talk.where("role = 'user'"), talk.where("role = 'assistant'"))
    message = F.from_json("message_data", sessions.MESSAGE_SCHEMA)
    return saved.select("session_id", "turn", message["role"].alias("role"), message["content"].alias("content"))
