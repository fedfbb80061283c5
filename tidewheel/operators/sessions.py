"""Session messages: ordered history, recent context, sessions rebuilt from traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.operators import ranking

MESSAGE_SCHEMA = "struct<role: string, content: string>"


def to_message(role, content):
    return F.to_json(F.struct(role.alias("role"), content.alias("content")))


def read_messages(log: DataFrame) -> DataFrame:
    """Message rows with role and content out of their JSON."""
    message = F.from_json("message_data", MESSAGE_SCHEMA)
    return log.select("id", "session_id", "created_at", message["role"].alias("role"), message["content"].alias("content"))


def history(log: DataFrame, session_id: str | None = None) -> DataFrame:
    """Messages with their place in the session, by time and then id; one session when given."""
    rows = log if session_id is None else log.where(F.col("session_id") == session_id)
    return ranking.positions_by_key(read_messages(rows), ["session_id"], "created_at", "id", "position")


def last_messages(log: DataFrame, n: int) -> DataFrame:
    """The n newest messages per session, numbered oldest first."""
    newest = ranking.top_per_key(
        log, ["session_id"], [F.col("created_at").desc(), F.col("id").desc()], n, "_back"
    )
    place = Window.partitionBy("session_id").orderBy("created_at", "id")
    return read_messages(newest).withColumn("position", F.row_number().over(place).cast("long"))


def context(system_prompt: str, log: DataFrame, requests: DataFrame, n: int) -> DataFrame:
    """Model input per session: system prompt, last n messages, then the request messages.

    `requests` holds session_id, position, role, content. `part` and `position` give the order.
    """
    prompt = requests.select("session_id").distinct().select(
        "session_id", F.lit(0).alias("part"), F.lit(1).cast("long").alias("position"),
        F.lit("system").alias("role"), F.lit(system_prompt).alias("content"),
    )
    wanted = log.join(requests.select("session_id").distinct(), "session_id", "left_semi")
    past = last_messages(wanted, n).select("session_id", F.lit(1).alias("part"), "position", "role", "content")
    asked = requests.select("session_id", F.lit(2).alias("part"), F.col("position").cast("long").alias("position"), "role", "content")
    return prompt.unionByName(past).unionByName(asked)


def turns_to_save(request_items: DataFrame, output_items: DataFrame) -> DataFrame:
    """Request and output messages of a call, kept together for the session log."""
    return request_items.unionByName(output_items)


def rebuild(traces: DataFrame) -> DataFrame:
    """Traces with turn number in their session and seconds since the turn before."""
    placed = ranking.positions_by_key(traces, ["session_id"], "request_time", "trace_key", "turn", previous="_last_time")
    gap = F.unix_micros(F.col("request_time").cast("timestamp")) - F.unix_micros(F.col("_last_time").cast("timestamp"))
    return placed.withColumn("gap_seconds", gap / F.lit(1e6)).drop("_last_time")


def session_summary(rebuilt: DataFrame) -> DataFrame:
    return rebuilt.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("turns"), F.min("request_time").alias("first_time"),
        F.max("request_time").alias("last_time"), F.max("gap_seconds").alias("longest_gap_seconds"),
    )
