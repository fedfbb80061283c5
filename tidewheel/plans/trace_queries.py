"""Trace log: extraction, rollup, series, verdicts, review, sessions from traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import nested
from tidewheel.operators import sessions, traces
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.plans.monitoring_queries import rounded

VERDICTS_SQL = """
CASE WHEN labelled_id IS NULL THEN NULL WHEN words < 350 THEN 1 ELSE 0 END AS word_count_check,
CASE WHEN labelled_id IS NULL THEN NULL WHEN toxic = 0 THEN 1 ELSE 0 END AS polite_tone,
CASE WHEN labelled_id IS NULL THEN NULL WHEN quality = 1 THEN 1 ELSE 0 END AS hook_in_post"""

ROLLED_SQL = f"""{inputs.TRACES_SQL},
span_sums AS (
  SELECT trace_id, count(*) FILTER (WHERE name = 'call_llm') AS llm, count(*) FILTER (WHERE name = 'execute_tool') AS tools,
    CAST(coalesce(sum(i * k) FILTER (WHERE name = 'call_llm'), 0) AS BIGINT) AS tokens FROM spans GROUP BY trace_id),
rolled AS (
  SELECT trace_id, request_time, request_preview, response_text, execution_duration_ms / 1000.0::DOUBLE AS latency_seconds,
    llm AS call_llm_exec_count, tools AS tool_call_count, tokens AS total_tokens_used, {VERDICTS_SQL}
  FROM trace_rows JOIN span_sums USING (trace_id))"""


@query("trace_rollup", f"WITH {ROLLED_SQL} SELECT * FROM rolled WHERE word_count_check IS NOT NULL")
def trace_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessed traces with their calls, tokens, latency and verdicts."""
    return traces.rollup(inputs.trace_log(spark, sf_dir), with_time=False)


@query(
    "trace_minute_series",
    f"""WITH {ROLLED_SQL}
    SELECT date_trunc('minute', request_time) AS minute, count(*) AS traces,
      round(avg(latency_seconds), 6) AS avg_latency_seconds, round(avg(tool_call_count), 6) AS avg_tool_calls,
      round(avg(call_llm_exec_count), 6) AS avg_llm_calls, CAST(sum(total_tokens_used) AS BIGINT) AS total_tokens,
      round(avg(word_count_check), 6) AS word_count_check_rate, round(avg(polite_tone), 6) AS polite_tone_rate,
      round(avg(hook_in_post), 6) AS hook_in_post_rate
    FROM rolled GROUP BY 1""",
)
def trace_minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = traces.rollup(inputs.trace_log(spark, sf_dir), assessed_only=False, with_time=False)
    series = traces.minute_series(rolled)
    return rounded(series, 6, *[c for c in series.columns if c.startswith("avg_") or c.endswith("_rate")])


@query(
    "trace_response_extract",
    f"""WITH {inputs.TRACES_SQL} SELECT trace_id, response_text,
      CASE WHEN event_type = 'error' THEN '{traces.BOUND_MESSAGE}' ELSE coalesce(text, 'thinking') END AS last_text,
      CASE WHEN text IS NULL THEN 0 ELSE 1 END + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS messages
    FROM trace_rows""",
)
def trace_response_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    response = F.col("response")
    messages = F.filter(traces.output_items(response), lambda x: x["type"] == traces.MESSAGE_TYPE)
    return inputs.trace_log(spark, sf_dir).select(
        "trace_id", traces.response_text(response).alias("response_text"),
        traces.last_output_text(response).alias("last_text"), F.size(messages).alias("messages"),
    )


@query(
    "unassessed_traces",
    f"""WITH {inputs.TRACES_SQL} SELECT trace_id, request_preview, response_text FROM trace_rows
    WHERE event_type = 'error' AND labelled_id IS NULL AND response_text IS NOT NULL""",
)
def unassessed_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.unassessed(inputs.trace_log(spark, sf_dir), endpoint="error")


@query("traces_without_feedback", """SELECT 'tr-' || event_id AS trace_id FROM events
    WHERE event_id NOT IN (SELECT doc_id FROM labels)""")
def traces_without_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    feedback = inputs.table(spark, sf_dir, "labels").select(F.concat(F.lit("tr-"), F.col("doc_id").cast("string")).alias("trace_id"))
    return traces.without_feedback(inputs.trace_log(spark, sf_dir), feedback).select("trace_id")


@query("trace_verdicts", f"WITH {inputs.TRACES_SQL} SELECT trace_id, {VERDICTS_SQL} FROM trace_rows")
def trace_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = [traces.verdict(F.col("assessments"), n, p).alias(n) for n, p in traces.VERDICTS.items()]
    return inputs.trace_log(spark, sf_dir).select("trace_id", *verdicts)


@query("trace_spans", f"WITH {inputs.TRACES_SQL} SELECT trace_id, name, duration_ms, i * k AS tokens FROM spans")
def trace_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per span, tokens out of its nested JSON."""
    rows = traces.span_rows(inputs.trace_log(spark, sf_dir))
    outputs = F.try_element_at(F.col("span.attributes"), F.lit(traces.SPAN_OUTPUTS))
    tokens = nested.json_int(outputs, "usage", "total_tokens").cast("long")
    return rows.select("trace_id", "span.name", "span.duration_ms", tokens.alias("tokens"))


@query(
    "trace_performance_review",
    f"""WITH {inputs.TRACES_SQL},
    facts AS (
      SELECT t.trace_id, CAST(count(*) FILTER (WHERE duration_ms > 2000) AS INTEGER) AS slow_spans,
        CAST(count(i) - count(DISTINCT (name || inputs)) FILTER (WHERE i IS NOT NULL) AS INTEGER) AS repeated_calls
      FROM trace_rows t LEFT JOIN spans s ON s.trace_id = t.trace_id GROUP BY 1)
    SELECT *, CASE WHEN slow_spans > 0 AND repeated_calls > 0 THEN 'needs_improvement'
      WHEN slow_spans > 0 OR repeated_calls > 0 THEN 'acceptable' ELSE 'optimal' END AS rating FROM facts""",
)
def trace_performance_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.performance_review(inputs.trace_log(spark, sf_dir))


@query(
    "loop_bound_share",
    """SELECT CAST(user_id AS VARCHAR) AS caller, count(*) AS traces, CAST(sum((event_type = 'error')::INTEGER) AS BIGINT) AS cut_off,
      round(avg((event_type = 'error')::INTEGER), 6) AS cut_off_share FROM events GROUP BY 1""",
)
def loop_bound_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    caller = F.regexp_replace("session_id", "^user-", "").alias("caller")
    return rounded(traces.loop_bound_share(inputs.trace_log(spark, sf_dir), [caller]), 6, "cut_off_share")


@query(
    "session_rebuild",
    """SELECT 'user-' || user_id AS session_id, 'tr-' || event_id AS trace_id, ts AS request_time,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn,
      round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS gap_seconds
    FROM events""",
)
def session_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.trace_log(spark, sf_dir).select("session_id", "trace_id", "trace_key", "request_time")
    return rounded(sessions.rebuild(rows), 6, "gap_seconds").drop("trace_key")


@query(
    "session_summary",
    """WITH turns AS (SELECT user_id, ts, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap FROM events)
    SELECT 'user-' || user_id AS session_id, count(*) AS turns, min(ts) AS first_time, max(ts) AS last_time,
      round(max(gap), 6) AS longest_gap_seconds FROM turns GROUP BY user_id""",
)
def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.trace_log(spark, sf_dir).select("session_id", "trace_id", "trace_key", "request_time")
    return rounded(sessions.session_summary(sessions.rebuild(rows)), 6, "longest_gap_seconds")
