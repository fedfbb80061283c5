"""Trace tables: response text, per-trace rollup, minute series, performance review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import dates, nested

# Names and limits the trace contract uses.
OUTPUT_SCHEMA = "array<struct<type:string, content:array<struct<text:string>>>>"
MESSAGE_TYPE = "message"
MODEL_SPAN = "call_llm"
TOOL_SPAN = "execute_tool"
ENDPOINT_TAG = "model_serving_endpoint_name"
SPAN_OUTPUTS = "outputs"
SLOW_SPAN_MS = 2000
BOUND_MESSAGE = "Max iterations reached. Stopping."
VERDICTS = {"word_count_check": "true", "polite_tone": "Pass", "hook_in_post": "Pass"}


def output_items(response: Column) -> Column:
    return F.from_json(F.get_json_object(response, "$.output"), OUTPUT_SCHEMA)


def response_text(response: Column) -> Column:
    """Text of the first message among the output items."""
    message = nested.first_match(output_items(response), lambda x: x["type"] == MESSAGE_TYPE)
    return F.get(message["content"], F.lit(0))["text"]


def last_output_text(response: Column) -> Column:
    return F.get(nested.last_item(output_items(response))["content"], F.lit(0))["text"]


def unassessed(traces: DataFrame, endpoint: str | None = None) -> DataFrame:
    """Traces without an assessment that do hold a response text."""
    rows = traces.where(nested.is_blank_array(F.col("assessments")))
    if endpoint is not None:
        rows = rows.where(nested.tag_equals(F.col("tags"), ENDPOINT_TAG, endpoint))
    texts = rows.select("trace_id", "request_preview", response_text(F.col("response")).alias("response_text"))
    return texts.where("response_text IS NOT NULL")


def without_feedback(traces: DataFrame, feedback: DataFrame) -> DataFrame:
    """Traces that have no row in the feedback table."""
    return traces.join(feedback.select("trace_id"), "trace_id", "left_anti")


def verdict(assessments: Column, name: str, passing: str) -> Column:
    """1, 0 or null for one named assessment."""
    found = nested.first_match(assessments, lambda a: a["name"] == name)
    return nested.tri_state(found["feedback"]["value"], passing)


def rollup(
    traces: DataFrame, endpoint: str | None = None, output_key: str = SPAN_OUTPUTS,
    assessed_only: bool = True, keep_empty: bool = False, with_time: bool = True,
) -> DataFrame:
    """One row per trace: calls, tokens, latency, verdicts.

    The spans already sit in the trace's own row, so they are folded there: no explode, no
    shuffle, and no grouping by the response text.
    """
    rows = traces
    if endpoint is not None:
        rows = rows.where(nested.tag_equals(F.col("tags"), ENDPOINT_TAG, endpoint))
    if assessed_only:
        rows = rows.where(F.size("assessments") > 0)
    if not keep_empty:
        rows = rows.where(F.size("spans") > 0)

    def tokens(span: Column) -> Column:
        used = nested.json_int(F.try_element_at(span["attributes"], F.lit(output_key)), "usage", "total_tokens")
        return F.when(span["name"] == MODEL_SPAN, F.coalesce(used, F.lit(0))).otherwise(0).cast("long")

    def calls(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["name"] == name)).cast("long")

    columns = [
        F.col("trace_id"), F.col("request_time"), F.col("request_preview"),
        response_text(F.col("response")).alias("response_text"),
        dates.seconds_from_ms(F.col("execution_duration_ms")).alias("latency_seconds"),
        calls(MODEL_SPAN).alias("call_llm_exec_count"),
        calls(TOOL_SPAN).alias("tool_call_count"),
        F.aggregate(F.transform("spans", tokens), F.lit(0).cast("long"), lambda a, x: a + x).alias("total_tokens_used"),
        *[verdict(F.col("assessments"), name, passing).alias(name) for name, passing in VERDICTS.items()],
    ]
    if with_time:
        columns.append(F.current_timestamp().alias("processed_ts"))
    return rows.select(*columns)


def minute_series(rolled: DataFrame) -> DataFrame:
    """Dashboard series: latency, calls, tokens and pass rates per minute."""
    minute = dates.truncate("MINUTE", F.col("request_time")).alias("minute")
    return rolled.groupBy(minute).agg(
        F.count(F.lit(1)).alias("traces"),
        F.avg("latency_seconds").alias("avg_latency_seconds"),
        F.avg("tool_call_count").alias("avg_tool_calls"),
        F.avg("call_llm_exec_count").alias("avg_llm_calls"),
        F.sum("total_tokens_used").alias("total_tokens"),
        *[F.avg(name).alias(f"{name}_rate") for name in VERDICTS],
    )


def performance_review(traces: DataFrame, slow_ms: int = SLOW_SPAN_MS) -> DataFrame:
    """Slow spans and repeated identical calls per trace, with a rating. Folded in the row."""
    def call(s: Column) -> Column:
        return F.struct(s["name"].alias("name"), F.try_element_at(s["attributes"], F.lit("inputs")).alias("inputs"))

    slow = F.size(F.filter("spans", lambda s: s["duration_ms"] > slow_ms))
    repeats = F.size("spans") - F.size(F.array_distinct(F.transform("spans", call)))
    counted = traces.where("spans IS NOT NULL").select(
        "trace_id", slow.alias("slow_spans"), repeats.alias("repeated_calls")
    )
    rating = (
        F.when((F.col("slow_spans") > 0) & (F.col("repeated_calls") > 0), "needs_improvement")
        .when((F.col("slow_spans") > 0) | (F.col("repeated_calls") > 0), "acceptable")
        .otherwise("optimal")
    )
    return counted.withColumn("rating", rating)


def span_rows(traces: DataFrame, outer: bool = False) -> DataFrame:
    """One row per span; traces without spans are dropped unless `outer`."""
    rows = traces.select("trace_id", "request_time", "spans")
    if outer:
        return rows.select("trace_id", "request_time", F.explode_outer("spans").alias("span"))
    return nested.one_row_each(rows, "spans", "span").drop("spans")


def loop_bound_share(traces: DataFrame, keys: list[Column], bound_message: str = BOUND_MESSAGE) -> DataFrame:
    """Share of traces whose last output is the loop-bound message."""
    cut = F.coalesce(F.col("last_text") == bound_message, F.lit(False)).cast("int")
    rows = traces.withColumn("last_text", last_output_text(F.col("response")))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("traces"), F.sum(cut).alias("cut_off"), F.avg(cut).alias("cut_off_share")
    )
