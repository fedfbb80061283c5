"""Structured Streaming forms of the incremental jobs.

Every job reads files as a stream, runs until what is there has been processed
(availableNow), and writes through foreachBatch into one folder per micro-batch. A batch that
is run again after a failure overwrites its own folder, so each input row counts once.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import inference_log, traces
from tidewheel.session import work_path


def file_stream(spark: SparkSession, folder: str, glob: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on a zoned copy of the time column (a zone-less one is not accepted)."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def run_to_table(stream: DataFrame, name: str, mode: str = "append", root: str | None = None) -> str:
    """Process everything available; returns the output folder, partitioned by batch_id.

    Give the same `root` again to continue from the checkpoint of an earlier run.
    """
    root = root or work_path(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(root, "rows", f"batch_id={batch_id}"))

    running = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", os.path.join(root, "checkpoint"))
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return os.path.join(root, "rows")


def read_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Rows of an append-mode run."""
    return spark.read.schema(schema).parquet(folder).select(*schema.names)


def read_latest(spark: SparkSession, folder: str, schema, keys: list[str]) -> DataFrame:
    """Rows of an update-mode run: per key the row of the newest batch."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    rows = spark.read.schema(f"{fields}, batch_id bigint").parquet(folder)
    values = [f.name for f in schema if f.name not in keys]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def parsed_requests(log_stream: DataFrame) -> DataFrame:
    """Payload rows parsed as they arrive (the batch parser, unchanged)."""
    return inference_log.parse_payload(log_stream)


def window_profile(stream: DataFrame, time_column: str, width: str, keys: list[str], value: str, delay: str) -> DataFrame:
    """Count, null count, mean and range of a value per tumbling window and key."""
    timed = with_event_time(stream, time_column, delay)
    grouped = timed.groupBy(F.window(time_column, width).alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(value).isNull()).alias("null_count"),
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
    )
    return grouped.select(F.col("_w.start").alias("window_start"), *keys, "row_count", "null_count", "mean", "min", "max")


def minute_metrics(rolled: DataFrame, delay: str) -> DataFrame:
    """Per-minute latency, calls and tokens of rolled-up traces."""
    timed = with_event_time(rolled, "request_time", delay)
    grouped = timed.groupBy(F.window("request_time", "1 minute").alias("_w")).agg(
        F.count(F.lit(1)).alias("traces"), F.avg("latency_seconds").alias("avg_latency_seconds"),
        F.sum("call_llm_exec_count").alias("llm_calls"), F.sum("total_tokens_used").alias("total_tokens"),
    )
    return grouped.select(F.col("_w.start").alias("minute"), "traces", "avg_latency_seconds", "llm_calls", "total_tokens")


def trace_rollup(trace_stream: DataFrame) -> DataFrame:
    return traces.rollup(trace_stream, assessed_only=False, with_time=False)


def deduplicated(stream: DataFrame, key: str, time_column: str, delay: str) -> DataFrame:
    """First row per request id, remembered for as long as the watermark says."""
    return with_event_time(stream, time_column, delay).dropDuplicatesWithinWatermark([key])


def with_late_truth(
    predictions: DataFrame, truths: DataFrame, key: str, bound: str, delay: str,
    time_column: str = "request_time", truth_time: str = "truth_time",
) -> DataFrame:
    """Predictions left-joined with truth of the same id arriving within the bound."""
    left = with_event_time(predictions, time_column, delay).alias("p")
    right = with_event_time(truths.withColumnRenamed(key, "truth_key"), truth_time, delay).alias("t")
    near: Column = (
        (F.col(f"p.{key}") == F.col("t.truth_key"))
        & (F.col(truth_time) >= F.col(time_column))
        & (F.col(truth_time) <= F.col(time_column) + F.expr(f"INTERVAL {bound}"))
    )
    return left.join(right, near, "left_outer").drop("truth_key")


def session_activity(stream: DataFrame, key: str, time_column: str, gap: str, delay: str) -> DataFrame:
    """Bursts of activity per session id, closed by a gap."""
    timed = with_event_time(stream, time_column, delay)
    burst = F.session_window(time_column, gap)
    return timed.groupBy(key, burst.alias("burst")).agg(F.count(F.lit(1)).alias("events")).select(
        key, F.col("burst.start").alias("start"), F.col("burst.end").alias("end"), "events"
    )


def with_open_predictions(
    emitted: DataFrame, predictions: DataFrame, truths: DataFrame, key: str, bound: str, delay: str,
    time_column: str = "request_time",
) -> DataFrame:
    """Closing batch step: rows of the stream, and those of predictions the watermark has not closed."""
    p, done = predictions.alias("p"), emitted.select(key, time_column).distinct().alias("e")
    sent = F.col(f"p.{key}").eqNullSafe(F.col(f"e.{key}")) & F.col(f"p.{time_column}").cast("timestamp").eqNullSafe(
        F.col(f"e.{time_column}")
    )
    still = with_late_truth(p.join(done, sent, "left_anti"), truths, key, bound, delay, time_column)
    return emitted.unionByName(still)


def with_open_sessions(closed: DataFrame, rows: DataFrame, key: str, time_column: str, gap: str, delay: str) -> DataFrame:
    """Closing batch step: closed sessions, and those of the rows that come after a key's last closed one."""
    last = closed.groupBy(F.col(key).alias("_k")).agg(F.max("end").alias("_end"))
    timed = rows.join(last, F.col(key).eqNullSafe(F.col("_k")), "left")
    later = timed.where(F.col("_end").isNull() | (F.col(time_column).cast("timestamp") >= F.col("_end")))
    return closed.unionByName(session_activity(later.drop("_k", "_end"), key, time_column, gap, delay))
