"""Incremental table jobs: load what is new, append it, say how much was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import chunks, inference_log
from tidewheel.sources import snapshots, tables


def update_monitoring_table(
    spark: SparkSession, log_table: str, truth_table: str, target: str, overlap_minutes: int | None = None
) -> int:
    """Append new inference-log rows, parsed and with truth; returns the rows written.

    The first run loads everything. Nothing new leaves the target as it is.
    """
    loaded = None
    if tables.table_exists(spark, target):
        loaded = tables.read_table(spark, target).select("request_id", "request_time")
    fresh = inference_log.new_payload(tables.read_table(spark, log_table), loaded, overlap_minutes)
    rows = inference_log.with_truth(inference_log.parse_payload(fresh), tables.read_table(spark, truth_table))
    if loaded is None:
        return tables.write_counted(rows, target)
    ordered = rows.select(*tables.read_table(spark, target).columns)
    return tables.write_counted(ordered, target)


def update_chunk_table(spark: SparkSession, parsed_table: str, papers_table: str, target: str, batch: int) -> int:
    """Append the chunks of one batch; chunks the target already holds are left out."""
    rows = chunks.chunk_table(tables.read_table(spark, parsed_table), tables.read_table(spark, papers_table), batch)
    if not tables.table_exists(spark, target):
        return tables.write_counted(rows, target)
    known = tables.read_table(spark, target).select("id")
    return tables.write_counted(rows.join(known, "id", "left_anti").select(*tables.read_table(spark, target).columns), target)


def backfill_snapshot(monitoring: DataFrame, truth: DataFrame, root: str) -> int:
    """Late truth filled in, written as the next snapshot version of the monitoring rows."""
    return snapshots.write_snapshot(inference_log.backfill_truth(monitoring, truth), root)


def pending_truth(spark: SparkSession, target: str) -> int:
    """Monitoring rows that still wait for their label."""
    return tables.read_table(spark, target).where(F.col("average_price").isNull()).count()
