"""Versioned parquet snapshots, their history, and the lineage row of a dataset.

Layout: <root>/v=<n>/ holds version n, <root>/_history/ one small parquet row per version.
A version counts only once its history row is there, so a half-written folder is never read.
One writer per root is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

HISTORY_SCHEMA = "version long, rows long, schema_hash string, committed_at timestamp"
LINEAGE_SCHEMA = "run_id string, role string, sql string, version long, row_count long, schema_hash string"


def schema_hash(df: DataFrame) -> str:
    import hashlib

    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def history(spark: SparkSession, root: str) -> DataFrame:
    """All committed versions; empty when nothing has been written yet."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(f"{root}/_history")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA)


def latest_version(spark: SparkSession, root: str) -> int | None:
    return history(spark, root).agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Write the rows as the next version and commit it to the history."""
    from pyspark.sql import Observation

    spark = df.sparkSession
    last = latest_version(spark, root)
    version = 0 if last is None else last + 1
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/v={version}")
    row = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.lit(int(seen.get["rows"])).cast("long").alias("rows"),
        F.lit(schema_hash(df)).alias("schema_hash"),
        F.current_timestamp().alias("committed_at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/_history")
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of one committed version, the newest by default."""
    known = latest_version(spark, root) if version is None else version
    if known is None or history(spark, root).where(F.col("version") == known).isEmpty():
        raise ValueError(f"no committed version {known} under {root}")
    return spark.read.parquet(f"{root}/v={known}")


def lineage_row(df: DataFrame, run_id: str, role: str, sql: str, version: int) -> DataFrame:
    """Which query over which version a run used, as a train or test set."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(role).alias("role"),
        F.lit(sql).alias("sql"),
        F.lit(version).cast("long").alias("version"),
        "row_count",
        F.lit(schema_hash(df)).alias("schema_hash"),
    )
