"""Session helpers: a local builder for tests and benches, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs ask of a session. Skewed joins are split even where that costs one more shuffle;
# partitions are cut small enough for one core and merged again when they turn out tiny.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}

_local_roots: dict[str, str] = {}


def apply_settings(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Set the SQL options above on a session of yours; give the shuffle width for large inputs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def build_session(
    app: str = "tidewheel", cores: int | str = 8, memory: str = "12g", extra: dict[str, str] | None = None
) -> SparkSession:
    """Local session for tests and benches. On a cluster, bring your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would lose data with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidewheel-")
    return _local_roots[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
