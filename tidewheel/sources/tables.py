"""Scans and sinks for tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header under a declared schema; a wrong row fails instead of turning null."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_binary(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Path and content of every file in a folder."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "content")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed line per row, blank lines left out."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    return lines.where(F.length("line") > 0)


def evaluation_inputs(lines: DataFrame) -> DataFrame:
    """Rows shaped for an evaluation run: inputs.question."""
    return lines.select(F.struct(F.col("line").alias("question")).alias("inputs"))


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def replace_table_as(df: DataFrame, name: str) -> None:
    """Create the table from the rows, replacing an older one of that name."""
    df.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def insert_into(df: DataFrame, name: str, ddl: str) -> None:
    """Create the table when missing, then insert by column name."""
    spark = df.sparkSession
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")
    df.select(*spark.table(name).columns).write.insertInto(name)


def define_view(spark: SparkSession, name: str, select: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def write_counted(df: DataFrame, name: str) -> int:
    """Append and return the number of rows written, from the write job itself.

    Counting the plan again after the append would read the table it has just changed.
    """
    from pyspark.sql import Observation

    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").saveAsTable(name)
    return int(seen.get["rows"])


def rows_with_ingest_time(spark: SparkSession, records: list, schema: T.StructType) -> DataFrame:
    """Driver-made records under a declared schema, stamped with the ingest time."""
    return spark.createDataFrame(records, schema).withColumn("ingest_ts", F.current_timestamp())
