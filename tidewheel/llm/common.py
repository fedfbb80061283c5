"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import materialize, work_path

__all__ = ["materialize", "text_bytes", "width", "table", "work_path", "word_count", "row_marks", "where_marked"]

#: Words of a text: runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, empty where it is null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them for the size of its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_marks(rows: DataFrame, number: str) -> DataFrame:
    """(bucket, bits): a bit for each row number, in bitmaps of 32,768 (4 KB) each.

    For numbers of monotonically_increasing_id, which are dense in each partition: a bit a row, 4 KB a
    partition at least. Each bucket is built in one place.
    """
    dealt = rows.select(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("at"))
    return dealt.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def where_marked(rows: DataFrame, number: str, marks: DataFrame) -> DataFrame:
    """Rows whose number has its bit; the bitmaps are broadcast, so that the rows themselves stay where they are."""
    byte = f"CAST(conv(hex(substring(bits, CAST(bitmap_bit_position({number}) div 8 + 1 AS int), 1)), 16, 10) AS int)"
    set_bit = f"(shiftright({byte}, CAST(bitmap_bit_position({number}) % 8 AS int)) & 1) = 1"
    return rows.join(F.broadcast(marks), F.expr(f"bucket = bitmap_bucket_number({number}) AND {set_bit}"), "left_semi")
