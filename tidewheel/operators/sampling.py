"""Samples of exact size, repeatable on any partitioning, without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.ranking import positions_by_hash, running_by_key

#: Hex digits that one counting pass looks at, and the bucket size from which its digests are collected.
DIGITS = 4
COLLECTED = 10_000
#: Hex digits of a draw's digest: 60 bits, far more than rows, so the remainder is as good as even.
DRAW_DIGITS = 15


def with_digest(df: DataFrame, key: Column, out: str) -> DataFrame:
    """Adds the order of a sample: md5(key), then a digest of the row; a null key counts as the row's digest."""
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).cast("binary"))
    return df.withColumn(out, F.concat(F.coalesce(F.md5(key.cast("string").cast("binary")), row), row))


def threshold(digests: DataFrame, column: str, wanted: int) -> tuple[str, int]:
    """The wanted-th smallest digest, and how many of the rows that have it are wanted.

    Counts of leading digits narrow the place down, 65,536 buckets a pass; the digests of a small bucket are
    collected, and a bucket of one digest is the answer whatever its size.
    """
    prefix, left = "", wanted
    while True:
        bucket = F.substring(column, len(prefix) + 1, DIGITS).alias("bucket")
        inside = digests.where(F.col(column).startswith(prefix)) if prefix else digests
        counts = inside.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: r["bucket"]):
            if left <= r["n"]:
                break
            left -= r["n"]
        if r["low"] == r["high"]:
            return r["low"], left
        prefix += r["bucket"]
        if r["n"] <= COLLECTED:
            found = sorted(x[0] for x in digests.where(F.col(column).startswith(prefix)).select(column).collect())
            return found[left - 1], left - found.index(found[left - 1])


def sample_share(df: DataFrame, key: Column, percent: int = 10) -> DataFrame:
    """The first percent of the rows by md5(key), at least one; no rows give no rows.

    Rows of one key come by a digest of the row, and rows without a key are spread over all places by theirs.
    Rows that are equal throughout are interchangeable; as many of them are kept as fall below the mark.
    """
    total = df.count()
    if not total:
        return df.limit(0)
    marked = with_digest(df, key, "_d")
    mark, among = threshold(marked.select("_d"), "_d", max(1, total * percent // 100))
    below = marked.where(F.col("_d") < mark)
    equal = marked.where(F.col("_d") == mark)
    kept = equal if equal.count() <= among else running_by_key(equal, ["_d"], ["_d"], place="_n").where(F.col("_n") < among).drop("_n")
    return below.unionByName(kept).drop("_d")


def draw(number: Column, seed: int, total: int) -> Column:
    """The place 1..total of a draw: a remainder of the digest of seed and number, the same on any cluster."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), number.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long") % F.lit(total) + 1


def resample(df: DataFrame, key: Column, n: int, seed: int) -> DataFrame:
    """n draws with replacement, each row as often as its place in the order of md5(key) was drawn."""
    total = df.count()
    if total == 0:
        return df.limit(0)
    drawn = df.sparkSession.range(n).select(draw(F.col("id"), seed, total).alias("_p"))
    times = drawn.groupBy("_p").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    placed = positions_by_hash(df, key, "_p").join(times, "_p")
    return placed.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_p", "_times", "_i")
