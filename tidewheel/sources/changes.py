"""Row changes between two snapshots, upserts from them, and key constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(columns: list[str]) -> Column:
    """Fixed-width digest of a row: two independent hashes, 96 bits together.

    Hashes pass over nulls, so each column's null flag is hashed with it: a value that moves to a
    neighbouring column changes the digest.
    """
    flagged = [x for c in columns for x in (F.col(c), F.col(c).isNull())] or [F.lit(0)]
    return F.struct(F.xxhash64(*flagged).alias("a"), F.hash(*flagged).alias("b"))


def _same_key(keys: list[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `after` that were inserted or updated, and keys of `before` that were deleted.

    The old side travels as key and digest only, so the shuffle carries one full copy of the
    data, not two. Deleted rows have null in every column but the key. Null keys equal each other.
    """
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, _digest(values).alias("_old"), F.lit(True).alias("_was")).alias("o")
    new = after.select(*keys, *values, _digest(values).alias("_new"), F.lit(True).alias("_is")).alias("n")
    kind = (
        F.when(F.col("_was").isNull(), "insert")
        .when(F.col("_is").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    joined = old.join(new, _same_key(keys, "o", "n"), "full_outer").withColumn("_change_type", kind)
    shown = [F.when(F.col("_is").isNull(), F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys]
    return joined.where(F.col("_change_type").isNotNull()).select(*shown, *[F.col(f"n.{v}") for v in values], "_change_type")


def _without(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    return target.alias("o").join(updates.select(*keys).alias("n"), _same_key(keys, "o", "n"), "left_anti")


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Target with a change feed merged in by key."""
    fresh = changes.where(F.col("_change_type") != "delete").select(*target.columns)
    return _without(target, changes, keys).unionByName(fresh)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows replaced by the updates of the same key, new keys added."""
    return _without(target, updates, keys).unionByName(updates)


def constraint_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break NOT NULL or uniqueness, with the number of rows that do."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    kind = F.when(any_null, "null_key").when(F.col("n_rows") > 1, "duplicate_key")
    return counted.withColumn("violation", kind).where(F.col("violation").isNotNull())


def require_key(df: DataFrame, keys: list[str]) -> None:
    """Raise when the columns are not a primary key."""
    broken = constraint_violations(df, keys).head(1)
    if broken:
        raise ValueError(f"not a primary key {keys}: {broken[0].asDict()}")
