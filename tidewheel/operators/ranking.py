"""Dense positions over a whole table, and running values per key that survive hot keys.

A plain row_number puts every row of its partition into one task. Over a whole table rows are first cut into
buckets in hash order; buckets are counted with map-side partials, the small count table gives
each bucket its offset, and row_number runs inside a bucket only. Per key, rows are cut by ranges of
(key, order), see `running_by_key`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewheel.session import materialize

HASH_DIGITS = 4  # 65,536 buckets of equal size


def positions_by_hash(df: DataFrame, key: Column, out: str = "position") -> DataFrame:
    """Position 1..N in the order of md5(key), null keys first: a repeatable random order of the table."""
    marked = df.withColumn("_h", F.coalesce(F.md5(key.cast("string")), F.lit("")))
    marked = marked.withColumn("_b", F.substring("_h", 1, HASH_DIGITS))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy("_h"))
    placed = marked.join(offsets, "_b").withColumn(out, (F.col("_o") + within).cast("long"))
    return placed.drop("_h", "_b", "_o")


def running_by_key(
    df: DataFrame, keys: list[str], order: list[str], weights: dict[str, str] | None = None, place: str | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Running values of each row inside its key, in the order of `order` (nulls first).

    `weights` names a new column for each numeric column to be summed over the rows before, whole numbers as
    long and others as double; `place`
    receives the number of rows before, and `previous` the value of order[0] in the row before. Null
    keys are a key, null weights count 0, and rows equal in every order column come in any order.

    One range-partitioned sort by keys, order and row numbers the rows of each partition, whatever the sizes of the
    keys are: a key of any size is cut at partition boundaries. What a partition's first key
    had before it follows from one row a partition.
    """
    weights = dict(weights or {})
    columns, first_order = df.columns, df.schema[order[0]].dataType
    rows = df.withColumn("_one", F.lit(1).cast("long")).withColumn("_tie", F.monotonically_increasing_id())
    sums = {f"_sum{i}": c for i, c in enumerate(["_one", *weights.values()])}
    kinds = {c: T.LongType() if isinstance(rows.schema[w].dataType, T.IntegralType) else T.DoubleType() for c, w in sums.items()}
    whole = {c: isinstance(kind, T.LongType) for c, kind in kinds.items()}
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order, "_tie"]]
    added = T.StructType([
        T.StructField("_part", T.IntegerType()), T.StructField("_run", T.LongType()), T.StructField("_before", first_order),
        *[T.StructField(c, kinds[c]) for c in sums],
    ])
    schema = T.StructType([*rows.schema.fields, *added.fields])
    given, names = rows.columns, schema.names

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, runs, before = TaskContext.get().partitionId(), None, -1, None
        carry = dict.fromkeys(sums, 0)
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            named = {c: batch.column(i) for i, c in enumerate(given)}
            new = np.zeros(n, bool)
            for c in keys:
                code = np.asarray(pc.dictionary_encode(named[c], null_encoding="encode").indices)
                new[1:] |= code[1:] != code[:-1]
            new[0] = runs < 0 or key != [str(named[c][0].as_py()) + str(named[c][0].is_valid) for c in keys]
            run = np.cumsum(new) + runs
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            out = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(run)]
            value = named[order[0]]
            shifted = pa.concat_arrays([pa.array([before], value.type), value.slice(0, n - 1)])
            out.append(pc.if_else(pa.array(new), pa.nulls(n, value.type), shifted))
            for c, weight in sums.items():
                w = np.asarray(pc.fill_null(named[weight].cast(pa.int64() if whole[c] else pa.float64()), 0))
                total = np.cumsum(w) - w
                running = np.where(start >= 0, total - total[np.maximum(start, 0)], total + carry[c])
                carry[c] = (running[-1] + w[-1]).item()
                out.append(pa.array(running))
            key = [str(named[c][n - 1].as_py()) + str(named[c][n - 1].is_valid) for c in keys]
            runs, before = int(run[-1]), value[n - 1].as_py()
            yield pa.RecordBatch.from_arrays(out, names=names)

    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = materialize(ranged.mapInArrow(number, schema), "running")
    own = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.lit(0))
    at = F.struct("_run", "_sum0")
    ends = numbered.groupBy("_part").agg(
        F.min_by(own, at).alias("first"), F.max_by(own, at).alias("last"), F.max("_run").alias("runs"),
        F.max_by(order[0], at).alias("value"),
        *[F.max_by(F.col(c) + F.coalesce(F.col(w), F.lit(0)), at).alias(c) for c, w in sums.items()],
    )
    offsets, last, held, value = [], None, [], None
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):  # a row for each partition
        goes_on = last is not None and str(r["first"]) == str(last)
        offset = held if goes_on else [0 if whole[c] else 0.0 for c in sums]
        offsets.append((r["_part"], value if goes_on else None, *offset))
        held = [r[c] + o if r["runs"] == 0 else r[c] for c, o in zip(sums, offset)]
        last, value = r["last"], r["value"]
    shift = T.StructType([
        T.StructField("_part", T.IntegerType()), T.StructField("_earlier", first_order),
        *[T.StructField(f"_off{c}", kinds[c]) for c in sums],
    ])
    joined = numbered.join(F.broadcast(df.sparkSession.createDataFrame(offsets, shift)), "_part")
    shifted_sums = [F.when(F.col("_run") == 0, F.col(c) + F.col(f"_off{c}")).otherwise(F.col(c)) for c in sums]
    out = dict(zip([*([place] if place else []), *weights], shifted_sums[0 if place else 1 :]))
    if previous:
        out[previous] = F.when((F.col("_run") == 0) & (F.col("_sum0") == 0), F.col("_earlier")).otherwise(F.col("_before"))
    return joined.select(*columns, *[v.alias(name) for name, v in out.items()])


def positions_by_key(
    df: DataFrame, keys: list[str], order: str, tie: str, out: str = "position", previous: str | None = None
) -> DataFrame:
    """Position 1.. of each row inside its key by (order, tie), nulls first; keys of any size.

    `previous` names a column that receives the order value of the row before it.
    """
    placed = running_by_key(df, keys, [order, tie], place=out, previous=previous)
    return placed.withColumn(out, F.col(out) + 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """First k rows per key. Spark keeps k rows per key and map task before it shuffles."""
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(out) <= k)
