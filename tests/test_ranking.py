"""Running values by key: against windows, and with one key that holds nearly all rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.operators import ranking


@pytest.mark.parametrize("hot", [None, "k3"])
def test_running_sums_of_a_hot_key(spark, hot):
    r = random.Random(2)
    rows = [(hot if r.random() < 0.9 else r.choice(["k1", "k2", None]), r.choice([None, *range(40)]), i, r.choice([None, 1, 5]), "x") for i in range(4000)]
    frame = spark.createDataFrame(rows, "k string, o int, tie long, w long, _sum text".replace("text", "string")).repartition(6)
    got = ranking.running_by_key(frame, ["k"], ["o", "tie"], {"sum": "w"}, place="n", previous="p")
    whole = Window.partitionBy("k").orderBy("o", "tie")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    want = frame.withColumns({
        "n": (F.row_number().over(whole) - 1).cast("long"), "sum": F.coalesce(F.sum("w").over(before), F.lit(0)), "p": F.lag("o").over(whole),
    }).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tasks_are_even_when_one_null_key_holds_all(spark):
    frame = spark.range(40_000).selectExpr("cast(null as string) as k", "id % 7 as o", "id as tie")
    placed = ranking.positions_by_key(frame, ["k"], "o", "tie")
    sizes = [r["n"] for r in placed.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert placed.agg(F.max("position")).first()[0] == 40_000 and placed.select("position").distinct().count() == 40_000
    assert len(sizes) == 1 or max(sizes) < 3 * 40_000 / len(sizes)


def test_keys_of_several_columns_and_times(spark):
    frame = spark.range(500).selectExpr("id % 3 as a", "date_add(date'2024-01-01', int(id % 2)) as b", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 50) as t", "id")
    got = ranking.positions_by_key(frame, ["a", "b"], "t", "id", previous="last")
    whole = Window.partitionBy("a", "b").orderBy("t", "id")
    want = frame.withColumns({"position": F.row_number().over(whole).cast("long"), "last": F.lag("t").over(whole)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_rows(spark):
    assert ranking.positions_by_key(spark.range(0).withColumn("k", F.lit("x")), ["k"], "id", "id").count() == 0
