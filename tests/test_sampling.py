"""Exact samples, draws and the copula on nulls, ties, copies and other partitionings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import sampling, synthesis


@pytest.mark.parametrize("collected", [10_000, 0])
@pytest.mark.parametrize("partitions", [1, 6])
def test_sample_of_mostly_null_keys(spark, monkeypatch, partitions, collected):
    monkeypatch.setattr(sampling, "COLLECTED", collected)
    rows = [(None if i % 10 else f"k{i}", i) for i in range(1500)]
    frame = spark.createDataFrame(rows, "key string, v int").repartition(partitions)
    got = sampling.sample_share(frame, F.col("key"), 10).collect()
    assert len(got) == 150 and 100 < sum(r.key is None for r in got) < 150
    again = sampling.sample_share(frame.repartition(3), F.col("key"), 10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_sample_takes_the_smallest_digests(spark):
    frame = spark.range(3000).withColumnRenamed("id", "k")
    want = sorted(range(3000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:210]
    assert sorted(r.k for r in sampling.sample_share(frame, F.col("k"), 7).collect()) == sorted(want)


@pytest.mark.parametrize("percent", [1, 30, 100])
def test_sample_of_copies(spark, percent):
    frame = spark.range(900).selectExpr("if(id % 3 = 0, 'other', 'same') as k", "1 as v").repartition(4)
    got = sampling.sample_share(frame, F.col("k"), percent).collect()
    assert len(got) == 9 * percent
    assert len({r.k for r in got}) == (1 if percent < 30 else len({r.k for r in got}))


def test_draws_do_not_depend_on_partitions(spark):
    draws = [r.p for r in spark.range(500).select(sampling.draw(F.col("id"), 5, 40).alias("p")).collect()]
    assert draws == [int(hashlib.md5(f"5:{i}".encode()).hexdigest()[:15], 16) % 40 + 1 for i in range(500)]
    one, many = (spark.range(40).repartition(n) for n in (1, 9))
    samples = [sorted(r.id for r in sampling.resample(d, F.col("id"), 500, 5).collect()) for d in (one, many)]
    assert samples[0] == samples[1] and len(samples[0]) == 500


def test_copula_of_columns_with_nulls(spark):
    r = random.Random(3)
    rows = []
    for _ in range(3000):
        x = r.gauss(0, 1)
        rows.append((
            x if r.random() > 0.2 else None, x * 2 + r.gauss(0, 1) if x < 0.5 else None,
            r.choice(["a", "b", None]), None, 4.0,
        ))
    frame = spark.createDataFrame(rows, "x double, y double, c string, never double, same double")
    model = synthesis.fit(frame, ["x", "y", "never", "same"], ["c"])
    made = synthesis.sample(spark, model, 4000).cache()
    assert made.columns == ["id", "x", "y", "never", "same", "c"]
    for c in ("x", "y", "c"):
        share = frame.where(F.col(c).isNull()).count() / 3000
        assert made.where(F.col(c).isNull()).count() / 4000 == pytest.approx(share, abs=0.03)
    assert made.where("never is not null").count() == 0 and {r.same for r in made.select("same").distinct().collect()} == {4.0}
    complete = "x is not null and y is not null"
    assert made.where(complete).corr("x", "y") == pytest.approx(frame.where(complete).corr("x", "y"), abs=0.15)
    # y is missing where x is high: so it is in the synthetic rows
    high = made.where("x > 0.8")
    assert high.where("y is null").count() / high.count() > made.where("x < -0.8 and y is null").count() / made.where("x < -0.8").count() + 0.3


def test_nearest_correlation_has_no_negative_direction():
    bad = np.array([[1, 0.9, -0.9], [0.9, 1, 0.9], [-0.9, 0.9, 1.0]])
    near = synthesis._nearest_correlation(bad)
    assert np.allclose(np.diag(near), 1) and np.linalg.eigvalsh(near).min() > 0
    assert np.allclose(synthesis._nearest_correlation(np.eye(4)), np.eye(4))


def test_moments_give_the_correlations_of_the_rows_that_have_both(spark):
    r = random.Random(4)
    rows = [(r.gauss(0, 1), r.choice([None, -1.0, 0.5]), 2.0, float(i % 3)) for i in range(500)]
    rows = [(a, None if b is None else a + b, c, d) for a, b, c, d in rows]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    curves = {c: ([-10.0, 10.0], [-10.0, 10.0]) for c in "abc"}
    found = synthesis._correlations(synthesis._moments(frame, curves, [F.col("d")]))
    want = frame.agg(
        F.corr(F.when(F.col("b").isNotNull(), F.col("a")), "b").alias("ab"), F.corr("a", "d").alias("ad"),
        F.corr(F.when(F.col("b").isNotNull(), F.col("d")), "b").alias("bd"),
    ).first()
    assert np.allclose([found[0, 1], found[0, 3], found[1, 3]], list(want)) and np.allclose(found, found.T)
    assert found[0, 2] == found[1, 2] == 0 and np.allclose(np.diag(found), 1)


def test_synthesis_reads_the_tables_once(spark, sf_dir, monkeypatch):
    from tidewheel.plans import inputs, training_queries

    seen = []
    fit = synthesis.fit
    monkeypatch.setattr(synthesis, "fit", lambda df, *a: seen.append(df) or fit(df, *a))
    made = training_queries.synthetic_next_month(spark, sf_dir)
    assert made.count() == inputs.table(spark, sf_dir, "orders").count()
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()
