"""Quantiles and distances of whole distributions against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import quality, ranking


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    out = []
    for w in ("a", "b", None, "late"):
        for _ in range(r.choice([1, 60, 400])):
            out.append((w, r.choice([None, r.gauss(0, 3), float(r.randrange(5))]), r.choice([1, 2, None])))
    return out + [("empty", None, None)] * 3 + [("one", 2.5, 1)] * 50


def frame(spark, rows):
    return spark.createDataFrame(rows, "w string, x double, y int").repartition(5)


def by_w():
    return {"w": F.col("w")}


def test_exact_quantiles(spark, rows):
    got = {(r.w, r.column_name): r for r in quality.numeric_profile(frame(spark, rows), by_w(), ["x", "y"]).collect()}
    for w in {r[0] for r in rows}:
        for i, c in ((1, "x"), (2, "y")):
            known = sorted(r[i] for r in rows if r[0] == w and r[i] is not None)
            found = got[w, c]
            assert found.distinct_count == len(set(known)) and found.row_count == sum(r[0] == w for r in rows)
            want = [float(known[max(0, int(np.ceil(q * len(known))) - 1)]) for q in quality.QUANTILES] if known else [None] * 3
            assert [found.q25, found.median, found.q75] == want


def test_sketched_quantiles_are_near(spark):
    frame = spark.range(200_000).selectExpr("id % 3 as w", "double((id * 7919) % 200000) as x", "cast(null as double) as y")
    for r in quality.numeric_profile(frame, by_w(), ["x", "y"], exact=False).collect():
        if r.column_name == "y":
            assert r.median is None and r.null_count == r.row_count
        else:
            assert abs(r.median - 100_000) < 2_000 and abs(r.q25 - 50_000) < 2_000 and abs(r.distinct_count / r.row_count - 1) < 0.05


def distances(a, b):
    points = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), points, side="right") / len(a)
    g = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(f - g).max(), float((np.abs(f - g)[:-1] * np.diff(points)).sum())


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_distances(spark, rows, seed):
    r = random.Random(seed)
    base = [("z", r.choice([None, r.gauss(seed, 2), float(r.randrange(4))]), None) for _ in range(300)]
    got = {(x.w, x.column_name): x for x in quality.exact_distances(frame(spark, rows), by_w(), frame(spark, base), ["x", "y"]).collect()}
    assert {c for _, c in got} == {"x"} and ("empty", "x") not in got  # no y in the base, no x in the window
    b = np.array([x for _, x, _ in base if x is not None])
    for w in {r[0] for r in rows} - {"empty"}:
        a = np.array([x for v, x, _ in rows if v == w and x is not None])
        if not len(a):
            assert (w, "x") not in got
            continue
        ks, area = distances(a, b)
        assert got[w, "x"].total == len(a)
        assert got[w, "x"].ks == pytest.approx(ks, abs=1e-12) and got[w, "x"].wasserstein == pytest.approx(area, abs=1e-9)


def test_distance_to_itself_is_zero(spark, rows):
    only = frame(spark, [x for x in rows if x[0] == "b"])
    for r in quality.exact_distances(only, {}, only, ["x", "y"]).collect():
        assert r.ks == 0 and r.wasserstein == pytest.approx(0, abs=1e-9)


def test_running_sums_of_fractions(spark):
    frame = spark.range(1000).selectExpr("id % 2 as k", "id", "id / 4 as w").repartition(7)
    got = {r.id: r.s for r in ranking.running_by_key(frame, ["k"], ["id"], {"s": "w"}).collect()}
    assert all(got[i] == pytest.approx(sum(range(i % 2, i, 2)) / 4) for i in got)
