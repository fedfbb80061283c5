"""Ids that repeat, hubs, extreme vectors and clashing columns in the operators on pairs and in the mix."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tidewheel.llm")
from tidewheel.llm import components, embedding_tiles, jaccard_join, mixing  # noqa: E402


def roots(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in up if find(n) != n}


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_components_of_hubs_chains_and_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(components, "BROADCAST_ROWS", most)
    r = random.Random(1)
    pairs = [(5, i) for i in range(1000, 4000)] + [(i, i + 1) for i in range(10_000, 10_060)]
    pairs += [(r.randrange(20_000, 22_000), r.randrange(20_000, 22_000)) for _ in range(1500)] + [(10_030, 7), (3999, 7)]
    r.shuffle(pairs)
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(40)
    got = {x.node: x.component for x in components.components(edges).collect()}
    assert got == roots([p for p in pairs if p[0] != p[1]])


def test_one_group_of_20000_near_copies_over_211_partitions(spark):
    """Every task links its share to leaders of its own; one component comes out, with no node twice."""
    edges = spark.range(20_000, numPartitions=211).selectExpr("id as a", "id - id % 95 as b").union(
        spark.range(20_000, numPartitions=211).selectExpr("id as a", "(id * 7919) % 20000 as b")
    )
    found = components.components(edges)
    assert found.count() == found.select("node").distinct().count() == 19_999
    assert {r.component for r in found.select("component").distinct().collect()} == {0}


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    r = random.Random(2)
    a, b = ([f"{c}{r.randrange(500)}" for _ in range(200)] for c in "xy")
    near = lambda t: [*t[:-1], "changed"]
    texts = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, [f"z{i}" for i in range(50)]), (None, near(a)), (9, b)]
    for order in (texts, texts[::-1]):
        docs = spark.createDataFrame([(i, " ".join(t), 0) for i, t in order], "doc_id long, text string, row long")
        got = sorted((str(x.doc_id), x.component_id) for x in jaccard_join.similar_classes(docs, 3, 90).collect())
        assert got == [("1", 1), ("1", 1), ("2", 1), ("3", 1), ("4", 4), ("9", 1), ("None", 1)]


def test_an_id_in_two_labels_and_extreme_vectors(spark):
    r = np.random.default_rng(3)
    v = r.normal(size=8)
    w = v + 0.01 * r.normal(size=8)
    rows = [
        (7, v, 1), (8, w, 1), (7, v, 2), (9, -v, 2), (20, v * 1e200, 3), (21, v * 1e-200, 3), (22, v * 1e-300, 3), (23, -v * 1e150, 3),
        (6, w, 4), (7, v, 4), (5, w, 5), (5, v, 5),
    ]
    frame = spark.createDataFrame([(i, x.tolist(), label) for i, x, label in rows], "vec_id long, embedding array<double>, label int")
    got = sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in embedding_tiles.near_duplicates(frame, 0.98).collect())
    assert got == sorted([
        (7, 1, 7, True), (8, 1, 7, False), (7, 0, 7, True), (9, 0, 9, True), (20, 2, 20, True), (21, 2, 20, False), (22, 2, 20, False),
        (23, 0, 23, True), (6, 1, 6, True), (7, 1, 6, False), (5, 1, 5, True), (5, 1, 5, True),
    ])


def test_mix_takes_repeated_rows_as_planned(spark):
    rows = [(1, "one two three", "s", 5)] * 5 + [(1, "four five six", "s", 6)] * 2 + [(2, "a b", "t", 7)] * 3 + [(None, "x y z", None, 8)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copy int").repartition(3)
    planned = mixing.mix_to_weights(docs).groupBy("doc_id", "source").agg(F.sum("repeats").alias("n"))
    mixed = mixing.mixed_documents(docs, copy="mix_copy")
    assert sorted(mixed.columns) == ["doc_id", "mix_copy", "source", "text"]
    want = {(r.doc_id, r.source): r.n for r in planned.collect() if r.n}
    got = {(r.doc_id, r.source): r.n for r in mixed.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert mixing.mixed_documents(docs).columns == docs.columns[:3] + ["mix_copy"]
