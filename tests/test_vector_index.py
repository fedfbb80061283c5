"""Both vector indexes against brute force: groups, copies, odd vectors, many blocks."""

import numpy as np
import pytest

from tidewheel.operators import vector_index, vectors


def grouped(n=1200, groups=30, dims=16, spread=0.05, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dims))
    return middle[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))


def frames(spark, corpus, asked):
    rows = spark.createDataFrame([(i, None if v is None else list(map(float, v)), 1) for i, v in enumerate(corpus)], "id long, vector array<double>, cell int")
    queries = spark.createDataFrame([(100 + i, list(map(float, v))) for i, v in enumerate(asked)], "query_id long, vector array<double>")
    return rows.repartition(4), queries


def brute(corpus, asked, k):
    ids = np.array([i for i, v in enumerate(corpus) if v is not None])
    known = vector_index.unit_rows(np.array([v for v in corpus if v is not None]))
    scores = np.round(vector_index.unit_rows(np.array(asked)) @ known.T, vector_index.DIGITS)
    return {(100 + q, int(ids[i]), r + 1) for q, row in enumerate(scores) for r, i in enumerate(np.lexsort((ids, -row))[:k])}


def ranked(frame):
    return {(r.query_id, r.id, r["rank"]) for r in frame.collect()}


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_search_visits_few_balls(spark, block):
    corpus, asked = grouped(), grouped(20, seed=3)
    rows, queries = frames(spark, corpus, asked)
    found, effort = vector_index.exact_top_k(vector_index.build(rows), queries, 5, block)
    assert ranked(found) == brute(corpus, asked, 5)
    seen = effort.collect()
    assert len(seen) == 20 and {r.vectors for r in seen} == {1200}
    assert sum(r.compared for r in seen) < 0.3 * sum(r.vectors for r in seen)
    assert all(0 < r.visited <= r.cells for r in seen)


def test_share_of_visits_falls_as_the_corpus_grows(spark):
    shares = []
    for n in (200, 3200):
        rows, queries = frames(spark, grouped(n), grouped(10))
        seen = vector_index.exact_top_k(vector_index.build(rows), queries, 3)[1].collect()
        shares.append(sum(r.compared for r in seen) / sum(r.vectors for r in seen))
    assert shares[1] < shares[0]


@pytest.mark.parametrize("k", [1, 5, 60])
def test_copies_nulls_zeros_and_extremes(spark, k):
    rng = np.random.default_rng(1)
    corpus = list(rng.normal(size=(150, 8))) + [np.ones(8)] * 400 + [None, np.zeros(8), np.full(8, 1e200), np.full(8, -1e-200), np.zeros(8)]
    asked = [np.ones(8), np.zeros(8), corpus[3], -np.ones(8) * 1e-300, rng.normal(size=8)]
    rows, queries = frames(spark, corpus, asked)
    want = brute(corpus, asked, k)
    assert ranked(vector_index.exact_top_k(vector_index.build(rows), queries, k)[0]) == want
    assert ranked(vectors.top_k_similar(rows, queries, k)) == want
    assert ranked(vectors.top_k_similar(rows, queries, k, query_batch=2)) == want


def test_doubles_stay_doubles_on_both_ways(spark):
    """Vectors that differ beyond 32 bits only: their scores and order are the same either way."""
    base = np.random.default_rng(5).normal(size=(300, 4))
    corpus = np.vstack([base, base * (1 + 1e-9), base + 1e-6])
    rows, queries = frames(spark, corpus, base[:40])
    near = {tuple(r) for r in vectors.top_k_similar(rows, queries, 5).collect()}
    assert near == {tuple(r) for r in vectors.top_k_similar(rows, queries, 5, query_batch=0).select("query_id", "id", "score", "rank").collect()}


@pytest.mark.parametrize("spread,least", [(0.3, 0.95), (5.0, 0.9)])
def test_codes_find_the_nearest(spark, spread, least):
    corpus, asked = grouped(3000, dims=24, spread=spread), grouped(30, dims=24, spread=spread, seed=9)
    rows, queries = frames(spark, corpus, asked)
    index = vector_index.build(rows, parts=7)
    found, effort = vector_index.approximate_top_k(index, queries, 5, probes=0.7, block=11)
    exact = {(q, i) for q, i, _ in brute(corpus, asked, 5)}
    got = found.collect()
    assert len({(r.query_id, r.id) for r in got} & exact) / len(exact) >= least
    assert len(got) == 150 and {r.candidates for r in effort.collect()} == {40}
    units = vector_index.unit_rows(corpus)
    for r in got[:20]:
        assert r.score == pytest.approx(float(vector_index.unit_rows(asked)[r.query_id - 100] @ units[r.id]), abs=2e-6)


def test_empty_corpus_and_no_queries(spark):
    rows, queries = frames(spark, grouped(50), grouped(3))
    none = vector_index.build(rows.where("vector is null"), parts=4)
    assert none is None and vector_index.approximate_top_k(none, queries)[0].count() == 0
    assert vector_index.exact_top_k(none, queries)[0].count() == 0
    some = vector_index.build(rows, parts=4)
    assert vector_index.exact_top_k(some, queries.limit(0))[0].count() == 0
    assert vector_index.approximate_top_k(some, queries.limit(0))[0].count() == 0


def test_distances_to_many_centres_are_held_in_parts():
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(3)
    points, centres = rng.normal(size=(4096, 8)), rng.normal(size=(4096, 8))
    tracemalloc.start()
    cell, far = vector_index.nearest_centre(points, centres)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 64 << 20  # all distances at once are 128 MB
    some = ((points[:50, None] - centres) ** 2).sum(axis=2)
    assert cell[:50].tolist() == some.argmin(axis=1).tolist() and np.allclose(far[:50] ** 2, some.min(axis=1))
