"""Lexical search over pieces of an index against scoring all pairs, and against the join."""

import math
import random
from collections import Counter

import pytest

from tidewheel.operators import lexical


def brute(docs, queries, k):
    terms = {i: (t.lower().split() if t is not None else None) for i, t in docs}
    n = len(docs)
    known = [len(t) for t in terms.values() if t is not None]
    mean = sum(known) / len(known)
    df = Counter(t for ts in terms.values() if ts for t in set(ts))
    out = set()
    for q, text in queries:
        scored = []
        for i, ts in terms.items():
            c, score = Counter(ts or []), 0.0
            for t in sorted(set((text or "").lower().split())):
                if c[t]:
                    norm = lexical.K1 * (1 - lexical.B + lexical.B * len(ts) / mean)
                    score += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * (lexical.K1 + 1) / (c[t] + norm)
            if round(score, lexical.DIGITS) > 0:
                scored.append((-round(score, lexical.DIGITS), i))
        out |= {(q, i, rank) for rank, (_, i) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(80)]
    docs = [(0, None), (1, ""), (2, "common"), (3, "COMMON w1")]
    docs += [(i, "common " + " ".join(r.choices(vocab, [1 / (j + 1) for j in range(80)], k=r.randint(1, 40)))) for i in range(4, 700)]
    queries = [(1, "common"), (2, "w1 w2 common nowhere"), (3, None), (4, ""), (5, "nowhere")]
    queries += [(10 + i, " ".join(r.choices(vocab, k=r.randint(1, 9)))) for i in range(15)]
    return docs, queries


def frames(spark, corpus):
    docs, queries = corpus
    return (
        spark.createDataFrame([(i, t, 9) for i, t in docs], "id long, text string, score int").repartition(3),
        spark.createDataFrame(queries, "query_id long, text string"),
    )


def places(frame):
    return {(r.query_id, r.id, r["rank"]) for r in frame.collect()}


@pytest.mark.parametrize("scan_terms,docs_each,block", [(20_000, 4096, 64), (7, 4096, 64), (20_000, 40, 4), (0, 4096, 64)])
def test_all_ways_equal_scoring_all(spark, corpus, monkeypatch, scan_terms, docs_each, block):
    monkeypatch.setattr(lexical, "SHARD_DOCS", docs_each)
    monkeypatch.setattr(lexical, "BLOCK", block)
    docs, queries = frames(spark, corpus)
    found = lexical.bm25(docs, queries, 6, scan_terms=scan_terms)
    assert places(found) == brute(*corpus, 6)


def test_a_term_of_every_document_has_one_rule(spark):
    """Its weight rounds to 0 in a corpus of copies, so it is no match either way."""
    docs = spark.range(4000).selectExpr("id", "'same' as text")
    queries = spark.createDataFrame([(1, "same")], "query_id long, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lexical, "DIGITS", 3)
        assert lexical.bm25(docs, queries).count() == lexical.bm25(docs, queries, scan_terms=0).count() == 0
    assert lexical.bm25(docs, queries).count() == lexical.bm25(docs, queries, scan_terms=0).count() == 10


def test_other_ids_are_joined_by_the_same_rules(spark, corpus):
    docs, queries = frames(spark, corpus)
    named = docs.selectExpr("lpad(string(id), 5, '0') as id", "text")
    found = {(q, int(i), rank) for q, i, rank in places(lexical.bm25(named, queries, 6))}
    assert found == brute(*corpus, 6)


def test_empty_tables(spark, corpus):
    docs, queries = frames(spark, corpus)
    assert lexical.bm25(docs.limit(0), queries).count() == 0
    assert lexical.bm25(docs, queries.limit(0)).count() == 0
    assert lexical.bm25(docs.where("text is null"), queries).count() == 0


def test_bounds_pass_over_blocks(spark, monkeypatch):
    """Once a rare term has filled the k best, blocks of a common one are not scored."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(lexical, "BLOCK", 8)
    rows = [(i, ["rare"] * 3 + ["often"] if i < 30 else ["often", f"x{i}"]) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"id": [i for i, _ in rows], "terms": [t for _, t in rows]})
    piece = next(iter(lexical.postings(iter([batch]))))
    held = {c: piece.column(j)[0].values for j, c in enumerate(piece.schema.names)}
    touched = []
    ix = np.ix_
    monkeypatch.setattr(np, "ix_", lambda *a: touched.append(len(a[1])) or ix(*a))
    from tidewheel.operators.topk import Best

    best = Best(np.array([1]), 5)
    asked, weights = {"rare": [0], "often": [0]}, {"rare": 4.0, "often": 0.01}
    least = lexical._score(held, np.array([1]), asked, weights, 2.0, best, np.array([-np.inf]))
    first = len(touched)
    assert least[0] > 4 and best.ids[0].tolist() == [0, 1, 2, 3, 4]
    lexical._score(held, np.array([1]), asked, weights, 2.0, best, least)
    assert len(touched) - first < first  # the second time most blocks are only looked at


def test_the_join_shuffles_no_pair(spark, corpus):
    """The parts of a pair meet where its document lies: no exchange by query and document."""
    import re

    docs, queries = frames(spark, corpus)
    found = lexical.bm25(docs, queries, 6, scan_terms=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(id#\d+L?, \d+\)", plan)
    assert not re.search(r"hashpartitioning\((query_id#\d+L?, id|id#\d+L?, query_id)#?", plan)


def test_blocks_of_the_join_and_repeated_ids(spark, corpus):
    docs, queries = frames(spark, corpus)
    wanted = lexical.query_terms(queries)
    assert places(lexical._by_terms(docs, wanted, 6, join_terms=9)) == brute(*corpus, 6)
    twice = docs.unionByName(docs.where("id = 2"))
    one, many = (lexical._by_terms(twice, wanted, 6, join_terms=n).collect() for n in (500_000, 9))
    assert sorted(one) == sorted(many) and len({(r.query_id, r.id) for r in one}) == len(one)


def test_pieces_hold_a_bounded_number_of_terms(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lexical, "SHARD_TERMS", 50)
    words = [["a", "b"] * 10, None, ["c"] * 200, [], ["a"] * 31, ["d"] * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(words, pa.list_(pa.string()))], names=["id", "terms"])
    pieces = list(lexical.postings(iter([batch, batch])))
    assert [i for p in pieces for i in p.column(0)[0].as_py()] == [*range(6), *range(6)]
    sums = [sum(max(0, n) for n in p.column(1)[0].as_py()) for p in pieces]
    assert max(sums) == 200 and sum(s > 50 for s in sums) == 2
