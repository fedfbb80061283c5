"""Block-Max MaxScore against scoring every document, with its edge cases."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

pytest.importorskip("tidewheel.llm")
from tidewheel.llm import queries, ranked_search, words  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by the stated formula."""
    terms = [(i, Counter(cut(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in terms]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc_id, c), size in zip(terms, sizes):
            score = 0
            for t in cut(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * (75 + (25 * size * n) // total)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if missing else doc_id, -score))
    return sorted(out, key=str)


def table(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, term string")


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(1)
    vocab = ["der", "Über", "naïve", "the", "of"] + [f"w{i}" for i in range(300)]
    weights = [400, 3, 3, 500, 300] + [1000 / (i + 1) for i in range(300)]
    docs = [(None, None), (1, ""), (2, "... !\n"), (3, "The"), (3, "the\x00of"), (4, None)]
    docs += [(i, " ".join(r.choices(vocab, weights, k=r.randint(1, 120)))) for i in range(10, 1500)]
    docs += [(2000 + i, "w7 w8, w9") for i in range(60)] + [(None, "w7 w8"), (2001, "w7 w8, w9"), (2100, "w9 " * 70_000)]
    items = [(1, "w7 w8 w9 The"), (2, None), (3, ""), (4, "nowhere"), (5, "the of der"), (5, "ÜBER über Über naïve"), (None, "w200 w200 w7")]
    items += [(10 + i, " ".join(r.choices(vocab, k=r.randint(1, 30)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("shard_bytes", [3_000, 16 << 20])
def test_equals_scoring_all(spark, corpus, shard_bytes):
    docs, items = corpus
    index = ranked_search.build_index(table(spark, docs).repartition(3), shard_bytes)
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int")
    for k, query_bytes in [(20, 1 << 20), (3, 100)]:
        got = ranked_search.search(index, asked, k, query_bytes)
        assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def test_blocks_that_cannot_win_stay_packed():
    """One rare term decides: most blocks of the frequent lists are rejected by their bounds."""
    r = random.Random(2)
    docs = [(i, " ".join(r.choices([f"c{j}" for j in range(12)], k=40))) for i in range(6000)]
    for i in range(40):
        docs[i * 7] = (i * 7, docs[i * 7][1] + " rare rare")
    texts = words.Texts(pa.array([t.encode() for _, t in docs], pa.binary()), table=words.LETTERS)
    rows = pa.Table.from_batches([ranked_search.invert(0, pa.array([i for i, _ in docs], pa.int64()), [texts])])
    n, total = len(docs), sum(len(cut(t)) for _, t in docs)
    df = Counter(t for _, text in docs for t in set(cut(text)))
    weights = {t.encode(): math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    item = "rare c0 c1 c2"
    terms = ranked_search.Terms(weights, [(0, ranked_search.query_terms(item))], n, total)
    seen = []
    found = ranked_search.search_shard(
        rows.filter(pa.compute.or_kleene(pa.compute.is_null(rows["term"]), pa.compute.is_in(rows["term"], pa.array(list(terms.items[0][1]), pa.binary())))),
        terms, 10, lambda opened, blocks: seen.append((opened, blocks)),
    )
    want = [(d, s) for _, _, d, s in sorted(brute(docs, [(0, item)], 10), key=lambda x: x[1])]
    assert list(zip(found["doc_id"].to_pylist(), found["score"].to_pylist())) == want
    opened, blocks = seen[0]
    assert opened < blocks / 2


def test_empty_tables(spark, corpus):
    docs, items = corpus
    asked = spark.createDataFrame(items, "item_id long, text string")
    none = ranked_search.build_index(table(spark, docs).limit(0))
    assert ranked_search.search(none, asked).collect() == []
    some = ranked_search.build_index(table(spark, docs[:40]))
    assert ranked_search.search(some, asked.limit(0)).collect() == []


def test_registered_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op11_block_max_maxscore(spark, sf_dir)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 20)
