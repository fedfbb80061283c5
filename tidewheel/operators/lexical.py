"""Lexical search, fusion of ranked lists, and re-ranking of candidates."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidewheel.functions import nested, text
from tidewheel.operators.ranking import top_per_key
from tidewheel.operators.topk import Best
from tidewheel.session import materialize

# BM25 and fusion constants, column weights of the re-ranker.
K1 = 1.2
B = 0.75
FUSION_OFFSET = 60
COLUMN_WEIGHTS = {"text": 0.6, "title": 0.3, "summary": 0.1}
DIGITS = 6
SCAN_TERMS = 20_000  # (query, term) pairs that travel with one scan of the index
BLOCK_CELLS = 4_000_000  # query × document scores worked on at a time
JOIN_TERMS = 500_000  # (query, term) pairs that travel to the documents' terms at once
SHARD_DOCS = 4096  # documents of one piece of the index
SHARD_TERMS = 1 << 18  # and their terms, unless one document alone has more
BLOCK = 64  # postings of one block


def query_terms(queries: DataFrame) -> DataFrame:
    asked = queries.select("query_id", F.array_distinct(text.terms(F.col("text"))).alias("_t"))
    return nested.one_row_each(asked, "_t", "term").drop("_t")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, length, term, tf) for terms of the vocabulary only, all rows of an id in one partition.

    A document's terms are counted where it lies; what is shuffled is one row for each of its different terms
    that the vocabulary holds.
    """
    tokens = docs.select("id", text.terms(F.col("text")).alias("_t")).withColumn("length", F.size("_t"))
    kind = dict(tokens.dtypes)["id"]
    counted = tokens.select("id", "length", "_t").mapInArrow(_counted, f"id {kind}, length int, terms array<string>, tfs array<long>")
    pairs = counted.select("id", "length", F.arrays_zip("terms", "tfs").alias("_p"))
    hits = nested.one_row_each(pairs, "_p", "hit").select("id", "length", F.col("hit.terms").alias("term"), F.col("hit.tfs").alias("tf"))
    known = hits.join(vocabulary, "term", "left_semi").repartition("id")
    return known.groupBy("id", "length", "term").agg(F.sum("tf").alias("tf"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, length, terms) rows with each different term of a row once, and how often it occurs."""
    for batch in batches:
        for part in slices(batch, 2):
            words = part.column(2)
            lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = words.flatten().dictionary_encode()
            size = max(1, len(coded.dictionary))
            key, tf = np.unique(np.repeat(np.arange(len(lengths)), lengths) * size + np.asarray(coded.indices), return_counts=True)
            edges = pa.array(np.searchsorted(key, np.arange(len(lengths) + 1) * size).astype(np.int32))
            terms = pa.ListArray.from_arrays(edges, coded.dictionary.take(pa.array(key % size)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), terms, pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int64)))],
                names=["id", "length", "terms", "tfs"],
            )


def slices(batch: pa.RecordBatch, terms: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most SHARD_TERMS entries of the list column of number `terms`, a row at least."""
    stops = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(terms)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        before = int(stops[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(stops, before + SHARD_TERMS, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10, scan_terms: int = SCAN_TERMS) -> DataFrame:
    """Top-k documents per query: (query_id, id, score, rank). Inputs (id, text), (query_id, text).

    Documents are inverted where they lie, in pieces of bounded size (see `postings`), and searched there for
    blocks of queries of up to `scan_terms` (query, term) pairs; each piece hands on its k best, so no
    pair of a query and a document is shuffled, however common a term is. More pairs than `scan_terms`
    only mean more blocks over an index that is written once. Scores that round to 0 are no match. A null text
    counts as a document but not in the mean length, as SQL's avg does. Whole-number ids come back as
    long; other ids are matched by a join on terms, by the same rules.
    """
    whole_numbers = all(isinstance(df.schema[c].dataType, IntegralType) for df, c in ((docs, "id"), (queries, "query_id")))
    if whole_numbers:
        docs = docs.withColumn("id", F.col("id").cast("long"))
        queries = queries.withColumn("query_id", F.col("query_id").cast("long"))
    wanted = query_terms(queries)
    if scan_terms <= 0 or not whole_numbers:
        return _by_terms(docs, wanted, k)
    tokens = docs.select("id", text.terms(F.col("text")).alias("terms"))
    index, found = tokens.mapInArrow(postings, POSTINGS), None
    blocks = _query_blocks(wanted, scan_terms)
    first, second = next(blocks, None), next(blocks, None)
    if second is not None:
        index, tokens = materialize(index, "lexical"), None
    for block in itertools.chain([b for b in (first, second) if b is not None], blocks):
        part = _search(index, block, k, tokens)
        found = part if found is None else found.unionByName(part)
    return _ranked(found, k) if found is not None else _nothing(docs)


def _nothing(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], "query_id long, id long, score double, rank int")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return top_per_key(found, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def _by_terms(docs: DataFrame, wanted: DataFrame, k: int, join_terms: int = JOIN_TERMS) -> DataFrame:
    """The k best of all matching pairs, through an equi-join of document and query terms.

    Terms are partitioned by document, and the weights of a block of whole queries travel to them, so that a
    pair's parts meet where the document lies and each task hands on its k best: no pair is shuffled. More than
    about `join_terms` (query, term) pairs mean more blocks over the same partitions.
    """
    size = docs.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size(text.terms(F.col("text")))).alias("mean")
    ).first()
    blocks = max(1, -(-wanted.count() // join_terms))
    counts = term_counts(docs, wanted.select("term").distinct())
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (size["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = wanted.join(frequency, "term").select("query_id", "term", idf.alias("idf"))
    norm = K1 * (1 - B + B * F.col("length") / F.lit(size["mean"]))
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)
    found = None
    for block in range(blocks):
        mine = weights.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block) if blocks > 1 else weights
        scored = counts.join(F.broadcast(mine), "term").groupBy("query_id", "id")
        best = _ranked(scored.agg(F.round(F.sum(part), DIGITS).alias("score")).where("score > 0"), k)
        found = best if found is None else found.unionByName(best)
    return found


POSTINGS = (
    "ids array<long>, lengths array<int>, terms array<string>, df array<int>, docs array<int>, tfs array<int>, "
    "sizes array<int>, top_tf array<int>, least_length array<int>"
)


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, terms) rows as an inverted index, a row for each piece of at most SHARD_DOCS documents and SHARD_TERMS terms.

    A row holds the documents' ids and lengths (-1: no text), the terms with their document counts and, end to
    end, each term's postings in document order. They lie in blocks of BLOCK; a block's size, largest
    frequency and least length bound any score it can give.
    """
    held, size, terms = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD_DOCS):
            for part in slices(batch.slice(at, SHARD_DOCS), 1):
                words = len(part.column(1).flatten())
                if held and (size + part.num_rows > SHARD_DOCS or terms + words > SHARD_TERMS):
                    yield _inverted(pa.Table.from_batches(held))
                    held, size, terms = [], 0, 0
                held.append(part)
                size, terms = size + part.num_rows, terms + words
    if size:
        yield _inverted(pa.Table.from_batches(held))


def _inverted(piece: pa.Table) -> pa.RecordBatch:
    ids, words = (piece.column(i).combine_chunks() for i in range(2))
    given = pc.list_value_length(words)
    lengths = pc.fill_null(given, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    code = np.asarray(coded.indices, dtype=np.int64)
    key, tf = np.unique(code * len(lengths) + np.repeat(np.arange(len(lengths)), lengths), return_counts=True)
    term, doc = key // len(lengths), key % len(lengths)
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(starts, len(term)))
    block = np.flatnonzero((np.arange(len(term)) - np.repeat(starts, df)) % BLOCK == 0)
    whole = {
        "ids": ids, "lengths": pc.fill_null(given, -1), "terms": coded.dictionary.take(pa.array(term[starts])), "df": df,
        "docs": doc, "tfs": tf, "sizes": np.diff(np.append(block, len(term))),
        "top_tf": np.maximum.reduceat(tf, block) if len(block) else block,
        "least_length": np.minimum.reduceat(lengths[doc], block) if len(block) else block,
    }
    one_row = lambda v: pa.ListArray.from_arrays(
        pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int32()) if isinstance(v, np.ndarray) else v
    )
    return pa.RecordBatch.from_arrays([one_row(v) for v in whole.values()], names=list(whole))


def _query_blocks(wanted: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """(query, term) pairs in blocks of at most `most`, whole queries unless one alone is larger."""
    block: list[tuple[int, str]] = []
    rows = wanted.orderBy("query_id", "term").toLocalIterator()
    for query, pairs in itertools.groupby(((r["query_id"], r["term"]) for r in rows), key=lambda r: r[0]):
        pairs = list(pairs)
        if block and len(block) + len(pairs) > most:
            yield block
            block = []
        block += pairs
    if block:
        yield block


def _search(index: DataFrame, wanted: list[tuple[int, str]], k: int, tokens: DataFrame | None = None) -> DataFrame:
    """(query_id, id, score): the k best of each task's pieces for one block of queries.

    An index that is not written is made again out of `tokens`, in the worker that searches it.
    """
    spark = index.sparkSession
    named = spark.createDataFrame([(t,) for t in sorted({term for _, term in wanted})], "term string")
    given = F.filter("lengths", lambda x: x >= 0)
    total = F.aggregate(given, F.lit(0).cast("long"), lambda a, x: a + x)
    corpus = F.struct(F.lit(None).cast("string").alias("term"), F.size("ids").alias("n"), F.size(given).alias("texts"), total.alias("total"))
    listed = F.transform(F.arrays_zip("terms", "df"), lambda x: F.struct(
        x["terms"].alias("term"), x["df"].alias("n"), F.lit(0).alias("texts"), F.lit(0).cast("long").alias("total")
    ))
    rows = index.select(F.explode(F.concat(F.array(corpus), listed)).alias("row")).select("row.*")
    asked_for = rows.join(F.broadcast(named.withColumn("asked", F.lit(True))), "term", "left").where("asked or term is null")
    counted = asked_for.groupBy("term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"), F.sum("total").alias("total"))
    df = {r["term"]: r for r in counted.collect()}  # a row for each term of the block
    sums = df.pop(None, None)
    if sums is None:
        return spark.createDataFrame([], "query_id long, id long, score double")
    n, mean = sums["n"], max(sums["total"] / max(1, sums["texts"]), 1e-9)
    query_ids = np.array(sorted({q for q, _ in wanted}))
    place = {int(q): i for i, q in enumerate(query_ids)}
    asked: dict[str, list[int]] = {}
    for q, t in wanted:
        if t in df:
            asked.setdefault(t, []).append(place[q])
    idf = {t: float(np.log(1 + (n - r["n"] + 0.5) / (r["n"] + 0.5))) for t, r in df.items()}
    shared = spark.sparkContext.broadcast((query_ids, asked, idf))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, weights = shared.value
        best = Best(ids, k)
        least = np.full(len(ids), -np.inf)
        for batch in batches:
            for i in range(len(batch)):
                piece = {c: batch.column(j)[i].values for j, c in enumerate(batch.schema.names)}
                least = _score(piece, ids, terms, weights, mean, best, least)
        found = best.rows()
        if found is not None:
            yield found

    found = "query_id long, id long, score double"
    return index.mapInArrow(scan, found) if tokens is None else tokens.mapInArrow(lambda batches: scan(postings(batches)), found)


def _score(piece: dict, query_ids, asked, idf, mean: float, best: Best, least: np.ndarray) -> np.ndarray:
    """Add a piece's scores to the best; returns each query's k-th score so far.

    Lists come in falling order of weight. What the lists to come can still add bounds a document: a block is
    passed over for the queries none of whose documents in it can reach the k-th best score.
    """
    ids = np.asarray(piece["ids"])
    norm = K1 * (1 - B + B * np.maximum(np.asarray(piece["lengths"], dtype=np.float64), 0) / mean)
    df, all_docs, all_tfs, all_sizes, top, short = (
        np.asarray(piece[c], dtype=np.int64) for c in ("df", "docs", "tfs", "sizes", "top_tf", "least_length")
    )
    at_doc, at_block = np.append(0, np.cumsum(df)), np.append(0, np.cumsum(-(-df // BLOCK)))
    bounds = top * (K1 + 1) / (top + K1 * (1 - B + B * short / mean))
    names = list(asked)
    lists = []
    for term, i in zip(names, pc.index_in(pa.array(names, pa.string()), piece["terms"]).to_pylist()):
        if i is not None:
            docs, blocks = slice(at_doc[i], at_doc[i + 1]), slice(at_block[i], at_block[i + 1])
            lists.append((idf[term], term, all_docs[docs], all_tfs[docs], all_sizes[blocks], bounds[blocks]))
    lists.sort(key=lambda x: (-x[0], x[1]))
    step = max(1, BLOCK_CELLS // max(1, len(ids)))
    for at in range(0, len(query_ids), step):
        some = np.arange(at, min(at + step, len(query_ids)))
        scores = np.zeros((len(some), len(ids)))
        ahead = np.zeros(len(some))  # what lists not yet read can add to a query's documents
        mine = []
        for weight, term, docs, tfs, sizes, bound in lists:
            q = np.array([p - at for p in asked[term] if at <= p < at + len(some)], np.int64)
            if len(q):
                mine.append((weight, q, docs, tfs, sizes, bound))
                ahead[q] += weight * bound.max()
        for weight, q, docs, tfs, sizes, bound in mine:
            ahead[q] -= weight * bound.max()
            stops = np.cumsum(sizes)
            for begin, stop, most in zip((stops - sizes).tolist(), stops.tolist(), bound.tolist()):
                d = docs[begin:stop]
                held = scores[np.ix_(q, d)]
                alive = held.max(axis=1) + weight * most + ahead[q] + 10.0**-DIGITS >= least[some[q]]
                if alive.any():
                    part = weight * (tfs[begin:stop] * (K1 + 1) / (tfs[begin:stop] + norm[d]))
                    scores[np.ix_(q[alive], d)] = held[alive] + part
        scores = np.round(scores, DIGITS)
        whole = np.full((len(query_ids), len(ids)), -np.inf) if step < len(query_ids) else None
        found = np.where(scores > 0, scores, -np.inf)
        if whole is not None:
            whole[some] = found
            found = whole
        best.add(ids, found)
    if best.scores is not None and best.scores.shape[1] >= best.k:
        return np.where(np.isfinite(best.scores[:, -1]), best.scores[:, -1], -np.inf)
    return least


def fuse(first: DataFrame, second: DataFrame, k: int = 10) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists; a list that lacks a document adds nothing."""
    a = first.select("query_id", "id", F.col("rank").alias("rank_a"))
    b = second.select("query_id", "id", F.col("rank").alias("rank_b"))
    joined = a.join(b, ["query_id", "id"], "full_outer")

    def share(rank: str):
        return F.coalesce(F.lit(1.0) / (FUSION_OFFSET + F.col(rank)), F.lit(0.0))

    fused = joined.withColumn("score", F.round(share("rank_a") + share("rank_b"), 9))
    return top_per_key(fused, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def rerank(candidates: DataFrame, queries: DataFrame, docs: DataFrame, k: int = 5) -> DataFrame:
    """Candidates re-scored by the share of query terms found in text, title and summary.

    Equal scores keep the order they came in.
    """
    asked = queries.select("query_id", F.array_distinct(text.terms(F.col("text"))).alias("_q"))
    rows = candidates.select("query_id", "id", F.col("rank").alias("first_rank"))
    rows = rows.join(docs.select("id", *COLUMN_WEIGHTS), "id").join(asked, "query_id")
    score = F.lit(0.0)
    for column, weight in COLUMN_WEIGHTS.items():
        found = F.size(F.array_intersect("_q", text.terms(F.coalesce(F.col(column), F.lit("")))))
        score = score + F.lit(weight) * F.try_divide(found, F.size("_q"))
    scored = rows.select("query_id", "id", "first_rank", F.round(F.coalesce(score, F.lit(0.0)), DIGITS).alias("score"))
    return top_per_key(scored, ["query_id"], [F.col("score").desc(), F.col("first_rank")], k)
