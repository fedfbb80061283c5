"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

Index. Each task cuts its rows into shards of some megabytes of text and inverts each shard: a row for
every (shard, term) holds the term's postings in blocks of 128, packed to one or two bytes a gap and one
to four a frequency, and for each block its first and last document and its competitive pairs, that is the
(frequency, length) pairs that no other of the block beats in both. One more row a shard holds the ids and
lengths of its documents. Nothing in the index depends on the corpus as a whole, so shards can be
added; the weights and block maxima follow from the statistics at the time of a search, and a block's
maximum is exact whatever they are, as a score rises with frequency and falls with length.

Search. Queries come in blocks of a bounded size. The rows of their terms meet by shard, and each shard
is searched for each query: lists whose bounds together stay below the k-th best score so far are
non-essential. Essential lists are read in windows of documents; a candidate then meets the non-essential
lists in falling order of bound, first their global bounds, then the maximum of the one block that may
hold it, and only blocks that some candidate survives are unpacked. The k best of each shard are merged.

Defined results: a null text has no terms and is never found. Every row is a document of its own, also
where rows or ids repeat; equal scores are ordered by ascending doc_id, null ids last. Every row of the
queries is an item; one without terms, or with none that occurs, gives no rows. Words are told
apart by 64-bit digests within a shard and by their bytes everywhere else.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import materialize, text_bytes

BLOCK = 128
#: Documents of the first window, whose scores set the bounds for the next, and of the largest one.
WINDOW, WIDEST = 256, 4096
#: Most text and documents of a shard; local document numbers fit in two bytes.
SHARD_BYTES, SHARD_DOCS = 16 << 20, 1 << 16
#: Most bytes of query text that one pass over the index takes.
QUERY_BYTES = 4 << 20
SCALE = 1_000_000_000

POSTINGS = (
    "shard long, term binary, df long, firsts array<int>, lasts array<int>, at array<int>, counts array<int>, "
    "kinds array<int>, pairs array<int>, tfs array<long>, lengths array<long>, data binary, ids array<long>"
)
FOUND = "item long, doc_id long, score long"


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _runs(change: np.ndarray) -> np.ndarray:
    """Where runs start, given a flag for each element that differs from the one before."""
    change[:1] = True
    return np.flatnonzero(change)


def invert(shard: int, doc_ids: pa.Array, texts: list[words.Texts]) -> pa.RecordBatch:
    """The rows of one shard; see above."""
    per_doc = np.concatenate([t.counts for t in texts]).astype(np.int64)
    doc = np.repeat(np.arange(len(per_doc), dtype=np.int32), per_doc)
    hashes = np.concatenate([t.hashes() for t in texts])
    order = np.argsort(hashes, kind="stable")  # by term, then by document
    hashes, doc = hashes[order], doc[order]
    same_term = np.zeros(len(order), bool)
    same_term[1:] = hashes[1:] == hashes[:-1]
    del hashes
    new_doc = ~same_term
    new_doc[1:] |= doc[1:] != doc[:-1]
    posting = _runs(new_doc)
    tf = np.diff(np.append(posting, len(order))).astype(np.int32)
    term_starts = _runs(~same_term[posting])
    docs, first_words = doc[posting], order[posting[term_starts]]
    del doc, order, new_doc, same_term, posting
    n_terms, n_postings = len(term_starts), len(docs)
    df = np.diff(np.append(term_starts, n_postings))
    # blocks: every BLOCK postings of a term
    within = np.arange(n_postings, dtype=np.int32) - np.repeat(term_starts.astype(np.int32), df)
    block_starts = np.flatnonzero(within % BLOCK == 0)
    del within
    counts = np.diff(np.append(block_starts, n_postings))
    block = np.repeat(np.arange(len(block_starts), dtype=np.int32), counts)
    blocks_of_term = -(-df // BLOCK)
    term_blocks = np.append(0, np.cumsum(blocks_of_term))
    gap = np.zeros(n_postings, np.int32)
    gap[1:] = docs[1:] - docs[:-1]
    gap[block_starts] = 0
    if n_postings:
        wide_gap = np.maximum.reduceat(gap, block_starts) > 0xFF
        most_tf = np.maximum.reduceat(tf, block_starts)
    else:
        wide_gap, most_tf = np.zeros(0, bool), np.zeros(0, np.int64)
    gap_bytes = 1 + wide_gap.astype(np.int64)
    tf_bytes = np.where(most_tf > 0xFFFF, 4, np.where(most_tf > 0xFF, 2, 1))
    size = counts * (gap_bytes + tf_bytes)
    block_at = np.append(0, np.cumsum(size))
    data = np.zeros(int(block_at[-1]), np.uint8)
    place = np.arange(n_postings, dtype=np.int32) - np.repeat(block_starts.astype(np.int32), counts)
    for values, widths, begin in (
        (gap, gap_bytes, block_at[:-1]), (tf, tf_bytes, block_at[:-1] + counts * gap_bytes)
    ):
        to = begin[block] + place * widths[block]
        for byte in range(4):
            rows = np.flatnonzero(widths[block] > byte)
            if len(rows):
                data[to[rows] + byte] = (values[rows] >> (8 * byte)) & 0xFF
    del gap, place, to, rows
    # competitive pairs: by rising length, those of a frequency above all before
    lengths = per_doc[docs]
    rank = np.empty(len(per_doc), np.int64)
    rank[np.argsort(per_doc, kind="stable")] = np.arange(len(per_doc))
    by_length = np.argsort(block.astype(np.int64) << 16 | rank[docs], kind="stable").astype(np.int32)
    top = int(tf.max()) + 1 if n_postings else 1
    high = np.maximum.accumulate(block[by_length].astype(np.int64) * top + tf[by_length]) if n_postings else np.zeros(0, np.int64)
    best = np.ones(n_postings, bool)
    best[1:] = (high[1:] > high[:-1])
    pairs = by_length[best]
    pairs_of_block = np.append(0, np.cumsum(np.bincount(block[pairs], minlength=len(block_starts))))
    # the words themselves
    word_bounds = np.append(0, np.cumsum([len(t.starts) for t in texts]))
    holders = np.searchsorted(word_bounds, first_words, side="right") - 1
    terms = [texts[h].word(i) for h, i in zip(holders.tolist(), (first_words - word_bounds[holders]).tolist())]
    data_at = block_at[term_blocks]
    columns = {
        "shard": pa.array(np.full(n_terms, shard), pa.int64()),
        "term": pa.array(terms, pa.binary()),
        "df": pa.array(df, pa.int64()),
        "firsts": _lists(docs[block_starts], term_blocks, pa.int32()),
        "lasts": _lists(docs[block_starts + counts - 1], term_blocks, pa.int32()),
        "at": _lists(block_at[:-1] - np.repeat(data_at[:-1], blocks_of_term), term_blocks, pa.int32()),
        "counts": _lists(counts, term_blocks, pa.int32()),
        "kinds": _lists(gap_bytes * 8 + tf_bytes, term_blocks, pa.int32()),
        "pairs": _lists(np.diff(pairs_of_block), term_blocks, pa.int32()),
        "tfs": _lists(tf[pairs], pairs_of_block[term_blocks], pa.int64()),
        "lengths": _lists(lengths[pairs], pairs_of_block[term_blocks], pa.int64()),
        "data": pa.Array.from_buffers(
            pa.binary(), n_terms, [None, pa.py_buffer(data_at.astype(np.int32)), pa.py_buffer(data)]
        ),
        "ids": pa.nulls(n_terms, pa.list_(pa.int64())),
    }
    lists = pa.RecordBatch.from_pydict(columns)
    empty = {f.name: pa.nulls(1, f.type) for f in lists.schema}
    whole = pa.RecordBatch.from_pydict(empty | {
        "shard": pa.array([shard], pa.int64()), "df": pa.array([int((per_doc > 0).sum())], pa.int64()),
        "lengths": _lists(per_doc, np.array([0, len(per_doc)]), pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
    })
    return pa.Table.from_batches([whole, lists]).combine_chunks().to_batches()[0]


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index all rows of docs (doc_id, text) in the shared folder; rows are as POSTINGS says."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, size, rows, made = [], [], 0, 0, 0
        first = TaskContext.get().partitionId() << 32

        def close() -> Iterator[pa.RecordBatch]:
            whole = invert(first + made, pa.concat_arrays(held), texts)
            for at in range(0, len(whole), 1 << 14):
                yield whole.slice(at, 1 << 14)

        for batch in batches:
            for part in words.pieces(batch, "text"):
                n_bytes = part.column("text").nbytes
                if held and (size + n_bytes > shard_bytes or rows + len(part) > SHARD_DOCS):
                    yield from close()
                    held, texts, size, rows, made = [], [], 0, 0, made + 1
                held.append(part.column("doc_id"))
                texts.append(words.Texts(part.column("text"), table=words.LETTERS))
                size, rows = size + n_bytes, rows + len(part)
        if held:
            yield from close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return materialize(rows.mapInArrow(shards, POSTINGS), "lexical-index")


@dataclass
class Terms:
    """Terms of a block of queries with their weights, and what lengths weigh."""

    weights: dict[bytes, int]
    items: list[tuple[int, dict[bytes, int]]]
    docs: int
    total: int

    def shares(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + (25 * lengths * self.docs) // max(1, self.total)

    def impacts(self, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What an occurrence of a term is worth before its weight; rises with tf, falls with length."""
        return (SCALE * tfs) // (1000 * tfs + 12 * self.shares(lengths))


class Postings:
    """One term's list in a shard: block bounds at hand, blocks unpacked when asked for."""

    def __init__(self, row: dict, terms: Terms, lengths: np.ndarray):
        self.terms, self.lengths = terms, lengths
        self.firsts, self.lasts, self.at, self.counts, self.kinds = (
            np.asarray(row[c]) for c in ("firsts", "lasts", "at", "counts", "kinds")
        )
        offsets = np.append(0, np.cumsum(row["pairs"]))[:-1]
        self.maxima = np.maximum.reduceat(terms.impacts(row["tfs"], row["lengths"]), offsets)
        self.most = int(self.maxima.max())
        self.data = row["data"]
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block, unpacked once."""
        if i not in self.open:
            n, kind, at = int(self.counts[i]), int(self.kinds[i]), int(self.at[i])
            docs = np.cumsum(np.frombuffer(self.data, f"<u{kind // 8}", n, at), dtype=np.int64) + int(self.firsts[i])
            tfs = np.frombuffer(self.data, f"<u{kind % 8}", n, at + n * (kind // 8)).astype(np.int64)
            self.open[i] = docs, self.terms.impacts(tfs, self.lengths[docs])
        return self.open[i]

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        begin, end = np.searchsorted(self.lasts, low), np.searchsorted(self.firsts, high)
        for i in range(begin, end):
            docs, impacts = self.block(i)
            if self.firsts[i] < low or self.lasts[i] >= high:
                inside = slice(*np.searchsorted(docs, [low, high]))
                docs, impacts = docs[inside], impacts[inside]
            yield docs, impacts

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each document the one block that may hold it, and that block's maximum (0: none)."""
        block = np.minimum(np.searchsorted(self.lasts, docs), len(self.lasts) - 1)
        may = (self.firsts[block] <= docs) & (docs <= self.lasts[block])
        return block, np.where(may, self.maxima[block], 0)

    def values(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Impacts of rising documents, all of which lie within the bounds of their blocks."""
        out = np.zeros(len(docs), np.int64)
        edges = np.append(_runs(np.diff(blocks, prepend=-1) != 0), len(blocks))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            held, impacts = self.block(int(blocks[a]))
            place = np.minimum(np.searchsorted(held, docs[a:b]), len(held) - 1)
            out[a:b] = np.where(held[place] == docs[a:b], impacts[place], 0)
        return out


class Best:
    """The k best documents of a query so far: by falling score, then rising id, null ids last."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, k: int):
        self.ids, self.missing, self.k = ids, missing, k
        self.docs, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = 1

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        if len(docs) > 4 * self.k:  # ties of the k-th score stay
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            docs, scores = docs[scores >= kth], scores[scores >= kth]
        order = np.lexsort((self.ids[docs], self.missing[docs], -scores))[: self.k]
        self.docs, self.scores = docs[order], scores[order]
        if len(order) == self.k:
            self.least = max(1, int(self.scores[-1]))


def max_score(lists: list[tuple[int, Postings]], n_docs: int, best: Best) -> None:
    """Add a shard's best documents for the lists (weight, postings) of one query."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    ceilings = np.cumsum([w * p.most for w, p in lists])
    low, width = 0, WINDOW
    while low < n_docs:
        high = min(n_docs, low + width)
        first = int(np.searchsorted(ceilings, best.least))  # lists before it cannot reach the k-th best together
        if first == len(lists):
            return
        sums = np.zeros(high - low, np.int64)
        for weight, postings in lists[first:]:
            for docs, impacts in postings.between(low, high):
                sums[docs - low] += weight * impacts
        docs = np.flatnonzero(sums)
        scores = sums[docs]
        docs = docs + low
        for i in range(first - 1, -1, -1):
            weight, postings = lists[i]
            alive = scores + ceilings[i] >= best.least
            docs, scores = docs[alive], scores[alive]
            blocks, maxima = postings.bounds(docs)
            below = int(ceilings[i - 1]) if i else 0
            alive = scores + weight * maxima + below >= best.least
            docs, scores, blocks, maxima = docs[alive], scores[alive], blocks[alive], maxima[alive]
            inside = np.flatnonzero(maxima)
            scores[inside] += weight * postings.values(docs[inside], blocks[inside])
        alive = scores >= best.least
        if alive.any():
            best.add(docs[alive], scores[alive])
        low, width = high, min(2 * width, WIDEST)


def _plain(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column in one chunk."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    return np.asarray(array.flatten()), np.append(0, np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(array), 0))))


def search_shard(rows: pa.Table, terms: Terms, k: int, opened: Callable[[int, int], None] | None = None) -> pa.Table:
    """The k best documents of one shard for each query; opened is told the blocks unpacked and all blocks."""
    whole = rows.filter(pa.compute.is_null(rows["term"]))
    lists = rows.filter(pa.compute.is_valid(rows["term"]))
    lengths = np.asarray(whole["lengths"].combine_chunks().flatten(), dtype=np.int64)
    ids = whole["ids"].combine_chunks().flatten()
    missing = np.asarray(ids.is_null())
    ids = np.asarray(pa.compute.fill_null(ids, 0))
    flat = {c: _plain(lists[c]) for c in ("firsts", "lasts", "at", "counts", "kinds", "pairs", "tfs", "lengths")}
    held: dict[bytes, Postings] = {}
    for i, (term, data) in enumerate(zip(lists["term"], lists["data"])):
        row = {c: values[offsets[i] : offsets[i + 1]] for c, (values, offsets) in flat.items()}
        held[term.as_py()] = Postings(row | {"data": data.as_buffer()}, terms, lengths)
    out: list[tuple[int, Best]] = []
    for item, wanted in terms.items:
        found = [(n * terms.weights[t], held[t]) for t, n in wanted.items() if t in held and terms.weights[t]]
        if found:
            best = Best(ids, missing, k)
            max_score(found, len(ids), best)
            out.append((item, best))
    if opened:
        opened(sum(len(p.open) for p in held.values()), sum(len(p.counts) for p in held.values()))
    docs = np.concatenate([b.docs for _, b in out]) if out else np.zeros(0, np.int64)
    return pa.table({
        "item": pa.array(np.repeat([i for i, _ in out], [len(b.docs) for _, b in out]).astype(np.int64)),
        "doc_id": pa.array(ids[docs], pa.int64(), mask=missing[docs]),
        "score": pa.array(np.concatenate([b.scores for _, b in out]) if out else docs, pa.int64()),
    })


def _searcher(shared, k: int) -> Callable[[pa.Table], pa.Table]:
    def ranked(rows: pa.Table) -> pa.Table:
        return search_shard(rows, Terms(*shared.value), k)

    return ranked


def query_terms(text: str | None) -> dict[bytes, int]:
    """Terms of a query with their numbers, cut as the documents are."""
    cut = words.Texts(pa.array([(text or "").encode()], pa.binary()), table=words.LETTERS)
    return Counter(cut.word(i) for i in range(len(cut.starts)))


def _blocks(queries: DataFrame, most_bytes: int) -> Iterator[list[tuple[object, dict[bytes, int]]]]:
    """(item_id, terms) of the queries in blocks of bounded text, without those that have no terms."""
    held, size = [], 0
    for row in queries.select("item_id", "text").toLocalIterator():
        terms = query_terms(row["text"])
        if not terms:
            continue
        if held and size + len(row["text"]) > most_bytes:
            yield held
            held, size = [], 0
        held.append((row["item_id"], terms))
        size += len(row["text"])
    if held:
        yield held


def search(index: DataFrame, queries: DataFrame, k: int = 20, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of queries (item_id, text)."""
    spark = index.sparkSession
    item_type = queries.schema["item_id"].dataType.simpleString()
    corpus = index.where("term is null").agg(
        F.coalesce(F.sum("df"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0)).alias("total"),
    ).first()
    found = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    for block in _blocks(queries, query_bytes):
        distinct = sorted(set().union(*(t for _, t in block)))
        wanted = spark.createDataFrame([(bytearray(t),) for t in distinct], "term binary")
        lists = index.join(F.broadcast(wanted), "term", "left_semi")  # no more than query_bytes of terms
        counted = lists.groupBy("term").agg(F.sum("df").alias("df")).collect()
        docs = corpus["docs"]
        weights = {bytes(r["term"]): math.floor(1000 * math.log((2 * docs + 2) / (2 * r["df"] + 1))) for r in counted}
        items = [(i, {t: n for t, n in ts.items() if t in weights}) for i, (_, ts) in enumerate(block)]
        shared = spark.sparkContext.broadcast((weights, items, docs, corpus["total"]))
        rows = index.where("term is null").unionByName(lists.select(index.columns))
        best = rows.groupBy("shard").applyInArrow(_searcher(shared, k), FOUND)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        merged = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(block)], f"item long, item_id {item_type}"
        )
        named = merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = found.unionByName(named)
    return found
