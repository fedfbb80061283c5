"""Vector indexes around trained centres: exact search through balls, approximate search through codes.

Centres come from k-means over a bounded sample (SAMPLE rows of smallest id digest); their number
grows with the square root of the corpus. Every vector of the corpus is assigned to its nearest centre.

Exact search. A centre's vectors lie in a ball of known radius, which bounds the similarity of all of
them to a query. A query visits balls by falling bound, a growing number in each round, and stops when
the next bound is below its k-th best score so far. The result equals that of a full scan.

Approximate search. The residual of a vector, split into parts, is kept as the number of the nearest of
256 trained codewords for each part. A query's dot products with centres and codewords make
look-up tables; a scan adds them up for the probed cells and keeps the best candidates of each query,
which are then scored exactly.

Queries are taken in blocks of a stated size; each block's vectors, visits and tables are broadcast, and a
block's results are bounded by block size times k or candidates. Vectors are 64-bit throughout.
A null vector is left out; a zero vector has similarity 0 with everything. Scores are rounded to DIGITS and
equal ones ranked by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.ranking import top_per_key
from tidewheel.operators.topk import keep_best
from tidewheel.session import materialize

DIGITS = 6
SAMPLE = 1 << 14
MOST_CENTRES = 4096
ROUNDS = 8
#: Queries of one block: by exact search, and where look-up tables travel as well (32 KB a query at 16 parts).
QUERY_BLOCK, TABLE_BLOCK = 4096, 512
#: Parts of a code, and the share of cells whose codes are looked at.
PARTS, PROBES = 16, 0.6
#: Rows of the corpus that are scored at once.
STEP = 4096
#: Distances or scores that a task or the driver holds at once, 8 MB.
HELD = 1 << 20
CODEWORDS = 256


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay. Scaled by the largest component first, so nothing overflows."""
    matrix = np.asarray(matrix, dtype=np.float64)
    if not matrix.size:
        return matrix
    largest = np.abs(matrix).max(axis=1, keepdims=True)
    scaled = np.divide(matrix, largest, out=np.zeros_like(matrix), where=largest > 0)
    norm = np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.divide(scaled, norm, out=np.zeros_like(scaled), where=norm > 0)


def list_rows(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 42) -> np.ndarray:
    """Lloyd's rounds over a sample; an empty centre moves to the point farthest from its own."""
    rng = np.random.default_rng(seed)
    centres = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))].copy()
    for _ in range(rounds):
        nearest, far = _nearest(points, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        worst = np.argsort(-far, kind="stable")
        empty = np.flatnonzero(~filled)
        centres[empty] = points[worst[: len(empty)]]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the square of its distance, HELD distances at a time."""
    cell, far = np.zeros(len(points), np.int64), np.zeros(len(points))
    lengths, step = (centres**2).sum(axis=1), max(1, HELD // max(1, len(centres)))
    for at in range(0, len(points), step):
        part = points[at : at + step]
        squares = (part**2).sum(axis=1)[:, None] - 2 * part @ centres.T + lengths
        cell[at : at + step] = squares.argmin(axis=1)
        far[at : at + step] = squares[np.arange(len(part)), cell[at : at + step]]
    return cell, far


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and its distance."""
    cell = _nearest(points, centres)[0]
    return cell, np.linalg.norm(points - centres[cell], axis=1)


@dataclass
class Index:
    """Rows (id, vector, cell, reach[, code]) sorted by cell, with what bounds or approximates them."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray  # -inf for a centre without vectors
    counts: np.ndarray
    codewords: np.ndarray | None = None  # (parts, CODEWORDS, width)


def known(frame: DataFrame, key: str) -> DataFrame:
    return frame.where("vector IS NOT NULL").select(
        F.col(key).cast("long").alias(key), F.col("vector").cast("array<double>").alias("vector")
    )


def sample_of(corpus: DataFrame, rows: int = SAMPLE) -> np.ndarray:
    """Unit vectors of at most `rows` rows, those of smallest id digest."""
    picked = corpus.orderBy(F.md5(F.col("id").cast("string"))).limit(rows).select("vector").collect()
    return unit_rows([r["vector"] for r in picked]) if picked else np.zeros((0, 0))


def build(corpus: DataFrame, parts: int = 0, centres: int | None = None, sample: int = SAMPLE) -> Index | None:
    """Index all vectors of corpus (id, vector); parts > 0 adds codes of so many parts. None if there are none."""
    corpus = known(corpus, "id")
    points = sample_of(corpus, sample)
    if not len(points):
        return None
    if centres is None:
        centres = min(MOST_CENTRES, int(np.ceil(2 * np.sqrt(corpus.count()))))
    middle = k_means(points, centres)
    words = _codewords(points - middle[nearest_centre(points, middle)[0]], parts) if parts else None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                units = unit_rows(list_rows(part.column(1)))
                cell, reach = nearest_centre(units, middle)
                columns = [*part.columns, pa.array(cell.astype(np.int32)), pa.array(reach)]
                names = ["id", "vector", "cell", "reach"]
                if words is not None:
                    columns.append(pa.array([c.tobytes() for c in encode(units - middle[cell], words)], pa.binary()))
                    names.append("code")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id long, vector array<double>, cell int, reach double" + (", code binary" if parts else "")
    # Range partitions of (cell, id) keep a cell together in the files, and split one that is large.
    placed = corpus.mapInArrow(place, schema).repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
    rows = materialize(placed, "vector-index")
    radius, counts = np.full(len(middle), -np.inf), np.zeros(len(middle), np.int64)
    for r in rows.groupBy("cell").agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], counts[r["cell"]] = r["radius"], r["n"]
    return Index(rows, middle, radius, counts, words)


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query ids and unit vectors, so many at a time."""
    ids, vectors = [], []
    for row in queries.toLocalIterator():
        ids.append(row["query_id"])
        vectors.append(row["vector"])
        if len(ids) == size:
            yield np.array(ids), unit_rows(vectors)
            ids, vectors = [], []
    if ids:
        yield np.array(ids), unit_rows(vectors)


def _per_query(ids: list[np.ndarray], scores: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    best_ids, best = keep_best(np.concatenate(ids)[None, :], np.concatenate(scores)[None, :], k)
    return best_ids[0], best[0]


def _visit(rows: DataFrame, vectors: np.ndarray, wanted: np.ndarray, k: int) -> DataFrame:
    """(query, id, score): each task's k best for the queries (by place) that visit its rows' cells."""
    shared = rows.sparkSession.sparkContext.broadcast((vectors, wanted))
    cells = np.flatnonzero(wanted.any(axis=0)).tolist()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, visits = shared.value
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            cell = np.asarray(batch.column(2))
            edges = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                asked = np.flatnonzero(visits[:, cell[a]])
                for at in range(a, b, STEP):
                    part = batch.slice(at, min(STEP, b - at))
                    ids = np.asarray(part.column(0))
                    for some in range(0, len(asked), 256):
                        q = asked[some : some + 256]
                        scores = np.round(units[q] @ unit_rows(list_rows(part.column(1))).T, DIGITS)
                        best_ids, best = keep_best(np.broadcast_to(ids, scores.shape), scores, k)
                        for i, one in enumerate(q.tolist()):
                            before = held.get(one)
                            if before is None:
                                held[one] = best_ids[i], best[i]
                            else:
                                held[one] = _per_query([before[0], best_ids[i]], [before[1], best[i]], k)
        if held:
            yield pa.RecordBatch.from_pydict({
                "query": pa.array(np.repeat(list(held), [len(v[0]) for v in held.values()]).astype(np.int64)),
                "id": pa.array(np.concatenate([v[0] for v in held.values()])),
                "score": pa.array(np.concatenate([v[1] for v in held.values()])),
            })

    near = rows.where(F.col("cell").isin(cells)) if len(cells) < 1024 else rows
    found = near.select("id", "vector", "cell").mapInArrow(scan, "query long, id long, score double")
    return top_per_key(found, ["query"], [F.col("score").desc(), F.col("id")], k).select("query", "id", "score")


def exact_top_k(index: Index | None, queries: DataFrame, k: int = 5, block: int = QUERY_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(query_id, id, score, rank), and (query_id, visited, cells, compared, vectors) of what was looked at."""
    spark = queries.sparkSession
    answers = spark.createDataFrame([], "query_id long, id long, score double, rank int")
    effort = spark.createDataFrame([], "query_id long, visited long, cells long, compared long, vectors long")
    if index is None:
        return answers, effort
    filled = np.flatnonzero(np.isfinite(index.radius))
    for ids, units in _blocks(known(queries, "query_id"), block):
        centres = index.centres[filled]
        far = np.sqrt(np.maximum(0, (units**2).sum(axis=1)[:, None] - 2 * units @ centres.T + (centres**2).sum(axis=1)))
        least = np.maximum(0, far - index.radius[filled])  # distance to the nearest point of a ball
        bounds = 1 - least**2 / 2 + 10.0**-DIGITS  # no score of the ball, rounded, is above it
        order = np.argsort(-bounds, axis=1, kind="stable")
        ordered = np.take_along_axis(bounds, order, axis=1)
        reached = np.zeros(len(ids), np.int64)  # balls visited, in that order
        held: list[tuple[list, list]] = [([], []) for _ in ids]
        kth = np.full(len(ids), -np.inf)
        step = 1
        while True:
            stop = np.minimum(reached + step, (ordered >= kth[:, None]).sum(axis=1))
            if (stop <= reached).all():
                break
            wanted = np.zeros((len(ids), len(index.centres)), bool)
            for q in np.flatnonzero(stop > reached):
                wanted[q, filled[order[q, reached[q] : stop[q]]]] = True
            reached = np.maximum(reached, stop)
            for r in _visit(index.rows, units, wanted, k).collect():  # no more than block x k rows
                held[r["query"]][0].append(r["id"])
                held[r["query"]][1].append(r["score"])
            for q, (found, scores) in enumerate(held):
                if found:
                    best_ids, best = _per_query([np.array(found)], [np.array(scores)], k)
                    held[q] = best_ids.tolist(), best.tolist()
                    kth[q] = best[-1] if len(best) == k else -np.inf
            step *= 4
        rows = [
            (int(ids[q]), one, score, rank)
            for q, (found, scores) in enumerate(held) for rank, (one, score) in enumerate(zip(found, scores), 1)
        ]
        looked = [int(index.counts[filled[order[q, : reached[q]]]].sum()) for q in range(len(ids))]
        total = int(index.counts.sum())
        answers = answers.unionByName(spark.createDataFrame(rows, answers.schema))
        effort = effort.unionByName(spark.createDataFrame(
            [(int(q), int(n), len(filled), seen, total) for q, n, seen in zip(ids, reached, looked)], effort.schema
        ))
    return answers, effort


def _codewords(residuals: np.ndarray, parts: int) -> np.ndarray:
    """Trained codewords for each part of a residual; the last part is filled up with zeros."""
    width = -(-residuals.shape[1] // parts)
    padded = np.pad(residuals, ((0, 0), (0, parts * width - residuals.shape[1])))
    words = np.zeros((parts, CODEWORDS, width))
    for p in range(parts):
        found = k_means(padded[:, p * width : (p + 1) * width], CODEWORDS)
        words[p, : len(found)] = found
        words[p, len(found) :] = found[0]
    return words


def encode(residuals: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The nearest codeword's number for each part."""
    parts, _, width = words.shape
    padded = np.pad(residuals, ((0, 0), (0, parts * width - residuals.shape[1])))
    return np.stack(
        [nearest_centre(padded[:, p * width : (p + 1) * width], words[p])[0] for p in range(parts)], axis=1
    ).astype(np.uint8)


def approximate_top_k(
    index: Index | None, queries: DataFrame, k: int = 5, probes: float = PROBES, candidates: int | None = None,
    block: int = TABLE_BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(query_id, id, score, rank) out of `candidates` (8 k unless given) rows a query that look best by their codes,
    and (query_id, candidates, vectors) of how many were scored exactly.

    `probes` is the share of the cells, nearest first, whose codes are looked at. Scores are exact cosines.
    The index must have been built with codes. Rows of queries with one id count as one query.
    """
    spark = queries.sparkSession
    best = spark.createDataFrame([], "query_id long, id long, score double, rank int")
    effort = spark.createDataFrame([], "query_id long, candidates long, vectors long")
    if index is None:
        return best, effort
    candidates = candidates or 8 * k
    total = int(index.counts.sum())
    for ids, units in _blocks(known(queries, "query_id"), block):
        near = units @ index.centres.T
        filled = np.isfinite(index.radius)
        count = max(1, int(np.ceil(probes * filled.sum())))
        least = -np.partition(-np.where(filled, near, -np.inf), count - 1, axis=1)[:, count - 1]
        parts, _, width = index.codewords.shape
        padded = np.pad(units, ((0, 0), (0, parts * width - units.shape[1]))).reshape(len(ids), parts, width)
        tables = np.einsum("qpw,pcw->qpc", padded, index.codewords)
        picked = materialize(_by_codes(index.rows, ids, near, least, tables, candidates), "candidates")
        asked = spark.createDataFrame(
            [(int(i), v.tolist()) for i, v in zip(ids, units)], "query_id long, asked array<double>"
        ).dropDuplicates(["query_id"])
        pairs = index.rows.select("id", "vector").join(picked, "id").join(asked, "query_id")
        scored = pairs.select("query_id", "id", _cosine(F.col("vector"), F.col("asked")).alias("score"))
        best = best.unionByName(top_per_key(scored, ["query_id"], [F.col("score").desc(), F.col("id")], k))
        counted = picked.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"))
        effort = effort.unionByName(counted.withColumn("vectors", F.lit(total).cast("long")))
    return best, effort


def _by_codes(rows: DataFrame, ids: np.ndarray, near: np.ndarray, least: np.ndarray, tables: np.ndarray, keep: int) -> DataFrame:
    """(query_id, id): the best rows of each query by centre and codes, from one scan without a shuffle of rows."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, near, least, tables))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, centre, lowest, lookup = shared.value
        held = held_ids = None
        step = max(2 * keep, HELD // len(query_ids))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                cell, numbers = np.asarray(part.column(1)), np.asarray(part.column(0))
                codes = np.frombuffer(b"".join(c.as_py() for c in part.column(2)), np.uint8).reshape(len(part), -1)
                scores = centre[:, cell].copy()
                scores[scores < lowest[:, None]] = -np.inf
                for p in range(codes.shape[1]):
                    scores += lookup[:, p, codes[:, p]]
                found = np.broadcast_to(numbers, scores.shape)
                if held is not None:
                    scores, found = np.hstack([held, scores]), np.hstack([held_ids, found])
                if scores.shape[1] > keep:
                    top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                    scores, found = np.take_along_axis(scores, top, 1), np.take_along_axis(found, top, 1)
                held, held_ids = scores, found
        if held is not None:
            q, place = np.nonzero(np.isfinite(held))
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(query_ids[q]), "id": pa.array(held_ids[q, place]), "near": pa.array(held[q, place]),
            })

    found = rows.select("id", "cell", "code").mapInArrow(scan, "query_id long, id long, near double")
    top = top_per_key(found, ["query_id"], [F.col("near").desc(), F.col("id")], keep)
    return top.select("query_id", "id").dropDuplicates()


def _cosine(a, b):
    """Cosine of two vectors as the scan computes it; 0 where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda m, n: m * n), F.lit(0.0), lambda s, v: s + v)
    length = F.sqrt(dot(a, a) * dot(b, b))
    return F.round(F.when(length > 0, dot(a, b) / length).otherwise(0.0), DIGITS)
