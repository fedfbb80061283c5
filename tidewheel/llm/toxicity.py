"""Toxicity of whole texts by a classifier that swapped identity terms must not move.

A logistic model over the hashed distinct words of the whole text and their beginnings (which bind the
forms of a word together), each weighted by the log ratio of its share among toxic and clean texts. In training, a labelled text that names a group is also read with
the group's name swapped for another of its kind, and the squared change of the score is penalised:
weight moves from the names of groups to what is said.

Training takes a bounded sample of labelled rows (`train_rows`, the smallest by a seeded hash), which
one task fits; scoring reads every text whole in one pass without a shuffle. The model, a vector of
`2 ** bits` weights, is broadcast. The sample's ids are too: their number is that bound.

Defined results: a null or empty text has the score of the intercept. Labels other than 0 and 1 are
ignored; without labels of both kinds every text scores the smoothed share of toxic ones. Each row is
scored; repeated rows and null ids pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import text_bytes

U64 = words.U64
#: Bytes of a word's beginning that make a feature of their own.
PREFIX = 5
#: Names of groups by kind; a name is swapped for another of its kind. A parameter of the training.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "woman", "man"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "african", "european", "latino"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"), ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)


@dataclass(frozen=True)
class Training:
    train_rows: int = 16384
    bits: int = 18
    seed: int = 3
    epochs: int = 15
    batch: int = 256
    rate: float = 0.2
    l2: float = 2e-5
    swap_penalty: float = 1.0
    least_texts: int = 3
    identity: tuple[tuple[str, ...], ...] = field(default=IDENTITY_TERMS)


def held_out() -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _word_values(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, the value of the whole and that of its beginning."""
    start = np.zeros(len(texts.starts), dtype=U64)
    for i in range(PREFIX):
        at = np.minimum(texts.starts + i, texts.ends - 1)
        start |= np.where(texts.starts + i < texts.ends, texts.bytes[at], 0).astype(U64) << U64(8 * i)
    return texts.hashes(), words.mix(start ^ U64(0xA5A5A5A5A5A5A5A5))


def _features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, words.Texts, np.ndarray]:
    """(text number, feature) pairs, each once, with the texts and their word hashes."""
    texts = words.Texts(column, table=words.LETTERS)
    hashes, starts = _word_values(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), texts.counts)
    feature = (np.concatenate([hashes, starts]) & U64((1 << bits) - 1)).astype(np.int64)
    pairs = np.unique((np.concatenate([owner, owner]) << bits) | feature)
    return pairs >> bits, pairs & ((1 << bits) - 1), texts, hashes


def _swaps(hashes: np.ndarray, identity: tuple[tuple[str, ...], ...], bits: int) -> tuple[list[int], list[int]]:
    """Features that go and come when the names of groups in a text are swapped within their kind."""
    mask = (1 << bits) - 1
    present = set(hashes.tolist())
    gone, come = [], []
    for terms in identity:
        named = words.Texts(pa.array([t.encode() for t in terms]), table=words.LETTERS)
        values, starts = (x.tolist() for x in _word_values(named))
        for i, value in enumerate(values):
            j = (i + 1) % len(values)
            if value in present and values[j] not in present:
                gone += [value & mask, starts[i] & mask]
                come += [values[j] & mask, starts[j] & mask]
    return gone, come


def _fit(rows: list[dict], t: Training) -> np.ndarray:
    """Weights by feature with the intercept last."""
    size = 1 << t.bits
    y = np.array([r["toxic"] for r in rows], dtype=np.float64)
    prior = (y.sum() + 0.5) / (len(y) + 5.0)
    out = np.zeros(size + 1, dtype=np.float32)
    out[-1] = np.log(prior / (1 - prior))
    if not 0 < y.sum() < len(y):
        return out
    lists = [np.asarray(r["features"], dtype=np.int64) for r in rows]
    counts = np.array([len(x) for x in lists])
    index = np.concatenate(lists)
    begin = np.concatenate([[0], np.cumsum(counts)])
    label = np.repeat(y, counts)
    bad, good = np.bincount(index, label, size), np.bincount(index, 1 - label, size)
    ratio = np.log((bad + 0.5) / (y.sum() + 1)) - np.log((good + 0.5) / (len(y) - y.sum() + 1))
    ratio[bad + good < t.least_texts] = 0
    swaps = [
        (np.array(r["gone"], dtype=np.int64), np.array(r["come"], dtype=np.int64)) for r in rows
    ]
    # A swapped name may be unknown to the sample; it then counts as one without evidence.
    w, b = np.zeros(size), float(out[-1])
    square, square_b = np.full(size, 1e-6), 1e-6
    order = np.random.default_rng(t.seed)
    for _ in range(t.epochs):
        mixed = order.permutation(len(rows))
        for at in range(0, len(rows), t.batch):
            take = mixed[at : at + t.batch]
            own = np.concatenate([index[begin[i] : begin[i + 1]] for i in take])
            row = np.repeat(np.arange(len(take)), counts[take])
            z = np.bincount(row, (w * ratio)[own], len(take)) + b
            miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[take]) / len(take)
            grad = np.bincount(own, miss[row], size) * ratio + t.l2 * w
            for i in take:
                gone, come = swaps[i]
                if len(gone):
                    change = (w[come] * ratio[come]).sum() - (w[gone] * ratio[gone]).sum()
                    pull = 2 * t.swap_penalty * change / len(take)
                    np.add.at(grad, come, pull * ratio[come])
                    np.add.at(grad, gone, -pull * ratio[gone])
            square += grad * grad
            w -= t.rate * grad / np.sqrt(square)
            square_b += miss.sum() ** 2
            b -= t.rate * miss.sum() / np.sqrt(square_b)
    out[:-1], out[-1] = w * ratio, b
    return out


def train(docs: DataFrame, labels: DataFrame, t: Training = Training()) -> np.ndarray:
    """Fit on a bounded sample of labels (doc_id, toxic) of docs (doc_id, text)."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)").where(~held_out())
    sample = usable.orderBy(F.xxhash64(F.lit(t.seed), "doc_id"), "doc_id", "toxic").limit(t.train_rows)
    texts = docs.select("doc_id", text_bytes().alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id")  # at most train_rows ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.caches("toxicity")
        for batch in batches:
            for part in words.pieces(batch, "text"):
                owner, feature, texts, hashes = _features(part.column("text"), t.bits)
                cut = np.searchsorted(owner, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(feature, pa.int32()))
                moved = [_swaps(hashes[a:b], t.identity, t.bits) for a, b in zip(texts.bounds, texts.bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()), part.column("toxic"), lists,
                        pa.array([m[0] for m in moved], pa.list_(pa.int32())),
                        pa.array([m[1] for m in moved], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "toxic", "features", "gone", "come"],
                )

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
        rows = [
            {"toxic": y, "features": f.values.to_numpy(), "gone": g, "come": c}
            for y, f, g, c in zip(
                table.column("toxic").to_pylist(), table.column("features"),
                table.column("gone").to_pylist(), table.column("come").to_pylist(),
            )
        ]
        return pa.table({"weights": pa.array([_fit(rows, t).tobytes()], pa.binary())})

    read_rows = joined.mapInArrow(read, "doc_id long, toxic int, features array<int>, gone array<int>, come array<int>")
    got = read_rows.groupBy().applyInArrow(fit, "weights binary").first()
    return np.frombuffer(got["weights"], np.float32) if got else _fit([], t)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Every column of docs that is given besides text, with the score of its whole text."""
    bits = int(len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(text_bytes().alias("text"), F.struct(*[F.col(f"`{c}`") for c in names], F.col("text")).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.caches("toxicity")
        w = shared.value.astype(np.float64)
        for batch in batches:
            for part in words.pieces(batch, "text"):
                owner, feature, _, _ = _features(part.column("text"), bits)
                z = np.bincount(owner, w[feature], len(part)) + w[-1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], names=["row", "score"]
                )

    return rows.mapInArrow(judge, f"row {kind}, score double")
