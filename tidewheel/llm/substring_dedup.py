"""Exact substring deduplication with fixed-block anchors.

A passage is a window of `span` words whose word sequence also starts anywhere else, in the same text
or another. Every window of 35 words holds one whole block of 18 words that starts at a multiple of
18. So the index needs only the non-overlapping blocks of each text (one word in 18), while every
rolling 18-word window of every text probes it. A probe that meets a block elsewhere is a hit; a hit
is extended over all 35-word windows around it, and those that have an equal elsewhere are confirmed.
Adjoining confirmed windows make up the maximal exact repeats, whose words go.

How it is spread: texts travel once, in packs of a few MB, dealt by pack. Each pack sends to each hash
part one row with its distinct probe tags (32 bits besides the part, sorted by byte plane), and the
part sends back which of them met a block. Packs hash the windows around hits (64 bits) and ask the
parts in the same way which of those occur twice. A block or window that a third of all texts share
is one entry for each pack, never a list of pairs; nothing is emitted for pairs of occurrences.

Tags only choose candidates: a false one costs a probe more. Confirmation is by equal 64-bit digests
of 35 words, which differ for different sequences but for a chance of about n * n / 2**65.

Defined results: a null text has no words and keeps its row with an empty text. Windows are judged on
the input, so all copies of a passage go, also from repeated rows. Words are unchanged; the kept ones
are joined by one space. Ids and further columns pass through; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import text_bytes, width

SPAN = 35
PACK_BYTES = 1 << 21
U64 = words.U64


def block_words(span: int) -> int:
    """The longest block such that every window of span words holds a whole aligned one."""
    return (span + 1) // 2


# --- packs -------------------------------------------------------------------------------------

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to packs: one row with many texts, compressed together, and their other columns."""
    home, seq = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in words.pieces(batch, "text", PACK_BYTES):
            column = part.column("text")
            sizes = np.asarray(pa.compute.binary_length(column), dtype=np.int64)
            data = squeeze.compress(b"".join(column.to_pylist()))
            whole = np.array([0, len(part)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(home << 32) + seq], pa.int64()), pa.array([data], pa.binary()),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(whole), part.column("rest")),
                ],
                names=["pack_id", "data", "sizes", "rest"],
            )
            seq += 1


def _texts(data: bytes, sizes: list[int]) -> words.Texts:
    plain = zstandard.ZstdDecompressor().decompress(data)
    offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(plain)]
    )
    return words.Texts(column)


# --- sorted integers as bytes ------------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Sorted integers by byte plane: the leading planes are runs, which compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplanes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(size, len(raw) // size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _gaps(places: np.ndarray) -> bytes:
    """Ascending places as gaps of one byte; 255 stands for 255 further places without an entry."""
    steps = np.diff(places, prepend=0)
    ends = np.cumsum(steps // 255 + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, dtype=np.uint8)
    out[ends] = steps % 255
    return out.tobytes()


def _ungaps(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


# --- probes and blocks -------------------------------------------------------------------------

class Probes:
    """The distinct rolling windows of one pack by part and tag, with what the pack knows itself."""

    def __init__(self, texts: words.Texts, hashes: np.ndarray, block: int, parts: int):
        self.places = np.flatnonzero(texts.valid(block))
        values = words.windows(hashes, block)[self.places] if len(self.places) else hashes[:0]
        scaled = (values >> U64(16)) * U64(parts)
        key = ((scaled >> U64(48)) << U64(32)) | ((scaled >> U64(16)) & U64(0xFFFFFFFF))
        first = np.repeat(texts.bounds[:-1], texts.counts)
        aligned = (self.places - first[self.places]) % block == 0
        self.aligned = aligned
        self.keys, self.inverse = np.unique(key, return_inverse=True)
        blocks = np.bincount(self.inverse[aligned], minlength=len(self.keys)) if len(self.keys) else np.zeros(0, int)
        self.kind = np.minimum(blocks, 2)
        self.part = (self.keys >> U64(32)).astype(np.int64)

    def requests(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """For each part: the tags with none, one, and more blocks of this pack behind them."""
        edges = np.flatnonzero(np.diff(self.part, prepend=-1))
        tags = (self.keys & U64(0xFFFFFFFF)).astype(np.uint32)
        for a, b in zip(edges, np.append(edges[1:], len(self.part))):
            own, kind = tags[a:b], self.kind[a:b]
            yield (int(self.part[a]), *(_planes(own[kind == k]) for k in (0, 1, 2)))

    def hits(self, answers: list[dict]) -> np.ndarray:
        """Word places where a probe meets a block elsewhere."""
        met = self.kind == 2
        for answer in answers:
            a, b = np.searchsorted(self.part, [answer["part"], answer["part"] + 1])
            for k, name in ((0, "none"), (1, "one")):
                own = a + np.flatnonzero(self.kind[a:b] == k)
                met[own[_ungaps(answer[name])]] = True
        at = met[self.inverse] | ((self.kind == 1)[self.inverse] & ~self.aligned)
        return self.places[at]


ASK = "part int, pack_id long, none binary, one binary, more binary"
TELL = "pack_id long, part int, none binary, one binary"


def _tell_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All requests of a part: count the blocks behind each tag, answer each pack."""
    rows = [r for b in batches for r in b.to_pylist()]
    for part in sorted({r["part"] for r in rows}):
        mine = [r for r in rows if r["part"] == part]
        one = np.concatenate([_unplanes(r["one"], np.uint32) for r in mine])
        more = np.concatenate([_unplanes(r["more"], np.uint32) for r in mine])
        tags, inverse = np.unique(np.concatenate([one, more]), return_inverse=True)
        if not len(tags):
            continue
        weight = np.concatenate([np.ones(len(one)), np.full(len(more), 2.0)])
        twice = np.bincount(inverse, weight) >= 2
        out = []
        for r in mine:
            told = []
            for name, wanted in (("none", None), ("one", twice)):
                asked = _unplanes(r[name], np.uint32)
                at = np.minimum(np.searchsorted(tags, asked), len(tags) - 1)
                good = tags[at] == asked if wanted is None else wanted[at]
                told.append(_gaps(np.flatnonzero(good)))
            if any(told):
                out.append((r["pack_id"], part, *told))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["pack_id", "part", "none", "one"],
            )


def _tell_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All window digests of a part: tell each pack which of its own occur again elsewhere."""
    rows = [r for b in batches for r in b.to_pylist()]
    for part in sorted({r["part"] for r in rows}):
        mine = [r for r in rows if r["part"] == part]
        one = [_unplanes(r["one"], np.uint64) for r in mine]
        more = [_unplanes(r["more"], np.uint64) for r in mine]
        values, counts = np.unique(np.concatenate(one + more + more), return_counts=True)
        again = values[counts > 1]
        out = []
        for r, own in zip(mine, one):
            at = np.minimum(np.searchsorted(again, own), max(0, len(again) - 1))
            good = own[again[at] == own] if len(again) else own[:0]
            if len(good):
                out.append((r["pack_id"], _planes(good)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary()))], names=["pack_id", "again"]
            )


# --- the operator ------------------------------------------------------------------------------

def dedup_substrings(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Cut every passage of `span` words that occurs again from the texts of docs (doc_id, text, ...).

    Returns for each row: row (a struct of all columns of docs but text), kept_text, n_words, n_removed.
    """
    spark, block = docs.sparkSession, block_words(span)
    parts = min(width(spark), 65535)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(text_bytes().alias("text"), rest.alias("rest"))
    rest_type = rows.schema["rest"].dataType.simpleString()
    pack_type = f"pack_id long, data binary, sizes array<long>, rest array<{rest_type}>"
    packs = rows.mapInArrow(_packed, pack_type).repartition(parts, "pack_id")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                texts = _texts(row.column("data")[0].as_py(), row.column("sizes")[0].as_py())
                yield row, texts, texts.hashes()

    def ask_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, hashes in opened(batches):
            out = list(Probes(texts, hashes, block, parts).requests())
            if out:
                part, none, one, more = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()), pa.array([row.column("pack_id")[0].as_py()] * len(out), pa.int64()),
                        pa.array(none, pa.binary()), pa.array(one, pa.binary()), pa.array(more, pa.binary()),
                    ],
                    names=["part", "pack_id", "none", "one", "more"],
                )

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, hashes in opened(batches):
            answers = row.column("told")[0].as_py() or []
            hit = np.zeros(len(hashes) + block + 1, dtype=np.int64)
            hit[Probes(texts, hashes, block, parts).hits(answers) + 1] = 1
            sums = np.cumsum(hit)
            room = span - block + 1
            starts = np.flatnonzero(texts.valid(span))
            starts = starts[sums[starts + room] > sums[starts]]
            if not len(starts):
                continue
            values, counts = np.unique(words.windows(hashes, span)[starts], return_counts=True)
            part = (((values >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            pairs = list(zip(edges, np.append(edges[1:], len(part))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[edges], pa.int32()),
                    pa.array([row.column("pack_id")[0].as_py()] * len(pairs), pa.int64()),
                    pa.array([_planes(values[a:b][counts[a:b] == 1]) for a, b in pairs], pa.binary()),
                    pa.array([_planes(values[a:b][counts[a:b] > 1]) for a, b in pairs], pa.binary()),
                ],
                names=["part", "pack_id", "one", "more"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, hashes in opened(batches):
            told = row.column("told")[0].as_py() or []
            starts = np.flatnonzero(texts.valid(span))
            covered = np.zeros(len(hashes) + span + 1, dtype=np.int64)
            if len(starts):
                values = words.windows(hashes, span)[starts]
                own, counts = np.unique(values, return_counts=True)
                again = np.concatenate([own[counts > 1], *(_unplanes(t, np.uint64) for t in told)])
                begins = starts[np.isin(values, again)]
                covered[begins] += 1
                covered[begins + span] -= 1
            gone = np.cumsum(covered)[: len(hashes)] > 0
            sums = np.concatenate([[0], np.cumsum(gone)])
            removed = sums[texts.bounds[1:]] - sums[texts.bounds[:-1]]
            kept = []
            for i in range(len(texts)):
                own_words = texts.text(i).split()
                if removed[i]:
                    own_words = compress(own_words, ~gone[texts.bounds[i] : texts.bounds[i + 1]])
                kept.append(b" ".join(own_words))
            yield pa.RecordBatch.from_arrays(
                [row.column("rest").flatten(), pa.array(kept, pa.binary()), pa.array(texts.counts), pa.array(removed)],
                names=["row", "kept_text", "n_words", "n_removed"],
            )

    def told(answers: DataFrame, *fields: str) -> DataFrame:
        value = F.struct(*fields) if len(fields) > 1 else F.col(fields[0])
        return packs.join(answers.groupBy("pack_id").agg(F.collect_list(value).alias("told")), "pack_id", "left")

    asked = packs.mapInArrow(ask_blocks, ASK).repartitionById(parts, F.col("part"))
    met = told(asked.mapInArrow(_tell_blocks, TELL), "part", "none", "one")
    windows_asked = met.mapInArrow(ask_windows, "part int, pack_id long, one binary, more binary")
    again = windows_asked.repartitionById(parts, F.col("part")).mapInArrow(_tell_windows, "pack_id long, again binary")
    return told(again, "again").mapInArrow(
        cut, f"row {rest_type}, kept_text binary, n_words long, n_removed long"
    ).withColumn("kept_text", F.col("kept_text").cast("string"))
