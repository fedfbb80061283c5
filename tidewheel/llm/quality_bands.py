"""Quality rules by compression bands, with base counts of words, symbols and repeats.

A text passes when zstandard shrinks it neither too much (repetition) nor too little (noise). The
limits depend on its length: a frame costs a dozen bytes and short texts give the compressor little
to refer back to, so their ratios are higher by nature. Long texts are also cut into fixed chunks, the
last of which ends with the text; that finds a repetitive or random stretch inside an otherwise ordinary text.

One pass over the rows, no shuffle: each row is judged alone, in Arrow batches cut to a few MB.

Defined results: a null text counts as empty; no words gives zeros, base_failed, not kept. Lines
count as equal when their bytes are. Repeated rows are judged each; ids pass through, null as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import text_bytes

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SPAN = 8


@dataclass(frozen=True)
class Bands:
    """Ratios of compressed to plain bytes that pass: (bytes from, least, most) by length.

    The least ratios lie well below those of prose in any of the alphabets at hand and above those of
    texts that say one thing over and over; the most lie above prose and below base64 or hex noise.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0), (128, 0.35, 1.05), (256, 0.33, 0.95), (512, 0.30, 0.85), (1024, 0.27, 0.78),
        (2048, 0.25, 0.72), (4096, 0.23, 0.70), (16384, 0.20, 0.70), (65536, 0.15, 0.70),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.20, 0.72)
    #: share of a text's chunks that may lie outside
    chunk_share: float = 0.25
    level: int = 3


OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, bad_chunks long, n_chunks long, kept boolean"
)


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated_words(texts: words.Texts, span: int = SPAN) -> np.ndarray:
    """Words of each text inside a window of that many words that the text holds twice or more."""
    hashes = texts.hashes()
    n = len(hashes)
    usable = np.flatnonzero(texts.valid(span))
    if not len(usable):
        return np.zeros(len(texts), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), texts.counts)
    keys = words.mix(words.windows(hashes, span)[usable] ^ words.mix(owner[usable] + words.U64(1)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = usable[counts[inverse] > 1]
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + span, -1)
    return _per_text(np.cumsum(change[:-1]) > 0, texts.bounds)


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _ratios(text: bytes, squeeze: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, its chunks outside the chunk band, all chunks, and the verdict."""
    size = len(text)
    if not size:
        return 0.0, 0, 0, False
    ratio = len(squeeze.compress(text)) / size
    least, most = next((low, high) for start, low, high in reversed(bands.whole) if size >= start)
    step, bad = bands.chunk_bytes, 0
    starts = list(range(0, size - step + 1, step))
    if starts and size % step:
        starts.append(size - step)  # the rest is judged in a chunk that ends with the text
    chunks = len(starts)
    for at in starts:
        got = len(squeeze.compress(text[at : at + step])) / step
        bad += not bands.chunk[0] <= got <= bands.chunk[1]
    return ratio, bad, chunks, least <= ratio <= most and bad <= bands.chunk_share * chunks


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Base counts and the verdict of the compression bands for each row of docs (doc_id, text)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for part in words.pieces(batch, "text"):
                texts = words.Texts(part.column("text"))
                raw = texts.bytes
                inside = np.zeros(len(raw) + 1, dtype=np.int8)
                inside[texts.starts] += 1
                np.add.at(inside, texts.ends, -1)
                in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
                chars = _per_text(in_word & ((raw & 0xC0) != 0x80), texts.offsets)
                symbols = _per_text(_SYMBOL[raw], texts.offsets)
                breaks = _per_text(raw == 10, texts.offsets)
                repeats = repeated_words(texts)
                plain = [texts.text(i) for i in range(len(texts))]
                lines = [_duplicate_lines(t) if breaks[i] else 0 for i, t in enumerate(plain)]
                verdicts = [_ratios(t, squeeze, bands) for t in plain]
                failed = (texts.counts < 20) | (100 * repeats > 30 * texts.counts)
                good = np.array([v[3] for v in verdicts], dtype=bool) & ~failed
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(texts.counts), pa.array(chars), pa.array(symbols),
                        pa.array(lines, pa.int64()), pa.array(repeats), pa.array(failed),
                        pa.array([v[0] for v in verdicts], pa.float64()), pa.array([v[1] for v in verdicts], pa.int64()),
                        pa.array([v[2] for v in verdicts], pa.int64()), pa.array(good),
                    ],
                    names=[c.split()[0] for c in OUT.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(judge, OUT)
