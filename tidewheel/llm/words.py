"""Words and hashed windows of whole texts, vectorised over Arrow batches.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D); in UTF-8 that is the same
as a run of such characters. Texts travel as binary columns, so no text is decoded for hashing.
"""

from __future__ import annotations

import gc
import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BLOCK = 1 << 20
_LONG_WORD = 1 << 16
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Lower case with all ASCII but letters and digits as spaces: tokens of letters, for features.
LETTERS = LOWER.copy()
LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def keyed(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values of a seed."""
    start = (seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(start))


_BYTE = keyed(11, 256) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def worker_state() -> dict:
    """What a Python worker keeps from task to task. (Task functions travel by value, globals with them.)"""
    return sys.modules.setdefault("tidewheel_worker_state", types.ModuleType("tidewheel_worker_state")).__dict__


def caches(operator: str) -> dict:
    """What a worker keeps between tasks of an operator; what it kept for another one is let go."""
    state = worker_state()
    if state.get("operator") != operator:
        state["operator"], state["caches"] = operator, {}
        gc.collect()
    return state["caches"]


def _powers() -> list[np.ndarray]:
    state = worker_state()
    if "powers" not in state:
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(_BLOCK + 1, base, dtype=U64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=U64))
        state["powers"] = tables
    return state["powers"]


class Texts:
    """Whole texts of a batch with the byte range of each word."""

    def __init__(self, column: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = int(offsets[0]) if len(offsets) else 0
        self.bytes = whole[first : int(offsets[-1])] if len(offsets) else whole[:0]
        self.offsets = offsets - first
        if lower or table is not None:
            self.bytes = (LOWER if table is None else table)[self.bytes]
        word = ~_SPACE[self.bytes]
        size = len(word)
        before = np.zeros(size, dtype=bool)
        before[1:] = word[:-1]
        before[self.offsets[:-1][self.offsets[:-1] < size]] = False
        after = np.zeros(size, dtype=bool)
        after[:-1] = word[1:]
        lasts = self.offsets[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        #: bounds[i]:bounds[i + 1] are the words of text i
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit value per word, the same for equal words everywhere."""
        forward, backward = _powers()
        out = np.empty(len(self.starts), dtype=U64)
        at = 0
        while at < len(out):
            begin = int(self.starts[at])
            to = int(np.searchsorted(self.ends, begin + _BLOCK, side="right"))
            if to == at or self.ends[at] - begin > _LONG_WORD:
                out[at] = self._long(at)
                at += 1
                continue
            stop = int(self.ends[to - 1])
            sums = np.zeros(stop - begin + 1, dtype=U64)
            np.cumsum(_BYTE[self.bytes[begin:stop]] * forward[: stop - begin], out=sums[1:])
            s, e = self.starts[at:to] - begin, self.ends[at:to] - begin
            out[at:to] = (sums[e] - sums[s]) * backward[s] + (e - s).astype(U64)
            for i in at + np.flatnonzero(e - s > _LONG_WORD):
                out[i] = self._long(int(i))
            at = to
        return mix(out)

    def _long(self, i: int) -> int:
        word = self.bytes[self.starts[i] : self.ends[i]].tobytes()
        return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")

    def valid(self, length: int) -> np.ndarray:
        """For each word, whether a window of that many words starting there stays in its text."""
        ends = np.repeat(self.bounds[1:], self.counts)
        return np.arange(len(self.starts)) + length <= ends

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()

    def text(self, i: int) -> bytes:
        return self.bytes[self.offsets[i] : self.offsets[i + 1]].tobytes()


def windows(words: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit value for each window of that many words; the last length - 1 places are unusable."""
    size = len(words)
    total: np.ndarray | None = None
    span, covered = words.astype(U64, copy=True), 0
    width = 1
    rest = length

    def joined(a: np.ndarray, a_len: int, b: np.ndarray, b_len: int) -> np.ndarray:
        out = a * U64(pow(_BASE, b_len, 1 << 64))
        if size > a_len:
            out[: size - a_len] += b[a_len:]
        return out

    while rest:
        if rest & 1:
            total = span.copy() if total is None else joined(total, covered, span, width)
            covered += width
        rest >>= 1
        if rest:
            span = joined(span, width, span, width)
            width *= 2
    return mix(total + U64(length))


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts stay near most_bytes; a longer text comes alone."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > most_bytes:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += int(n)
    if at < len(sizes):
        yield batch.slice(at, len(sizes) - at)
