"""Exact token counts of whole texts, without encoding most of them and without moving pre-tokens.

A byte-level BPE works inside pre-tokens, so a text's count is the sum of its pre-tokens' counts.
Tier one is a table of the corpus's frequent pre-tokens with their counts, broadcast in compact form
(its size is a parameter). Tier two is each worker's own cache; what neither knows is merged there,
pre-token by pre-token, from the file's own ranks. No pre-token crosses a shuffle: a first pass over
all rows counts words by hash in each task and cuts the most frequent of them into pre-tokens;
these summaries, of a bounded size each, are merged in slots and then once more on the driver. The
table only saves time; counts are the same with an empty one. Words of over 64 bytes and pre-tokens of
over 64 characters enter neither the table nor a cache, so both are bounded in bytes as well.

Texts that hold the special string, or characters whose class may differ between the two libraries'
versions of Unicode, go to the library whole.

Defined results: a null text counts as empty and has no tokens. Rows are counted each; repeated rows
and null ids pass through.
"""

from __future__ import annotations

import heapq
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import text_bytes

#: Fixed: how the tokenizer file's byte-level scheme cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class all Unicode versions in use agree (tests compare them with the library).
SETTLED = "\\x00-\u052f\u2010-\u2027\u2030-\u203a\u20a0-\u20b5\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
#: Every other character's UTF-8 form has a byte of at least this value.
_OTHER_BYTE = 0xD5
SLOTS = 16
#: Longer words and pre-tokens are merged where they occur and kept in no table or cache.
LONGEST = 64
OUT = "doc_id long, n_bytes long, n_tokens long"

_pretokens = regex.compile(PATTERN)
_unsettled = regex.compile(f"[^{SETTLED}]")


class Encoder:
    """One tokenizer file in one worker, with the worker's cache of pre-token counts."""

    def __init__(self, path: str, cache_entries: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.core = self._core(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}
        self.cache_entries = cache_entries

    @classmethod
    def here(cls, path: str, cache_entries: int) -> "Encoder":
        state = words.caches("token_counts")
        if ("encoder", path) not in state:
            state["encoder", path] = cls(path, cache_entries)
        return state["encoder", path]

    def lengths(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library_ids(texts)))

    def library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def ids(self, text: str) -> bytes:
        """Ids of a text for which whole() is false, as 32-bit little-endian integers."""
        return bytes(memoryview(self.core.encode_to_tiktoken_buffer(text, set())))

    @staticmethod
    def _core(path: str):
        """Cuts and merges of texts, from the ranks that the file's vocabulary holds."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        # The file writes a byte as a printable character: printable Latin-1 as itself, others from 256 on.
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160)]
        others = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in piece): rank for piece, rank in vocabulary.items()}
        encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return encoding._core_bpe

    def learn(self, pretokens: set[str]) -> None:
        unknown = [t for t in pretokens if t not in self.cache]
        if len(self.cache) + len(unknown) > self.cache_entries:
            self.cache.clear()
            unknown = list(pretokens)
        self.cache.update((t, self.length(t)) for t in unknown)

    def length(self, pretoken: str) -> int:
        return len(self.core.encode_single_piece(pretoken.encode()))

    def whole(self, text: str, wide: bool) -> bool:
        """Whether the library has to see the text as it is."""
        return any(s in text for s in self.special) or wide and _unsettled.search(text) is not None


def decoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    for part in words.pieces(batch, "text"):
        plain = [bytes(b.as_buffer()) for b in part.column("text")]
        wide = np.array([bool(len(b)) and int(np.frombuffer(b, np.uint8).max()) >= _OTHER_BYTE for b in plain])
        yield part, [b.decode("utf-8", "replace") for b in plain], wide


def _pack(counts: Counter, most: int) -> tuple[list[str], list[int]]:
    best = heapq.nsmallest(most, counts.items(), key=lambda x: (-x[1], x[0]))
    return [t for t, _ in best], [n for _, n in best]


def _frequent_words(found: dict[int, list], texts: words.Texts, most: int) -> dict[int, list]:
    """Add the words of a batch to hash -> [count, word]; beyond 2 x most, keep the frequent half."""
    short = np.flatnonzero(texts.ends - texts.starts <= LONGEST)
    hashes, first, counts = np.unique(texts.hashes()[short], return_index=True, return_counts=True)
    first = short[first]
    for h, i, n in zip(hashes.tolist(), first.tolist(), counts.tolist()):
        if h in found:
            found[h][0] += n
        elif n > 1 or len(found) < most:
            found[h] = [n, texts.word(i)]
    if len(found) > 2 * most:
        found = dict(heapq.nlargest(most, found.items(), key=lambda x: (x[1][0], x[0])))
    return found


def frequent_pretokens(docs: DataFrame, entries: int, per_task: int = 4096, held: int = 1 << 16) -> list[str]:
    """The most frequent pre-tokens over all rows, found from bounded summaries of all tasks."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for part in words.pieces(batch, "text"):
                found = _frequent_words(found, words.Texts(part.column("text")), held)
        counts: Counter = Counter()
        for n, word in heapq.nlargest(per_task, found.values(), key=lambda x: (x[0], x[1])):
            for token in _pretokens.findall(" " + word.decode("utf-8", "replace")):
                counts[token] += n
        tokens, numbers = _pack(counts, per_task)
        slot = TaskContext.get().partitionId() % SLOTS
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array([slot], pa.int32()), "t": pa.array([tokens], pa.list_(pa.string())),
            "n": pa.array([numbers], pa.list_(pa.int64())),
        })

    def merge(group: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for row in group.select(["t", "n"]).to_pylist():
            for t, n in zip(row["t"], row["n"]):
                counts[t] += n
            if len(counts) > 8 * entries:
                counts = Counter(dict(zip(*_pack(counts, 4 * entries))))
        tokens, numbers = _pack(counts, entries)
        return pa.table({"t": pa.array([tokens], pa.list_(pa.string())), "n": pa.array([numbers], pa.list_(pa.int64()))})

    partial = docs.select(text_bytes().alias("text")).mapInArrow(summarise, "slot int, t array<string>, n array<long>")
    merged = partial.groupBy("slot").applyInArrow(merge, "t array<string>, n array<long>")
    total: Counter = Counter()
    for row in merged.toLocalIterator():  # at most SLOTS rows of at most `entries` pre-tokens
        for t, n in zip(row["t"], row["n"]):
            total[t] += n
    return _pack(total, entries)[0]


def token_counts(docs: DataFrame, tokenizer: str, entries: int = 16384, cache_entries: int = 1 << 20) -> DataFrame:
    """Tokens of each row's whole text by the tokenizer file, with the text's bytes."""
    frequent = frequent_pretokens(docs, entries)
    counted = Encoder(tokenizer, cache_entries).lengths(frequent)
    known = docs.sparkSession.sparkContext.broadcast((frequent, np.array(counted, dtype=np.uint32).tobytes()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.here(tokenizer, cache_entries)
        keys, lengths = known.value
        table = dict(zip(keys, np.frombuffer(lengths, np.uint32).tolist()))
        for batch in batches:
            for part, texts, wide in decoded(batch):
                totals, open_rows, unknown, direct = [0] * len(texts), [], set(), []
                for i, text in enumerate(texts):
                    if encoder.whole(text, bool(wide[i])):
                        direct.append(i)
                        continue
                    tokens = _pretokens.findall(text)
                    found = list(map(table.get, tokens))
                    try:
                        totals[i] = sum(found)
                    except TypeError:
                        rest = [t for t, n in zip(tokens, found) if n is None]
                        totals[i] = sum(n for n in found if n is not None)
                        totals[i] += sum(encoder.length(t) for t in rest if len(t) > LONGEST)
                        rest = [t for t in rest if len(t) <= LONGEST]
                        open_rows.append((i, rest))
                        unknown.update(rest)
                if unknown:
                    encoder.learn(unknown)
                    for i, rest in open_rows:
                        totals[i] += sum(map(encoder.cache.__getitem__, rest))
                for i, n in zip(direct, encoder.lengths([texts[i] for i in direct])):
                    totals[i] = n
                sizes = pa.compute.binary_length(part.column("text")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), sizes, pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
                )

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(count, OUT)
