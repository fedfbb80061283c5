"""Encoding to and decoding from the pieces of a BPE model file, with seeded merge dropout.

A text's spaces stand for the mark U+2581 of the pieces and one space goes in front. Texts are cut where
no piece of the vocabulary can reach across: in front of spaces, and between characters that no chain of
pieces brings together. The cuts ("words") are encoded one by one.
Merges come from an agenda, best score first and leftmost among equals; the agendas of many short words
run in step, over arrays. Each candidate that comes up is skipped when a hash of (seed, document, copy, place of the word in it, number of the candidate) says so,
and comes back only when a neighbour changes. So every occurrence of a word draws its own segmentation
and a rerun draws the same one. A segmentation follows from the word and the numbers of the candidates
skipped, so a batch merges equal ones once, and workers keep undropped words; neither changes a result. Characters outside the vocabulary become byte pieces. Without dropout the ids are those of the model's library.

Decoding gives the text back byte by byte. For that, a mark that the text itself holds is written as
its bytes; the library would read it as a space.

Defined results: null and empty texts have no pieces and decode to the empty text. All columns of a row
pass through; rows with the same id, text and copy number are encoded alike; texts tell null ids apart.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import words

MARK = "▁"
#: Bytes of texts encoded at once, and ids decoded at once.
BYTES, IDS = 1 << 20, 1 << 20
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15
#: Candidates of a word whose skips are drawn ahead; words with more are merged anew each time.
LANES = 24
#: Longest word whose agenda runs in step with others, and words that run together.
SHORT, TOGETHER = 24, 1 << 12
#: Lanes that are drawn for every word.
_FEW = 8
#: No candidate at this place.
_DONE = np.int32((1 << 31) - 1)


def word_pattern(vocabulary: Iterable[str]) -> re.Pattern[str]:
    """Spaces with the run of characters after them that pieces may join; other characters alone.

    Characters that stand next to each other in a piece belong together, and so does what they
    belong with; no piece reaches across two such sets.
    """
    home: dict[str, str] = {}

    def root(c: str) -> str:
        while home.setdefault(c, c) != c:
            home[c] = c = home[home[c]]
        return c

    for piece in vocabulary:
        bare = piece.lstrip(" ")
        if " " in bare:
            raise ValueError(f"a mark inside piece {piece!r}: texts cannot be cut in front of spaces")
        for a, b in zip(bare, bare[1:]):
            home[root(a)] = root(b)
    runs: dict[str, list[str]] = {}
    for c in home:
        runs.setdefault(root(c), []).append(re.escape(c))
    sets = [f"[{''.join(sorted(run))}]+" for run in sorted(runs.values(), key=len, reverse=True)]
    return re.compile(f" *(?:{'|'.join([*sets, '[^ ]'])})| +")


def skips(keys: np.ndarray, dropout: float, lanes: int = LANES) -> np.ndarray:
    """For each key, bits of the first candidates: bit t says that the t-th to come up is skipped."""
    out, limit = np.zeros(len(keys), np.int64), words.U64(int(dropout * (1 << 32)))
    if limit:
        for lane in range(0, lanes, 2):
            x = words.mix(keys + words.U64(lane * _STEP & _MASK))
            out |= ((x >> words.U64(32)) < limit).astype(np.int64) << lane
            out |= ((x & words.U64(0xFFFFFFFF)) < limit).astype(np.int64) << lane + 1
    return out


def later_skips(key: np.uint64, start: int, n: int, dropout: float) -> list[bool]:
    """The same for n candidates of one key beyond its lanes."""
    x = words.mix(np.arange(start, start + n, dtype=words.U64) * words.U64(_STEP) + key)
    return ((x >> words.U64(32)) < words.U64(int(dropout * (1 << 32)))).tolist()


def _mask(came: np.ndarray) -> np.ndarray:
    """The bits of the candidates that came up."""
    return (1 << np.minimum(came, LANES)) - 1


class Seen:
    """Undropped words in two generations: what is asked for again moves to the young one, the old one goes."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def find(self, word: str) -> tuple[bytes, int] | None:
        path = self.young.get(word)
        if path is None:
            path = self.old.get(word)
            if path is not None:
                self.keep(word, path)
        return path

    def keep(self, word: str, path: tuple[bytes, int]) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[word] = path


class Merges:
    """What any two pieces next to each other merge to, for the agendas of many words at once."""

    def __init__(self, ids: dict[str, int], rank: dict[str, float]):
        self.size = max(ids.values(), default=0) + 1
        order = {r: i for i, r in enumerate(sorted(set(rank.values())))}
        # A candidate's place goes in its lowest bits: the least one is the best, the leftmost among equals.
        if len(order) >= 1 << 26 or self.size > 1 << 21:
            raise ValueError("more scores than 26 bits or ids than 21 bits tell apart")
        self.value = np.zeros(self.size, np.int32)
        keys, to = [], []
        for piece, i in ids.items():
            self.value[i] = order[rank[piece]] << 5
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    to.append(i)
        slots = max(10, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - slots), (1 << slots) - 1
        # An entry is a pair's key with the piece it makes in the lowest bits.
        self.bits = self.size.bit_length()
        self.low = (1 << self.bits) - 1
        self.entries = np.full(1 << slots, -1, np.int64)
        keys = np.array(keys, np.int64)
        entries, slot = keys << self.bits | np.array(to, np.int64), self._slot(keys)
        while len(entries):
            free = self.entries[slot] < 0
            self.entries[slot[free]] = entries[free]
            put = self.entries[slot] == entries
            entries, slot = entries[~put], slot[~put] + 1 & self.last
        self.single = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i

    def found(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidate of each pair at its place, and the piece it makes."""
        key = left.astype(np.int64)
        key *= self.size
        key += right
        slot = self._slot(key)
        entry = self.entries[slot]
        there = entry >> self.bits
        miss = there != key
        astray = np.flatnonzero(miss & (there >= 0))
        while len(astray):
            slot[astray] = slot[astray] + 1 & self.last
            entry[astray] = self.entries[slot[astray]]
            beyond = entry[astray] >> self.bits
            miss[astray] = beyond != key[astray]
            astray = astray[miss[astray] & (beyond >= 0)]
        to = (entry & self.low).astype(np.int32)
        to[miss] = 0
        best = self.value[to]
        best += place.astype(np.int32)
        best[miss] = _DONE
        return best, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(_STEP) >> self.shift).astype(np.int64)

    def run(self, found: list[str], skip: np.ndarray) -> tuple[list[bytes | None], np.ndarray]:
        """Ids of each word that skips these candidates, and how many came up.

        What needs a plain agenda (long words, characters without a piece, candidates beyond the lanes)
        has no ids and counts as beyond the lanes.
        """
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        letters = self.single[np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.cumsum(lengths) - lengths
        known = (lengths > 0) & (lengths <= SHORT)
        if len(found):
            known[np.repeat(np.arange(len(found)), lengths)[letters < 0]] = False
        ids: list[bytes | None] = [None] * len(found)
        came = np.full(len(found), LANES + 1, np.int64)
        order = np.flatnonzero(known)
        order = order[np.argsort(lengths[order], kind="stable")]
        for at in range(0, len(order), TOGETHER):
            chosen = order[at : at + TOGETHER]
            self._together(chosen, lengths[chosen], starts[chosen], letters, skip[chosen], ids, came)
        return ids, came

    def _together(self, chosen, lengths, starts, letters, skip, ids, came) -> None:
        n, w = int(lengths.max()), len(chosen)
        place = np.arange(n)[:, None]
        here = place < lengths
        # Row n takes what is written past either end of a word.
        piece = np.zeros((n + 1, w), np.int32)
        piece[:n][here] = letters[(starts + place)[here]]
        right, left = (np.repeat(np.arange(a, a + n + 1, dtype=np.int32)[:, None], w, 1) for a in (1, -1))
        best, to = np.full((n + 1, w), _DONE), np.zeros((n + 1, w), np.int32)
        pairs = place[: n - 1] + 1 < lengths
        if n > 1 and pairs.any():
            best[: n - 1][pairs], to[: n - 1][pairs] = self.found(
                piece[: n - 1][pairs], piece[1:n][pairs], np.broadcast_to(place[: n - 1], pairs.shape)[pairs]
            )
        alive, count = here.copy(), np.zeros(w, np.int64)
        while True:
            # Words that are done have no candidate in any place.
            least = best.min(0)
            x = np.flatnonzero(least != _DONE)
            if not len(x):
                break
            i = least[x] & 31
            skipped = (skip[x] >> np.minimum(count[x], 62) & 1).astype(bool)
            count[x] += 1
            best[i, x] = _DONE
            late = count[x] > LANES
            if late.any():
                best[:, x[late]] = _DONE
                skipped |= late
            x, i = x[~skipped], i[~skipped]
            j = right[i, x]
            k, h = right[j, x], left[i, x]
            made = to[i, x]
            piece[i, x], right[i, x] = made, k
            left[np.minimum(k, n), x] = i
            best[j, x], alive[j, x] = _DONE, False
            best[i, x], to[i, x] = self.found(made, piece[np.minimum(k, n), x], i)
            best[i, x] = np.where(k < lengths[x], best[i, x], _DONE)
            inside = h >= 0
            h, x, made = h[inside], x[inside], made[inside]
            best[h, x], to[h, x] = self.found(piece[h, x], made, h)
        out = piece[:n].T[alive.T].tobytes()
        ends = (np.cumsum(alive.sum(0)) * 4).tolist()
        came[chosen] = count
        start = 0
        for word, end, c in zip(chosen.tolist(), ends, count.tolist()):
            if c <= LANES:
                ids[word] = out[start:end]
            start = end


class Pieces:
    """Vocabulary of a model file, with the segmentations a worker has seen."""

    def __init__(self, path: str, cache_entries: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}  # a lower one merges earlier
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        text: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            raw = b""
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte[value], raw = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace(MARK, " ")
                self.id[piece], self.rank[piece], raw = i, -model.get_score(i), piece.encode()
            text.append(raw)
        self.text = pa.array(text, pa.large_binary())
        self.words = word_pattern(self.id)
        self.merges = Merges(self.id, self.rank)
        self.seen = Seen(cache_entries)

    @classmethod
    def here(cls, path: str, cache_entries: int) -> "Pieces":
        state = words.caches("pieces")
        if ("pieces", path) not in state:
            state["pieces", path] = cls(path, cache_entries)
        return state["pieces", path]

    def encode(self, text: str, key: int, seed: int, dropout: float) -> np.ndarray:
        return self.encode_all([text], np.array([key], np.uint64), seed, dropout)[0]

    def encode_all(self, texts: list[str], keys: np.ndarray, seed: int, dropout: float) -> list[np.ndarray]:
        """Ids of each text; every word of it draws its own skips by the text's key and the word's place."""
        cut = [self.words.findall(" " + t) if t else [] for t in texts]
        counts = np.array([len(c) for c in cut], np.int64)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = words.mix(keys ^ words.mix(np.array([seed & _MASK], np.uint64)))
        drawn = words.mix(np.repeat(start, counts) + place.astype(np.uint64))
        flat = [word for found in cut for word in found]
        numbered: dict[str, int] = defaultdict()
        numbered.default_factory = numbered.__len__
        code, kinds = np.fromiter(map(numbered.__getitem__, flat), np.int64, len(flat)), list(numbered)
        parts, came = self._undropped(kinds, np.bincount(code, minlength=len(kinds)))
        # Few lanes tell for most words that nothing is skipped.
        bits = skips(drawn, dropout, _FEW)
        more = np.flatnonzero((bits & _mask(came)[code] != 0) | (came[code] > _FEW))
        bits[more] = skips(drawn[more], dropout)
        path = code.copy()
        at = more[(bits[more] & _mask(came)[code[more]] != 0) | (came[code[more]] > LANES)]
        # Words that skip one candidate, told apart by its number; then those that skip more and those
        # that stand alone in the batch or go beyond the lanes, one by one.
        shared = came[code[at]] <= LANES
        rest, at = at[~shared], at[shared]
        lone = bits[at] & -bits[at]
        asked, which = np.unique(code[at] << 32 | lone, return_inverse=True)
        ids, n = self.merges.run([kinds[c] for c in (asked >> 32).tolist()], asked & 0xFFFFFFFF)
        settled = (n[which] <= LANES) & (bits[at] & ~lone & _mask(n)[which] == 0)
        path[at[settled]] = len(parts) + which[settled]
        parts += ids
        at = np.concatenate([rest, at[~settled]])
        path[at] = len(parts) + np.arange(len(at))
        asked = [flat[i] for i in at.tolist()]
        ids, n = self.merges.run(asked, bits[at])
        for i, word, found in zip(at.tolist(), asked, ids):
            if found is None:
                found = array("i", self._merge(word, int(bits[i]), drawn[i], dropout)[0]).tobytes()
            parts.append(found)
        ids = list(map(parts.__getitem__, path.tolist()))
        ends = np.cumsum(counts).tolist()
        return [np.frombuffer(b"".join(ids[a:b]), np.int32) for a, b in zip([0, *ends], ends)]

    def _undropped(self, found: list[str], times: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Ids of each word that comes twice or more, and how many candidates came up.

        Words that come once count as beyond the lanes and have no ids; these are merged with their own skips.
        """
        parts: list[bytes] = [b""] * len(found)
        came = np.full(len(found), LANES + 1, np.int64)
        new = []
        for i in np.flatnonzero(times > 1).tolist():
            path = self.seen.find(found[i])
            if path is None:
                new.append(i)
            else:
                parts[i], came[i] = path
        words_new = [found[i] for i in new]
        merged, n_came = self.merges.run(words_new, np.zeros(len(new), np.int64))
        for i, word, ids, n in zip(new, words_new, merged, n_came.tolist()):
            if ids is None and len(word) <= SHORT:
                plain, n = self._merge(word, 0, np.uint64(0), 0.0)
                ids = array("i", plain).tobytes()
            parts[i], came[i] = ids, n
            if len(word) <= SHORT:
                self.seen.keep(word, (ids, n))
        return parts, came

    def _merge(self, word: str, skip: int, key: np.uint64, dropout: float) -> tuple[list[int], int]:
        """Pieces, and how many candidates came up.

        Agenda of neighbours that make a piece: (rank, start of the left one, end of the right one).
        """
        rank, n = self.rank, len(word)
        agenda = [(rank[pair], i, i + 2) for i, pair in enumerate(map(add, word, word[1:])) if pair in rank]
        heapify(agenda)
        # Where the part that starts at i ends (gone: n + 1), and where the one that ends at i starts.
        end, begin, gone = [*range(1, n + 1), -1, -1], list(range(-1, n)), n + 1
        came, later = 0, []
        while agenda:
            _, i, k = heappop(agenda)
            j = end[i]
            if end[j] != k:
                continue
            came += 1
            if came <= LANES:
                if skip >> came - 1 & 1:
                    continue
            elif dropout:
                if came - LANES > len(later):
                    later += later_skips(key, came - 1, 2 * n, dropout)
                if later[came - LANES - 1]:
                    continue
            end[i], end[j], begin[k] = k, gone, i
            if k < n:
                found = rank.get(word[i : end[k]])
                if found is not None:
                    heappush(agenda, (found, i, end[k]))
            if i:
                found = rank.get(word[begin[i] : k])
                if found is not None:
                    heappush(agenda, (found, begin[i], k))
        out: list[int] = []
        i = 0
        while i < n:
            piece = word[i : end[i]]
            known = self.id.get(piece)
            if known is not None:
                out.append(known)
            else:
                out += [self.byte[b] for b in piece.encode()]
            i = end[i]
        return out, came

    def decode(self, ids: pa.Array, ends: np.ndarray) -> list[bytes]:
        """The texts of ids cut at ends (from 0 to their number), each without its first mark."""
        spelled = self.text.take(ids)
        bounds = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset :][ends].tolist()
        data = memoryview(spelled.buffers()[2] or b"")
        return [bytes(data[a + 1 : b]) for a, b in zip(bounds, bounds[1:])]


def encode_documents(
    docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 1, copy: str | None = None, cache_entries: int = 1 << 15
) -> DataFrame:
    """row (all columns of docs (doc_id, text, ...)) and ids, the pieces of its whole text.

    `copy` names the column that numbers the copies of a document, where docs holds several.
    """
    # The text travels once, inside its row.
    rows = docs.withColumn("text", F.col("text").cast("string")).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64("doc_id", "text", *([copy] if copy else [])).alias("h"),
    )
    kind = rows.schema["row"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.here(model, cache_entries)
        for batch in batches:
            text = pa.compute.fill_null(batch.column("row").field("text").cast(pa.binary()), b"")
            for part in words.pieces(batch.append_column("text", text), "text", BYTES):
                texts = [t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                ids = pieces.encode_all(texts, part.column("h").to_numpy().view(np.uint64), seed, dropout)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column("row"), lists], names=["row", "ids"])

    return rows.mapInArrow(encode, f"row {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """The columns of encoded with decoded, the text that ids stand for."""
    names = encoded.columns
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.here(model, 1 << 15)
        for batch in batches:
            ids = batch.column("row").field("ids")
            counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(ids), 0))
            at = 0
            while at < len(counts):
                # Rows of some IDS ids at a time; a longer row comes alone.
                to = at + max(1, int(np.searchsorted(np.cumsum(counts[at:]), IDS, side="right")))
                part = batch.slice(at, to - at)
                ends = np.concatenate([[0], np.cumsum(counts[at:to])])
                texts = pieces.decode(ids.slice(at, to - at).flatten(), ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(texts, pa.binary())], names=["row", "decoded"]
                )
                at = to

    return rows.mapInArrow(decode, f"row {kind}, decoded binary").select(
        "row.*", F.col("decoded").cast("string").alias("decoded")
    )
