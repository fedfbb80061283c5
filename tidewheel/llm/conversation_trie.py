"""The prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

A conversation is the sequence of its turns' digests. Conversations are sorted by that sequence and id
and dealt by ranges of both, so that equal ones are split as well. In sorted order the conversations that
start with the same turns are neighbours, and the longest common prefix (LCP) of two neighbours is an
edge. Each task joins its conversations by union-find over its edges in falling depth: whenever two
components meet, the node in which they branch is made, and the nodes between it and the next
branching above form a chain with the same members. So a task does work in proportion to its
conversations and its distinct nodes.

Nodes that hold neither the first nor the last conversation of a task are closed and leave as rows.
The others lie on two paths, which is what a task's forest is contracted to: the two sequences, and for
each depth the members, the smallest id, and what the closed nodes below add up to. Contracted forests
are merged FAN at a time by the same union-find over the LCPs across their boundaries, until one is left.
What an open node hands on is looked up by the digest of its prefix: the parent of a closed node, and the
ids of conversations that end in it, which travel in pieces and are hashed as a stream.

Defined results: rows without a conv_id are left out; a null role or text is empty; turns are ordered by
turn, null first, then role and text. Repeated rows are turns each. An empty table has no nodes. Other
columns are left out. Turns are told apart by 128 bits of their SHA-256. A conversation's digests (16
bytes a turn, 4 for its length) travel in one row, so a conversation must fit in a task's memory as such.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import materialize

#: Contracted forests that one task merges.
FAN = 64
#: Ids of conversations in one piece of an open node's list.
PIECE = 1 << 16
#: Most rows of open nodes that are broadcast; more are joined on a salted key.
BROADCAST_ROWS, SALTS = 1 << 18, 64
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
#: kind: node, piece (of an open node's ids) or forest; key: digest of the node's prefix; part: order of a piece.
PARTS = f"kind string, {NODE}, key binary, parent_key binary, part long, piece binary, forest long, packed binary"
_FIELDS = [c.split() for c in PARTS.split(", ")]
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(kind: str, columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns = columns | {"kind": [kind] * n}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], _KINDS[k]) if c in columns else pa.nulls(n, _KINDS[k]) for c, k in _FIELDS],
        names=[c for c, _ in _FIELDS],
    )


@dataclass
class Branchings:
    """Compressed nodes over points in sorted order: depth, parent (-1: none), range of points; each point's own node."""

    depth: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    last: np.ndarray
    own: np.ndarray

    @property
    def top(self) -> np.ndarray:
        """The depth above a node's chain: its parent's, or -1, as a chain of the topmost takes in the root."""
        return np.where(self.parent < 0, -1, self.depth[self.parent])


def branchings(lengths: np.ndarray, lcps: np.ndarray) -> Branchings:
    """Union-find over the edges (i - 1, i) of LCP lcps[i] in falling depth; lcps[0] is not used."""
    n = len(lengths)
    depth, parent, first, last = lengths.tolist(), [-1] * n, list(range(n)), list(range(n))
    up, node, same = list(range(n)), list(range(n)), {}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    edges = 1 + np.argsort(-lcps[1:], kind="stable")
    for i, d in zip(edges.tolist(), lcps[edges].tolist()):
        a, b = root(i - 1), root(i)
        left, right = node[a], node[b]
        if depth[left] == d:
            joined = left
            if depth[right] == d:
                same[right] = left  # both are the node at this depth
            else:
                parent[right] = left
        elif depth[right] == d:
            joined = right
            parent[left] = right
        else:
            joined = len(depth)
            depth.append(d)
            parent.append(-1)
            first.append(0)
            last.append(0)
            parent[left] = parent[right] = joined
        first[joined], last[joined] = first[left], last[right]
        up[b] = a
        node[a] = joined
    at = np.arange(len(depth))
    for x, target in same.items():  # a node that turned out to be another one hands its place on
        while target in same:
            target = same[target]
        at[x] = target
    parents = np.array(parent, np.int64)
    parents = np.where(parents < 0, -1, at[parents])
    kept = np.flatnonzero(at == np.arange(len(at)))
    number = np.full(len(at) + 1, -1)
    number[kept] = np.arange(len(kept))
    take = lambda values: np.array(values, np.int64)[kept]
    return Branchings(take(depth), number[parents[kept]], take(first), take(last), number[at[:n]])


@dataclass
class Point:
    """A path of a contracted forest: turns' digests and text bytes, and for each depth what is below."""

    keys: np.ndarray  # (turns, 2) of 64-bit values
    sizes: np.ndarray  # text bytes by depth, 0 for the root
    members: np.ndarray
    least: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray

    @staticmethod
    def blank(keys: np.ndarray, sizes: np.ndarray) -> "Point":
        zeros = lambda: np.zeros(len(sizes), np.int64)
        return Point(keys, sizes, zeros(), np.full(len(sizes), np.iinfo(np.int64).max), zeros(), zeros(), zeros())


def common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


def prefix_digests(keys: np.ndarray) -> list[bytes]:
    """A digest for each prefix of a path, the empty one first."""
    out, chain = [], hashlib.sha256()
    for turn in [b"", *(k.tobytes() for k in keys)]:
        chain.update(turn)
        out.append(chain.digest()[:16])
    return out


class Rows:
    """Node rows gathered column by column."""

    NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "parent_key"]

    def __init__(self):
        self.columns: dict[str, list] = {n: [] for n in self.NAMES}

    def add(self, **values) -> None:
        for name, column in self.columns.items():
            column.extend(values[name])

    def full(self, most: int = 1 << 14) -> Iterator[pa.RecordBatch]:
        """What is held, once it is more than so many rows."""
        if len(self.columns["depth"]) > most:
            yield _rows("node", self.columns)
            self.__init__()


def neighbour_lcps(keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before (0 for the first), from all sequences end to end."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    out = np.zeros(len(lengths), np.int64)
    shorter = np.minimum(lengths[1:], lengths[:-1])
    out[1:] = shorter
    pairs = np.flatnonzero(shorter)
    if len(pairs):
        sizes = shorter[pairs]
        offsets = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
        a, b = np.repeat(starts[:-1][pairs], sizes) + step, np.repeat(starts[1:][pairs], sizes) + step
        places = np.where((keys[a] != keys[b]).any(axis=1), step, np.iinfo(np.int64).max)
        out[1:][pairs] = np.minimum(np.minimum.reduceat(places, offsets), sizes)
    return out


def grow(conv_ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, forest: int) -> Iterator[pa.RecordBatch]:
    """Closed nodes, pieces of open nodes' ids and the contracted forest of one task's conversations."""
    n = len(conv_ids)
    starts = np.cumsum(lengths) - lengths
    tree = branchings(lengths, neighbour_lcps(keys, lengths))
    depth, parent, top = tree.depth, tree.parent, tree.top
    count = len(depth)
    open_node = (tree.first == 0) | (tree.last == n - 1)
    # what each node gathers from those below, deepest first
    least = np.full(count, np.iinfo(np.int64).max)
    children, leaves, saved = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
    ended: list[list[int]] = [[] for _ in range(count)]
    members = tree.last - tree.first + 1
    texts = np.append(0, np.cumsum(sizes))  # text bytes before each turn

    def bytes_of(point: int, low: int, high: int) -> int:
        """Text bytes of the turns that lead to depths low + 1 to high."""
        low, high = max(low, 0), max(high, 0)
        return int(texts[starts[point] + high] - texts[starts[point] + low])

    order = np.argsort(-depth, kind="stable")
    for point in range(n):
        x = tree.own[point]
        least[x] = min(least[x], conv_ids[point])
        ended[x].append(int(conv_ids[point]))
    above = np.zeros(count, np.int64)  # saved tokens at the upper end of a node's chain
    for x in order.tolist():
        if not children[x] and not open_node[x]:
            leaves[x] = 1
        above[x] = saved[x] + (members[x] - 1) * bytes_of(int(tree.first[x]), int(top[x]), int(depth[x]))
        p = parent[x]
        if p >= 0:
            least[p] = min(least[p], least[x])
            if not open_node[x]:
                children[p] += 1
                leaves[p] += leaves[x]
                saved[p] += above[x]
    # the two open paths
    ends_at, rows = [0, n - 1] if n > 1 else [0], Rows()
    points = []
    for q in ends_at:
        part = slice(int(starts[q]), int(starts[q] + lengths[q]))
        points.append(Point.blank(keys[part], np.append(0, sizes[part])))
    digests = [prefix_digests(p.keys) for p in points]
    shared = common(points[0].keys, points[-1].keys)
    pieces = {"key": [], "part": [], "piece": []}
    for x in np.flatnonzero(open_node).tolist():
        side = 0 if tree.first[x] == 0 else 1
        p, chain = points[side], slice(int(top[x]) + 1, int(depth[x]) + 1)
        p.members[chain], p.least[chain] = members[x], least[x]
        p.children[depth[x]], p.leaves[depth[x]], p.saved[depth[x]] = children[x], leaves[x], saved[x]
        ids = ended[x]
        for at in range(0, len(ids), PIECE):
            pieces["key"].append(digests[side][int(depth[x])])
            pieces["part"].append((forest << 32) + at)
            pieces["piece"].append(",".join(map(str, ids[at : at + PIECE])).encode())
    # closed nodes, a row for each depth of their chains
    for x in np.flatnonzero(~open_node).tolist():
        low, high = int(top[x]), int(depth[x])
        begin, p, size = int(starts[tree.first[x]]), int(parent[x]), high - low
        below = np.cumsum(sizes[begin + low : begin + high][::-1])[::-1] * (members[x] - 1) + saved[x]
        upper_open = bool(open_node[p])
        side = 0 if tree.first[p] == 0 else 1
        ends = hashlib.sha256(",".join(map(str, ended[x])).encode()).hexdigest() if ended[x] else EMPTY_SHA
        me = int(least[x])
        rows.add(
            conv_id=[me] * size, depth=range(low + 1, high + 1),
            parent_conv_id=[None if upper_open else int(least[p])] + [me] * (size - 1),
            n_convs=[int(members[x])] * size, n_children=[1] * (size - 1) + [int(children[x])],
            n_leaves=[int(leaves[x])] * size, saved_tokens=below.tolist(), ends_sha256=[EMPTY_SHA] * (size - 1) + [ends],
            key=[None] * size, parent_key=[digests[side][low] if upper_open else None] + [None] * (size - 1),
        )
        yield from rows.full()
    yield from rows.full(0)
    if pieces["key"]:
        yield _rows("piece", pieces)
    yield _contracted(points, shared, forest)


def _contracted(points: list[Point], shared: int, forest: int) -> pa.RecordBatch:
    """One or two paths as a row; the second one's values count below the depth they share."""
    state = {"points": [p.__dict__ for p in points], "shared": shared}
    return _rows("forest", {"forest": [forest], "packed": [pickle.dumps(state)]})


def merge(packed: list[bytes], forest: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Merge contracted forests, given in order; with last, every node is closed."""
    points, lcps, hidden = [], [], []
    for blob in packed:
        held = pickle.loads(blob)
        own = [Point(**p) for p in held["points"]]
        for i, p in enumerate(own):
            lcps.append(held["shared"] if i else common(points[-1].keys, p.keys) if points else 0)
            hidden.append(held["shared"] if i else -1)
            points.append(p)
    n = len(points)
    lengths = np.array([len(p.keys) for p in points], np.int64)
    tree = branchings(lengths, np.array(lcps, np.int64))
    depth, parent, top = tree.depth, tree.parent, tree.top
    count = len(depth)
    open_node = np.zeros(count, bool) if last else (tree.first == 0) | (tree.last == n - 1)
    ends_at = [0, n - 1] if n > 1 else [0]
    out_points = [Point.blank(points[q].keys, points[q].sizes) for q in ends_at]
    digest_of = {}

    def digests(point: int) -> list[bytes]:
        if point not in digest_of:
            digest_of[point] = prefix_digests(points[point].keys)
        return digest_of[point]

    closed = np.bincount(parent[(parent >= 0) & ~open_node], minlength=count)
    leaves_below, saved_below = np.zeros(count, np.int64), np.zeros(count, np.int64)
    least_at_bottom = np.zeros(count, np.int64)
    found = []
    for x in np.argsort(-depth, kind="stable").tolist():
        low, high, a, b = int(top[x]), int(depth[x]), int(tree.first[x]), int(tree.last[x])
        size = high - low
        members, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(4))
        least = np.full(size, np.iinfo(np.int64).max)
        for q in range(a, b + 1):
            begin = max(low + 1, hidden[q] + 1)  # a second point's upper values are its first point's
            if begin > high:
                continue
            to, take, p = slice(begin - low - 1, size), slice(begin, high + 1), points[q]
            members[to] += p.members[take]
            children[to] += p.children[take]
            leaves[to] += p.leaves[take]
            saved[to] += p.saved[take]
            np.minimum(least[to], p.least[take], out=least[to])
        least_at_bottom[x] = least[-1]
        children[-1] += closed[x]
        leaves[-1] += leaves_below[x]
        saved[-1] += saved_below[x]
        if open_node[x]:
            p, to = out_points[0 if a == 0 else 1], slice(low + 1, high + 1)
            p.members[to], p.least[to], p.children[to], p.leaves[to], p.saved[to] = members, least, children, leaves, saved
            continue
        # closed: add what is below along the chain
        children[:-1] += 1
        if not children[-1]:
            leaves[-1] += 1
        leaves = np.cumsum(leaves[::-1])[::-1]
        saved = np.cumsum((saved + (members - 1) * points[a].sizes[low + 1 : high + 1])[::-1])[::-1]
        if parent[x] >= 0:
            leaves_below[parent[x]] += leaves[0]
            saved_below[parent[x]] += saved[0]
        found.append((x, low, size, least, members, children, leaves, saved))
    rows = Rows()
    for x, low, size, least, members, children, leaves, saved in found:
        p = int(parent[x])
        known = digests(int(tree.first[x]))
        upper_open = p >= 0 and bool(open_node[p])
        upper = None if p < 0 or upper_open else int(least_at_bottom[p])
        rows.add(
            conv_id=least.tolist(), depth=range(low + 1, low + 1 + size), parent_conv_id=[upper] + least[:-1].tolist(),
            n_convs=members.tolist(), n_children=children.tolist(), n_leaves=leaves.tolist(),
            saved_tokens=saved.tolist(), ends_sha256=[None] * size, key=known[low + 1 : low + 1 + size],
            parent_key=[known[low] if upper_open else None] + [None] * (size - 1),
        )
        yield from rows.full()
    yield from rows.full(0)
    if not last:
        yield _contracted(out_points, common(out_points[0].keys, out_points[-1].keys), forest)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, keys, sizes): each conversation's turns in order, as digests and text bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    plain = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    key = F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, 16)
    turn = F.struct(place.alias("place"), key.alias("key"), F.octet_length("text").alias("size"))
    placed = plain.select("conv_id", turn.alias("turn"))
    ordered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes"))


def with_shared_heads(own: DataFrame) -> DataFrame:
    """Each conversation c rebuilt: the first h turns of c - c % 5, then its own after its first h."""
    heads = own.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("head"), F.slice("keys", 1, 8).alias("head_keys"), F.slice("sizes", 1, 8).alias("head_sizes")
    )
    joined = own.withColumn("head", F.expr("conv_id - conv_id % 5")).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    ).join(heads, "head", "left")

    def rebuilt(column: str) -> Column:
        head = F.coalesce(F.col(f"head_{column}"), F.expr(f"slice({column}, 1, 0)"))
        return F.concat(F.slice(head, F.lit(1), F.col("h")), F.expr(f"slice({column}, h + 1, greatest(size({column}), 1))"))

    return joined.select("conv_id", rebuilt("keys").alias("keys"), rebuilt("sizes").alias("sizes"))


def _arrays(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    lengths = np.asarray(pa.compute.list_value_length(table["keys"]).combine_chunks(), dtype=np.int64)
    flat = table["keys"].combine_chunks().flatten().cast(pa.binary(16))
    keys = np.frombuffer(flat.buffers()[1] or b"", np.uint64).reshape(-1, 2)[flat.offset : flat.offset + len(flat)]
    sizes = np.asarray(table["sizes"].combine_chunks().flatten(), dtype=np.int64)
    return np.asarray(table["conv_id"].combine_chunks(), dtype=np.int64), keys, sizes, lengths


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if len(b)]
    if held:
        yield from grow(*_arrays(held), TaskContext.get().partitionId())


def _merger(last: bool):
    def merged(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("forest")
        number = rows["forest"][0].as_py() // FAN
        return pa.Table.from_batches(list(merge([bytes(p.as_buffer()) for p in rows["packed"]], number, last)))

    return merged


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each open node's ids from its pieces in order, one piece in memory at a time."""
    key, state = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "open_ends": pa.array([state.hexdigest()])})

    for batch in batches:
        for k, piece in zip(batch.column("key"), batch.column("piece")):
            if key != k.as_py():
                if key is not None:
                    yield closed()
                key, state = k.as_py(), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
    if key is not None:
        yield closed()


def prefix_trie(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row for each node of the trie over conversations (conv_id, keys, sizes); columns as NODE says."""
    order = ["keys", "conv_id"]
    spread = conversations.repartitionByRange(partitions, *order) if partitions else conversations.repartitionByRange(*order)
    parts = materialize(spread.sortWithinPartitions(*order).mapInArrow(_grown, PARTS), "trie")
    nodes = parts.where("kind = 'node'")
    forests = parts.where("kind = 'forest'")
    waiting = forests.count()
    while waiting:
        last = waiting <= FAN
        if last:
            forests = forests.withColumn("merged", F.lit(0))
        else:  # numbers have gaps where tasks were empty, which keeps their order
            forests = forests.withColumn("merged", F.expr(f"forest div {FAN}"))
        made = materialize(forests.groupBy("merged").applyInArrow(_merger(last), PARTS), "trie-merge")
        nodes = nodes.unionByName(made.where("kind = 'node'"))
        forests = made.where("kind = 'forest'")
        waiting = 0 if last else forests.count()
    return _resolved(nodes, parts.where("kind = 'piece'"))


def _resolved(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """Nodes with the parents and ends that were open when their row was made."""
    was_open = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    ends = pieces.repartition("key").sortWithinPartitions("key", "part").select("key", "piece").mapInArrow(
        _end_hashes, "key binary, open_ends string"
    )
    closed, opened = nodes.where("key is null"), nodes.where("key is not null").join(ends, "key", "left")
    named = closed.unionByName(opened, allowMissingColumns=True)
    if was_open.count() <= BROADCAST_ROWS:
        named = named.join(F.broadcast(was_open), "parent_key", "left")
    else:
        salts = F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("salt")
        named = named.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
        named = named.join(was_open.select("*", salts), ["parent_key", "salt"], "left")
    return named.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "open_parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", "open_ends", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
