"""Similarity join on word shingles with a token-group matrix, and the classes it links.

Two texts link when 100 * shared >= percent * all of their distinct shingles.

1. Equal sets collapse to one class (a digest of the set); only classes go on.
2. Similar classes come together: each set is cut by hash into slices, twice as many as the shingles
   in which two linked sets of that size level can differ, so linked sets agree on half of them or
   more. A class sends its slices' digests to hash parts; a part counts which slices others have too
   and links each class of a slice to the smallest. A class with fewer shared slices than a link
   needs goes no further; the components of the links between the others are clusters. A slice holds
   several shingles, so a passage that thousands of texts share does not bring them together.
3. In a cluster, similar classes form groups. The token-group matrix holds the union of the shingles
   of each group; a class can link to a member only if it shares enough shingles with the union and
   the sizes fit, so only such groups are opened and compared member by member, exactly.
4. Clusters above a bound are cut in chunks and each pair of chunks is a task of its own; groups are
   opened by the same bound. Links become components.

Defined results: a null text has an empty set and links with nothing; a text of fewer words than a
shingle has its whole word sequence as one. A-Z count as a-z. Rows without id get a row but no links.
Repeated ids count as one document each row; their component is that of the text with the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm import words
from tidewheel.llm.common import materialize, row_marks, text_bytes, where_marked, width
from tidewheel.llm.components import components, contract

U64 = words.U64
GROUP = 16
#: Shingles that one task compares at once; larger clusters are cut.
TASK_SHINGLES = 1 << 21
CHUNK_SHINGLES = 1 << 20


# --- shingles ----------------------------------------------------------------------------------

def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingles of each text."""
    texts = words.Texts(column, lower=True)
    hashes = texts.hashes()
    grams = words.windows(hashes, size) if len(hashes) else hashes
    out = []
    for i in range(len(texts)):
        a, b = texts.bounds[i], texts.bounds[i + 1]
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(words.windows(hashes[a:b], int(b - a))[:1])
        else:
            out.append(hashes[:0])
    return out


def _digest(shingles: np.ndarray) -> int:
    """A signed 64-bit value of a set, the same for equal sets."""
    if not len(shingles):
        return 0
    total = np.array([np.add.reduce(words.mix(shingles))], dtype=U64) + U64(len(shingles))
    return int(words.mix(total).view(np.int64)[0])


def level_bounds(most: int = 1 << 40) -> list[int]:
    """Least sizes of the levels: each about one and a half times the one before."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


_LEVELS = level_bounds()


def slice_levels(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(level, slices, least slices that a set of n shingles shares with one that it links with).

    A level takes the sizes from its bound to below the next, and from the next level those that can
    still link with one of its own. With s = |x| + |y|, linked sets differ in at most
    (100 - percent) * s / (100 + percent) shingles, so in no more slices than that.
    """
    at, out = int(np.searchsorted(_LEVELS, n, side="right")) - 1, []
    for level in (at, at - 1):
        own = _LEVELS[level + 1] - 1 if level >= 0 else 0
        reach = own * 100 // percent
        if n <= reach:
            slices = 2 * ((100 - percent) * (own + reach) // (100 + percent)) + 1
            partner = min(reach, n * 100 // percent)
            out.append((level, slices, slices - (100 - percent) * (n + partner) // (100 + percent)))
    return out


def node(name: int, level: int) -> int:
    """A class at one of its levels."""
    return int(words.mix(np.array([name], np.int64).view(U64) + U64(level + 1)).view(np.int64)[0])


def slice_digests(shingles: np.ndarray, level: int, slices: int) -> np.ndarray:
    spread = words.mix(shingles ^ U64(0x5851F42D4C957F2D))
    order = ((spread >> U64(32)) * U64(slices)) >> U64(32)
    sums = np.zeros(slices, dtype=U64)
    np.add.at(sums, order.astype(np.int64), words.mix(shingles))
    return words.mix(sums ^ words.mix(np.arange(slices, dtype=U64) + U64(level << 40)))


# --- slices to clusters ------------------------------------------------------------------------

def _low_high(values: np.ndarray, parts: int) -> np.ndarray:
    return (((values >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


def _slice_rows(classes: list[int], slices: list[np.ndarray], parts: int) -> pa.RecordBatch | None:
    if not slices or not sum(map(len, slices)):
        return None
    values = np.concatenate(slices)
    owners = np.repeat(np.array(classes, dtype=np.int64), [len(s) for s in slices])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    part = _low_high(values, parts)
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    pairs = list(zip(edges, np.append(edges[1:], len(part))))
    # The class ids of a row are listed once; slices refer to them by a short number.
    lists, numbers = zip(*(np.unique(owners[a:b], return_inverse=True) for a, b in pairs))
    planes = [values[a:b].view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in pairs]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[edges], pa.int32()), pa.array(planes, pa.binary()),
            pa.array([x.tobytes() for x in lists], pa.binary()),
            pa.array([x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() for x in numbers], pa.binary()),
        ],
        names=["part", "slices", "classes", "numbers"],
    )


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _slice_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice that several nodes have: every node with the smallest, and in how many slices."""
    values, owners = [], []
    for batch in batches:
        for r in batch.to_pylist():
            values.append(_from_planes(r["slices"], np.uint64))
            owners.append(np.frombuffer(r["classes"], np.int64)[_from_planes(r["numbers"], np.uint32)])
    if not values:
        return
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
    value, owner = value[fresh], owner[fresh]
    first = np.concatenate([[True], value[1:] != value[:-1]])
    at = np.cumsum(first) - 1
    leader = owner[np.flatnonzero(first)][at]
    shared = np.bincount(at)[at] > 1
    pairs, counts = np.unique(np.column_stack([owner[shared], leader[shared]]), axis=0, return_counts=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(counts, pa.int64())], names=["a", "b", "slices"]
    )


# --- the token-group matrix --------------------------------------------------------------------

def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start .. start + count."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def links_within(sets: list[np.ndarray], clusters: np.ndarray, percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Pairs (i, j) of linked sets of the same cluster, enough of them for all components.

    side: 0 and 1 for two chunks; only pairs across them are looked for.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    lows = np.array([int(s[0]) if len(s) else 0 for s in sets], dtype=np.uint64)
    seconds = np.array([int(s[len(s) // 2]) if len(s) else 0 for s in sets], dtype=np.uint64)
    keys = [seconds, lows, clusters] if side is None else [seconds, lows, side, clusters]
    order = np.lexsort(keys)  # neighbours in this order share their smallest shingle: likely alike
    block = clusters[order] if side is None else clusters[order] * 2 + side[order]
    fresh = np.concatenate([[True], block[1:] != block[:-1]])
    run = np.arange(n) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    group_of = np.empty(n, dtype=np.int64)
    group_of[order] = np.cumsum(fresh | (run % GROUP == 0)) - 1
    groups = int(group_of.max()) + 1 if n else 0
    owner = np.repeat(np.arange(n), sizes)
    tokens, token = np.unique(np.concatenate(sets), return_inverse=True) if n else (lows, owner)
    # Shingles of one set alone link nothing; they only count in the sizes.
    shared = np.bincount(token, minlength=len(tokens)) > 1
    keep = shared[token]
    token, owner = token[keep], owner[keep]
    # Matrix: for each token the groups whose union holds it.
    cell = np.unique(token * groups + group_of[owner])
    cell_token, cell_group = np.divmod(cell, groups)
    begin = np.searchsorted(cell_token, np.arange(len(tokens) + 1))
    need = -(-percent * sizes // 100)
    least = np.full(groups, np.iinfo(np.int64).max)
    most = np.zeros(groups, dtype=np.int64)
    np.minimum.at(least, group_of, sizes)
    np.maximum.at(most, group_of, sizes)
    home = np.zeros(groups, dtype=np.int64)
    home[group_of] = clusters
    half = np.zeros(groups, dtype=np.int64)
    if side is not None:
        half[group_of] = side
    set_begin = np.searchsorted(owner, np.arange(n + 1))
    fans = begin[token + 1] - begin[token]
    work = np.concatenate([[0], np.cumsum(fans)])[set_begin]
    opened_set, opened_group = [], []
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(work, work[at] + (1 << 22), side="right")) - 1)
        to = min(to, at + max(1, (1 << 22) // groups))
        span = slice(set_begin[at], set_begin[to])
        key = np.repeat(owner[span] - at, fans[span]) * groups + cell_group[_expand(begin[token[span]], fans[span])]
        overlap = np.bincount(key, minlength=(to - at) * groups)
        pairs = np.flatnonzero(overlap)
        overlap = overlap[pairs]
        q, g = np.divmod(pairs, groups)
        q += at
        may = (overlap >= need[q]) & (home[g] == clusters[q]) & (most[g] >= need[q]) & (100 * sizes[q] >= percent * least[g])
        may &= (half[g] > side[q]) if side is not None else (g >= group_of[q])
        opened_set.append(q[may])
        opened_group.append(g[may])
        at = to
    q, g = np.concatenate(opened_set), np.concatenate(opened_group)
    by = np.argsort(g, kind="stable")
    q, g = q[by], g[by]
    edges = np.flatnonzero(np.diff(g, prepend=-1)) if len(g) else np.zeros(0, int)
    members = np.argsort(group_of, kind="stable")
    member_begin = np.searchsorted(group_of[members], np.arange(groups + 1))
    found = []
    for a, b in zip(edges, np.append(edges[1:], len(g))):
        inside = members[member_begin[g[a]] : member_begin[g[a] + 1]]
        if b - a == 1 and len(inside) == 1 and inside[0] == q[a]:
            continue
        found.append(_open(q[a:b], inside, token, set_begin, sizes, percent))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _open(queries, inside, token, set_begin, sizes, percent) -> np.ndarray:
    """Linked pairs of queries and the members of one group, by exact overlaps."""
    own = [token[set_begin[m] : set_begin[m + 1]] for m in inside]
    union = np.unique(np.concatenate(own))
    if not len(union):
        return np.zeros((0, 2), dtype=np.int64)
    has = np.zeros((len(inside), len(union)), dtype=np.float32)
    for i, tokens in enumerate(own):
        has[i, np.searchsorted(union, tokens)] = 1
    out = []
    for at in range(0, len(queries), 512):
        part = queries[at : at + 512]
        counts = set_begin[part + 1] - set_begin[part]
        tokens = token[_expand(set_begin[part], counts)]
        row = np.repeat(np.arange(len(part)), counts)
        place = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
        good = union[place] == tokens
        asks = np.zeros((len(part), len(union)), dtype=np.float32)
        asks[row[good], place[good]] = 1
        shared = (asks @ has.T).astype(np.int64)
        linked = 100 * shared >= percent * (sizes[part][:, None] + sizes[inside][None, :] - shared)
        i, j = np.nonzero(linked & (part[:, None] != inside[None, :]))
        out.append(np.column_stack([part[i], inside[j]]))
    return np.concatenate(out)


# --- the operator ------------------------------------------------------------------------------

def similar_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Link rows of docs (doc_id, text) by Jaccard similarity of word shingles.

    Returns doc_id, n_shingles and component_id (the smallest doc_id reachable by links). Every row is a vertex of
    its own, also where ids repeat with other texts; rows without an id link like others and have a
    component named by the ids that they reach, null if none.
    """
    numbered = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")
    ), "numbered")
    rows = numbered.select(F.col("row").alias("doc_id"), "text")
    classes = row_classes(rows, size, percent).withColumnRenamed("doc_id", "row")
    named = classes.join(numbered.select("row", "doc_id"), "row")
    first = named.groupBy("component_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    several = first.where("n > 1").select("component_id", "first")
    return named.join(several, "component_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id")
    )


def row_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The same over rows whose doc_id numbers them uniquely, as monotonically_increasing_id does."""
    spark = docs.sparkSession
    parts = width(spark)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.caches("jaccard_join")
        for batch in batches:
            for piece in words.pieces(batch, "text", 1 << 21):
                sets = shingle_sets(piece.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "class"],
                )

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.caches("jaccard_join")
        for batch in batches:
            for piece in words.pieces(batch, "text", 1 << 23):
                known: dict[int, np.ndarray] = {}
                for small in words.pieces(piece, "text", 1 << 21):
                    for s in shingle_sets(small.column("text"), size):
                        for level, slices, _ in slice_levels(len(s), percent) if len(s) else ():
                            name = node(_digest(s), level)
                            if name not in known:
                                known[name] = slice_digests(s, level, slices)
                out = _slice_rows(list(known), list(known.values()), parts)
                if out is not None:
                    yield out

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names = batch.column("n").to_pylist(), batch.column("class").to_pylist()
            found = [
                (i, node(names[i], level), need)
                for i, n in enumerate(sizes) for level, _, need in slice_levels(n, percent)
            ]
            at, nodes, needs = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()), pa.array(needs, pa.int64()),
                    batch.column("doc_id").take(pa.array(at, pa.int64())), batch.column("n").take(pa.array(at, pa.int64())),
                ],
                names=["node", "need", "doc_id", "n"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    sketches = materialize(rows.mapInArrow(sketch, "doc_id long, n_shingles long, class long"), "sets")
    # One document stands for a class.
    standing = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n")
    )
    nodes = standing.mapInArrow(levels, "node long, need long, doc_id long, n long")
    slices = rows.mapInArrow(sliced, "part int, slices binary, classes binary, numbers binary")
    near = materialize(
        slices.repartitionById(parts, F.col("part")).mapInArrow(_slice_links, "a long, b long, slices long"), "near"
    )
    shared = near.groupBy(F.col("a").alias("node")).agg(F.sum("slices").alias("shared"))
    able = materialize(nodes.join(shared, "node").where("shared >= need").select("node", "doc_id", "n"), "able")
    ends = able.select("node")
    kept = near.select("a", "b").distinct().where("a <> b").join(ends.toDF("a"), "a", "left_semi").join(
        ends.toDF("b"), "b", "left_semi"
    )
    # A leader that goes no further still holds its slice's other nodes together.
    lost = near.select("a", "b").distinct().join(ends.toDF("a"), "a", "left_semi").join(ends.toDF("b"), "b", "left_anti")
    clusters = components(kept.select("a", "b").union(lost.select("a", "b")))
    named = clusters.select("node", "component").union(clusters.select("component", "component").distinct())
    members = materialize(named.toDF("node", "cluster").join(able, "node").select("doc_id", "n", "cluster"), "clusters")
    links = materialize(_cluster_links(rows, members, size, percent, parts), "links")
    tree = components(links)
    # Components of classes are named by their smallest document.
    firsts = standing.select("class", F.col("doc_id").alias("first"))
    joined = sketches.join(firsts, "class", "left").join(tree, F.col("first") == F.col("node"), "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "first"))
    return joined.select("doc_id", "n_shingles", F.coalesce(own, F.col("doc_id")).alias("component_id"))


def _cluster_links(rows: DataFrame, members: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """Links between the standing documents of the clusters' classes."""
    sums = members.groupBy("cluster").agg(F.sum("n").alias("load"))
    chunks = F.when(F.col("load") > TASK_SHINGLES, F.ceil(F.col("load") / CHUNK_SHINGLES)).otherwise(F.lit(1))
    plan = sums.withColumn("chunks", chunks.cast("int"))
    placed = members.join(plan, "cluster").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks").cast("long")).cast("int")
    ).select(F.col("doc_id").alias("standing"), "cluster", "chunks", "chunk")
    # Only texts of clusters cross a shuffle. Copies of a standing document's id (repeated rows) count once.
    texts = where_marked(rows, "doc_id", row_marks(members, "doc_id")).alias("r").join(placed.alias("p"), F.expr("r.doc_id = p.standing")).select(
        "r.doc_id", "r.text", "p.cluster", "p.chunks", "p.chunk"
    ).dropDuplicates(["doc_id", "cluster"])
    # A small cluster is one task's work with others; a chunk goes to each pair of chunks it is in.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("chunk", other).alias("i"), F.greatest("chunk", other).alias("j")),
    )
    dealt = texts.withColumn("pair", F.explode(pairs)).withColumn(
        "home", F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(8 * parts))).otherwise(
            F.xxhash64("cluster", "pair.i", "pair.j")
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        sets: list[np.ndarray] = []
        for batch in table.select(["text"]).to_batches():
            for piece in words.pieces(batch, "text"):
                sets += shingle_sets(piece.column("text"), size)
        i, j, chunk, cut = (table.column(c).to_numpy() for c in ("i", "j", "chunk", "chunks"))
        _, cluster = np.unique(table.column("cluster").to_numpy(), return_inverse=True)
        across = bool(len(cut)) and cut[0] > 1 and i[0] != j[0]
        pairs = links_within(sets, cluster, percent, (chunk == j).astype(np.int64) if across else None)
        a, b = contract(ids[pairs[:, 0]], ids[pairs[:, 1]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.select(
        "doc_id", "text", "cluster", "chunks", "chunk", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "home"
    ).groupBy("home").applyInArrow(compare, "a long, b long")
