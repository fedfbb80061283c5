"""Near duplicates among embeddings: int8 tile products with rigorous error bounds.

Vectors are compared within their label (and dimension). Equal vectors collapse to one class, so a
vector that a third of all rows share is one entry with a count. The classes of a label are dealt into
tiles; each pair of tiles is a task. A task quantises unit vectors to int8 with a scale each, measures
each vector's exact quantisation error, and multiplies whole tiles of small integers. With unit
vectors u = a + r (a the quantised form, r its error), |u.v - a.b| <= |r||b| + |s||a| + |r||s|, so only
pairs whose product plus that bound reaches the threshold are computed again in double precision.

Pairs are never emitted: a task returns the link count of each vector in its tiles and a spanning
forest of its links. The work within a label is quadratic in its distinct vectors, as any exact
comparison without an index; a vector travels once for each tile of its label (4,096 vectors a tile).

Defined results: null labels, and vectors that are null, empty, zero, or hold null or non-finite
components, link with nothing; their component is their own id. Vectors of different dimensions link
with nothing. Repeated rows count as other vectors, and rows of one id with other vectors or labels are vertices
of their own. Vectors without id get a row but no links. Components are scaled by a power of two of each
vector's largest, which rounds nothing, so no square overflows or vanishes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import materialize
from tidewheel.llm.components import components, contract

TILE = 4096
STEP = 1024
#: Integer products stay exact in single precision up to so many dimensions at once.
EXACT_DIMS = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows to (int8 rows, scales, error norms, norms of the quantised rows)."""
    scale = np.abs(unit).max(axis=1) / 127.0
    small = np.rint(unit / scale[:, None]).astype(np.int8)
    back = small * scale[:, None]
    # A hair is added for the rounding of these sums themselves.
    error = np.linalg.norm(unit - back, axis=1) * (1 + 1e-9) + 1e-12
    return small, scale, error, np.linalg.norm(back, axis=1) + 1e-12


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, at : at + EXACT_DIMS].astype(np.float32) @ b[:, at : at + EXACT_DIMS].astype(np.float32).T
    return out


def tile_links(x: np.ndarray, y: np.ndarray | None, least: float) -> np.ndarray:
    """Pairs (i, j) with cosine >= least between rows of x and y, or i < j within x, in double precision."""
    other = x if y is None else y
    norms, other_norms = np.linalg.norm(x, axis=1), np.linalg.norm(other, axis=1)
    qa, sa, ea, na = quantise(x / norms[:, None])
    qb, sb, eb, nb = quantise(other / other_norms[:, None])
    found = []
    for i in range(0, len(x), STEP):
        for j in range(0 if y is not None else i, len(other), STEP):
            a, b = slice(i, i + STEP), slice(j, j + STEP)
            near = _products(qa[a], qb[b]) * sa[a][:, None] * sb[b][None, :]
            near += ea[a][:, None] * (nb[b] + eb[b])[None, :] + na[a][:, None] * eb[b][None, :]
            p, q = np.nonzero(near >= least - 1e-9)
            p, q = p + i, q + j
            if y is None:
                p, q = p[p < q], q[p < q]
            for at in range(0, len(p), 1 << 16):
                u, v = p[at : at + (1 << 16)], q[at : at + (1 << 16)]
                cosine = np.einsum("ij,ij->i", x[u], other[v]) / (norms[u] * other_norms[v])
                good = cosine >= least
                found.append(np.column_stack([u[good], v[good]]))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def near_duplicates(vectors: DataFrame, least: float = 0.98, tile: int = TILE) -> DataFrame:
    """Links of rows of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("embedding"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    zero = ~F.exists("embedding", lambda x: x != 0)
    fit = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & ~zero, F.lit(False))
    rows = rows.withColumn("fit", fit)
    usable = rows.where("fit")
    grouped = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # Classes are numbered in the order of their smallest ids: the smallest number names the smallest id.
    numbered = grouped.repartitionByRange("first").sortWithinPartitions("first").withColumn("class", F.monotonically_increasing_id())
    classes = materialize(numbered, "vectors").withColumn("dim", F.size("embedding"))
    tiles = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = classes.join(tiles, ["label", "dim"]).withColumn(
        "tile", F.pmod(F.xxhash64("class"), F.col("tiles").cast("long")).cast("int")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(F.least("tile", other).alias("i"), F.greatest("tile", other).alias("j")),
    )
    dealt = dealt.select("label", "dim", "class", "copies", "embedding", "tile", F.explode(pairs).alias("pair"))

    def compare(group: pa.Table) -> pa.Table:
        n, dim = group.num_rows, group.column("dim")[0].as_py()
        values = np.asarray(group.column("embedding").combine_chunks().flatten(), dtype=np.float64).reshape(n, dim)
        values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1))[1][:, None])
        first, copies = group.column("class").to_numpy(), group.column("copies").to_numpy()
        side = group.column("tile").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
        if i == j:
            links = a[tile_links(values[a], None, least)]
        elif len(a) and len(b):
            found = tile_links(values[a], values[b], least)
            links = np.column_stack([a[found[:, 0]], b[found[:, 1]]])
        else:
            links = np.zeros((0, 2), dtype=np.int64)
        degree = np.bincount(links[:, 0], copies[links[:, 1]], n) + np.bincount(links[:, 1], copies[links[:, 0]], n)
        met = np.flatnonzero(degree)
        x, y = contract(first[links[:, 0]], first[links[:, 1]])
        return pa.table({
            "a": pa.array(np.concatenate([first[met], x]), pa.int64()),
            "b": pa.array(np.concatenate([np.zeros(len(met), np.int64), y]), pa.int64()),
            "degree": pa.array(np.concatenate([degree[met].astype(np.int64), np.zeros(len(x), np.int64)]), pa.int64()),
        })

    flat = dealt.select("label", "dim", "class", "copies", "embedding", "tile", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))
    found = materialize(flat.groupBy("label", "dim", "i", "j").applyInArrow(compare, "a long, b long, degree long"), "tile-links")
    degrees = found.where("degree > 0").groupBy(F.col("a").alias("class")).agg(F.sum("degree").alias("degree"))
    tree = components(found.where("degree = 0").select("a", "b"))
    heads = classes.select(F.col("class").alias("component"), F.col("first").alias("head"))
    tree = tree.join(heads, "component").select(F.col("node").alias("class"), "head")
    named = classes.join(degrees, "class", "left").join(tree, "class", "left").select(
        "label", "embedding", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("head", "first").alias("component"),
    )
    linked = usable.join(named, ["label", "embedding"]).select("vec_id", "links", "component")
    alone = rows.where("NOT fit").select("vec_id", F.lit(0).cast("long"), "vec_id")
    out = linked.union(alone).toDF("vec_id", "n_links", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
