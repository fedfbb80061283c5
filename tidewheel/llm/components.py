"""Connected components of a graph given as edges, by large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import materialize, width

ROUNDS = 60
#: Most centres that are broadcast; more are joined on a salted key.
BROADCAST_ROWS, SALTS = 1 << 18, 16


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) of the edges a-b, for nodes that are not their own smallest."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task to a star forest, batch by batch; never more than a batch and its forest."""
    held_a, held_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([held_a, batch.column("a").to_numpy()])
        b = np.concatenate([held_b, batch.column("b").to_numpy()])
        held_a, held_b = contract(a, b)
        if len(held_a) > 1 << 21:
            yield pa.RecordBatch.from_arrays([pa.array(held_a), pa.array(held_b)], names=["a", "b"])
            held_a, held_b = held_a[:0], held_b[:0]
    if len(held_a):
        yield pa.RecordBatch.from_arrays([pa.array(held_a), pa.array(held_b)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to (node, component): the smallest node reachable, for linked nodes but it.

    Tasks contract their edges to stars, without a join; dealt by the larger end and contracted again, a node
    keeps one edge, whatever its degree was, and only the centres of stars have edges among each other. Star
    rounds run over the centres alone: each links every neighbour of a node to the smallest of its
    neighbourhood, first the larger ones, then the smaller, and ends when a round changes nothing. At
    the end nodes take their centre's component. Steps are written to the shared folder, which cuts the lineage.
    """
    forest = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    forest = materialize(forest.mapInArrow(_contracted, "a long, b long"), "links")
    dealt = forest.repartition(width(edges.sparkSession), "a")
    forest = materialize(dealt.mapInArrow(_contracted, "a long, b long").distinct(), "links")
    several = forest.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")  # centres of tasks, met in several parts
    centres = forest.select(F.col("b").alias("a")).union(several.select("a")).distinct()
    core = _stars(materialize(forest.join(centres, "a", "left_semi"), "links"))
    leaves = forest.join(centres, "a", "left_anti")
    moved = core.select(F.col("a").alias("b"), F.col("b").alias("centre"))
    if core.count() <= BROADCAST_ROWS:
        named = leaves.join(F.broadcast(moved), "b", "left")
    else:  # a centre of very many nodes is met in SALTS places
        salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
        named = leaves.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int")).join(moved.select("*", salts), ["b", "salt"], "left")
    rest = named.select(F.col("a").alias("node"), F.coalesce("centre", "b").alias("component"))
    return rest.unionByName(core.select(F.col("a").alias("node"), F.col("b").alias("component")))


def _stars(forest: DataFrame) -> DataFrame:
    """Edges to (a, b) with b the smallest node that a reaches."""
    if forest.isEmpty():
        return forest
    for _ in range(ROUNDS):
        # Large star: each larger neighbour of a node goes to the node's smallest neighbour (or itself).
        both = forest.select("a", "b").union(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        linked = large.join(least.where("n > 1"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = least.select("a", F.col("m").alias("b")).union(linked).distinct()
        after = materialize(small, "links")
        changed = after.join(forest, ["a", "b"], "left_anti").isEmpty() and after.count() == forest.count()
        forest = after
        if changed:
            return forest
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
