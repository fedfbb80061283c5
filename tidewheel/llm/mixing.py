"""Mixing sources to target weights by subset-sum fitting.

Each source has a target in words. Whole passes over the source come first; what is left of the
target is fitted with documents of exact lengths: from a count of documents by length, a proportional
share of every length is taken, the few words that then remain are fitted by greedy steps and a
bounded-knapsack dynamic programme over the unused counts. Which documents of a length go in is
decided by a seeded hash, so a rerun takes the same ones.

Only lengths and counts meet in one task: a source has at most sqrt(2 x its words) distinct lengths.
Documents of one length are ranked in hash buckets, so a length that a third of all rows share is
ranked in parallel. Texts never cross a shuffle: the plan comes down to a cut for each source and length,
which the documents meet where they are.

Defined results: a null text has 0 words and is taken 0 times; null sources form the last source; a
source without words has target 0; repeated rows are separate documents. No documents, no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import materialize, word_count
from tidewheel.operators.ranking import running_by_key

MOST_PASSES = 3
BUCKETS = 4096
#: Words that the dynamic programme fits at most; greedy steps bring the rest below it.
DP_WORDS = 1 << 16
#: Most sources and lengths whose cuts are broadcast; more are joined on a salted key.
BROADCAST_ROWS, SALTS = 1 << 18, 16


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to budget as can be."""
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    words = int((lengths * counts).sum())
    budget = max(0, min(int(budget), words))
    if not words:
        return np.zeros_like(counts)
    take = np.array([int(c) * budget // words for c in counts], dtype=np.int64)
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= DP_WORDS:
            break
        more = min(int(counts[i] - take[i]), (left - DP_WORDS) // int(lengths[i]) if lengths[i] else 0)
        take[i] += more
        left -= more * int(lengths[i])
    for i in np.argsort(lengths, kind="stable"):  # room for the programme to choose in
        back = min(int(take[i]), (DP_WORDS - left) // int(lengths[i])) if lengths[i] and left < DP_WORDS else 0
        take[i] -= back
        left += back * int(lengths[i])
    take += _knapsack(lengths, counts - take, left)
    return take


def _knapsack(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack with value = weight: the largest sum up to budget, one step past it if nearer."""
    reach = np.zeros(budget + 1, dtype=bool)
    reach[0] = True
    by = np.full(budget + 1, -1, dtype=np.int64)
    items: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        if reach[budget]:
            break
        n, one = int(lengths[i]), 1
        rest = min(int(free[i]), budget // n) if n else 0
        while rest and not reach[budget]:
            pack = min(one, rest)
            weight = pack * n
            fresh = reach[: budget + 1 - weight] & ~reach[weight:]
            by[weight:][fresh] = len(items)
            reach[weight:] |= fresh
            items.append((int(i), pack))
            rest -= pack
            one *= 2
    out = np.zeros(len(lengths), dtype=np.int64)
    at = int(np.flatnonzero(reach)[-1])
    missing = budget - at
    while at:
        i, pack = items[by[at]]
        out[i] += pack
        at -= pack * int(lengths[i])
    over = np.flatnonzero((free - out > 0) & (lengths > 0))
    if missing and len(over):
        shortest = over[np.argmin(lengths[over])]
        if int(lengths[shortest]) - missing < missing:
            out[shortest] += 1
    return out


def source_targets(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """Targets of sources (source, source_size): weights 1, 2, 3, ... by code point, null last.

    A target stops at three times its source's size; the excess goes to the others by weight, again
    and again. That settles at min(3 x size, level x weight) with one level for all, found here from
    running sums over the sources in the order in which they reach their stop. One row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    cap = MOST_PASSES * F.col("source_size").cast("double")
    everything = Window.partitionBy()
    by_stop = Window.orderBy("stop", F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("cap", cap).withColumn("stop", F.col("cap") / F.col("weight"))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(onwards))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    )
    level = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    return levels.withColumn("lambda", level).select(
        "source", "source_size",
        F.when(F.col("lambda").isNull() | (F.col("stop") < F.col("lambda")), F.col("cap"))
        .otherwise(F.col("lambda") * F.col("weight")).alias("target"),
    )


def _seeded(seed: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), F.col("doc_id"))


def mix_to_weights(docs: DataFrame, seed: int = 7, share: float = 1.0) -> DataFrame:
    """How often the mix takes each row of docs (doc_id, source, text): columns of the plan.

    Returns doc_id, source, size, source_size, target, repeats (how often) and taken (words).
    """
    counted = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size")
    ).withColumn("rank_hash", _seeded(seed)).withColumn("bucket", F.pmod(F.shiftright("rank_hash", 32), F.lit(BUCKETS)))
    rows = materialize(counted, "mix-rows")  # a few bytes a row; texts are read once
    cells = rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    lengths = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = source_targets(sizes, share)
    plan_in = lengths.alias("l").join(targets.alias("t"), F.expr("l.source <=> t.source")).select(
        "l.source", "l.size", "l.n", "t.source_size", "t.target"
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        words, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        budget = int(np.floor(target + 0.5))
        passes = min(MOST_PASSES, budget // words) if words else 0
        rest = budget - passes * words if passes < MOST_PASSES else 0
        extra = fit_counts(group["size"].to_numpy(), group["n"].to_numpy(), rest)
        return group[["source", "size", "source_size", "target"]].assign(passes=passes, extra=extra)

    plan = plan_in.groupBy("source").applyInPandas(
        fit, "source string, size long, source_size long, target double, passes long, extra long"
    )
    in_cell = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("start", F.coalesce(F.sum("n").over(in_cell), F.lit(0)))
    quota = starts.alias("s").join(plan.alias("p"), F.expr("s.source <=> p.source AND s.size = p.size")).select(
        "s.source", "s.size", "s.bucket", "p.source_size", "p.target", "p.passes",
        F.expr("greatest(0, least(s.n, p.extra - s.start))").alias("quota"),
    )
    place = Window.partitionBy("source", "size", "bucket").orderBy("rank_hash", "doc_id")
    ranked = rows.withColumn("place", F.row_number().over(place))
    same = F.expr("r.source <=> q.source AND r.size = q.size AND r.bucket = q.bucket")
    repeats = F.expr("CASE WHEN r.size = 0 THEN 0L WHEN r.place <= q.quota THEN q.passes + 1 ELSE q.passes END")
    return ranked.alias("r").join(quota.alias("q"), same).select(
        "r.doc_id", "r.source", "r.size", "q.source_size", "q.target", repeats.cast("long").alias("repeats")
    ).withColumn("taken", F.col("repeats") * F.col("size"))


def mixed_documents(docs: DataFrame, seed: int = 7, share: float = 1.0, copy: str | None = None) -> DataFrame:
    """The mix itself: rows of docs with all their columns, each as often as the plan takes it.

    `copy` names a further column for the number of the copy, from 1; a column of that name in docs gives way. Rows of
    one id, source and length are planned alike or one pass apart; where the plan takes some of them once
    more, those with the smallest text digests are taken.
    """
    number = copy or "__copy"
    names = [f"`{c}`" for c in docs.columns if c != number]
    cuts = materialize(_cuts(docs, seed, share), "mix-plan")
    held = docs.drop(number).select(
        F.struct(*names).alias("__row"), F.col("doc_id"), F.col("source").cast("string").alias("source"),
        word_count().alias("size"), _order(seed).alias("place"), F.xxhash64("text").alias("digest"),
    ).alias("d")
    same = F.expr("d.source <=> p.source AND d.size = p.size")
    if cuts.count() <= BROADCAST_ROWS:
        joined = held.join(F.broadcast(cuts).alias("p"), same)
    else:  # a length of very many documents is met in SALTS places
        salts = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt")
        joined = held.join(cuts.select("*", salts).alias("p"), same & F.expr(f"pmod(d.digest, {SALTS}) = p.salt"))
    at = "d.place <=> p.last.place"
    times = F.expr(f"CASE WHEN p.low = p.high THEN p.low WHEN d.place < p.last.place OR {at} THEN p.high ELSE p.low END")
    split = F.expr(f"p.low < p.high AND p.last.extra > 0 AND {at}")
    taken = joined.where(~split).select("__row", times.alias("times"))
    if not cuts.where("low < high AND last.extra > 0").isEmpty():
        parts = joined.where(split).select("__row", "d.doc_id", "d.source", "d.size", "d.digest", "p.last.least", "p.last.extra")
        placed = running_by_key(parts, ["doc_id", "source", "size"], ["digest"], place="nth")
        taken = taken.unionByName(placed.select("__row", F.expr("least + IF(nth < extra, 1, 0)").alias("times")))
    mixed = taken.where("times > 0").select(
        *[F.col(f"__row.{c}") for c in names], F.explode(F.expr("sequence(1, CAST(times AS int))")).alias(number)
    )
    return mixed if copy else mixed.drop(number)


def _order(seed: int) -> Column:
    """The order in which the plan takes documents of one source and length."""
    at = _seeded(seed)
    return F.struct(F.pmod(F.shiftright(at, 32), F.lit(BUCKETS)).alias("bucket"), at.alias("rank_hash"), F.col("doc_id").alias("id"))


def _cuts(docs: DataFrame, seed: int, share: float) -> DataFrame:
    """The plan as one row a source and length: up to `last` documents are taken `high` times, later ones `low` times.

    Rows of one id stand at one place. Where the last place has some of its rows taken once more, `extra` is
    their number and not 0; the rows of every other place are planned alike.
    """
    key = ["doc_id", "source", "size"]
    places = mix_to_weights(docs, seed, share).groupBy(*key).agg(
        F.min("repeats").alias("least"), F.sum("repeats").alias("all"), F.count("*").alias("n")
    ).selectExpr(*key, "least", "all - least * n AS extra").withColumn("place", _order(seed))
    most = F.expr("least + IF(extra > 0, 1, 0)")
    return places.groupBy("source", "size").agg(
        F.min("least").alias("low"), F.max(most).alias("high"),
        F.max_by(F.struct("place", "least", "extra"), F.struct(most, "place")).alias("last"),
    )
