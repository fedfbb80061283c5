"""Histogram boosting of regression trees over columns that are binned once.

Binning. Every feature is cut into at most 255 bins of about equal weight, found from exact counts of
the leading 20 bits of its values (integers up to 512 keep a level each). Nulls and NaN sort lowest.

Cells. For squared loss, rows that fall into the same bins of all features move together through every
tree, so one aggregation with map-side combine reduces the table to its distinct bin rows with
their count and sum of labels; nothing is lost. Labels are fixed-point numbers, so all sums are exact
integers, and the trees do not depend on how rows are partitioned.

Fitting. All trials grow in lockstep, level by level, in one barrier stage: every task holds a part of the cells, PART_CELLS
or more and CELL_LIMIT at most. The tasks sum their histograms by (trial, node, feature bin) through files in the shared
folder, and each cuts the same nodes. Fewer cells, or a folder that plain files cannot reach, are broadcast up to
CELL_LIMIT, a proven bound of some 100 megabytes, and every trial is one task that grows its trees over its own copy.
In both, features are counted together by the combinations that occur, and of two children only the one with fewer
rows is counted. More cells than that are aggregated by a job for each level. All ways give the same trees.

A split has the highest gain, then the first feature, then the lowest cut, with min_rows rows on
both sides. Rows without a finite label are left out; a table without any gives a model that predicts null.
"""

from __future__ import annotations

import os
import pickle
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import materialize, shared_root, work_path

BINS = 255
#: Cells that are broadcast, a task a trial: 27 bytes each with eleven features, 113 MB in all.
CELL_LIMIT = 1 << 22
#: Cells counted at a time, and the most bins of features that are counted together.
CHUNK, JOINT = 1 << 16, 256
#: Combinations of bins that are counted together, in nodes of few and of many cells.
SEEN = 128, 2048
#: Cells a task holds at least where tasks grow trees together, the most such tasks, and how long one waits for another.
PART_CELLS, MOST_PARTS, MEETING_SECONDS = 1 << 16, 32, 1800
#: Fixed-point scale of labels, gradients and leaf values.
SCALE = 1 << 16
#: Trees between two writes of the state when cells are spread.
STATE_TREES = 10
MIN_ROWS = 20
_NULL_LEVEL = -(1 << 30)
_LOW = 26


@dataclass(frozen=True)
class Settings:
    """What one trial fits."""

    n_estimators: int = 200
    learning_rate: float = 0.05
    max_depth: int = 3
    min_rows: int = MIN_ROWS


@dataclass
class Binning:
    """For each feature the levels at which a new bin starts."""

    names: list[str]
    cuts: list[np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        """Where each feature's slots start in a histogram, and the number of all slots."""
        return np.append(0, np.cumsum([len(c) + 1 for c in self.cuts]))

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        columns = [np.searchsorted(c, levels(batch.column(n)), side="right") for n, c in zip(self.names, self.cuts)]
        return np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros((len(batch), 0), np.uint8)


@dataclass
class Tree:
    """Nodes in order of making; the children of node i are left[i] and left[i] + 1, leaves have feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[int] = field(default_factory=lambda: [0])

    def plain(self) -> tuple:
        return self.feature, self.cut, self.left, self.value

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                return node
            at, on = rows[inner], node[inner]
            node[inner] = left[on] + (bins[at, feature[on]] > cut[on])

    def add(self, bins: np.ndarray, sums: np.ndarray) -> None:
        sums += np.array(self.value, np.int64)[self.route(bins)]


@dataclass
class Model:
    """A fitted booster; base is None where there was nothing to fit."""

    binning: Binning
    base: int | None
    trees: list[Tree]
    settings: Settings

    def plain(self) -> tuple:
        """What of() makes the model from, free of classes, to travel to tasks that hold no copy of this package."""
        return (self.binning.names, self.binning.cuts), self.base, [t.plain() for t in self.trees], astuple(self.settings)

    @staticmethod
    def of(plain: tuple) -> "Model":
        binning, base, trees, settings = plain
        return Model(Binning(*binning), base, [Tree(*t) for t in trees], Settings(*settings))

    def values(self, bins: np.ndarray) -> np.ndarray:
        sums = np.full(len(bins), self.base or 0, np.int64)
        for tree in self.trees:
            tree.add(bins, sums)
        return sums / SCALE

    def transform(self, frame: DataFrame, out: str = "prediction") -> DataFrame:
        """The frame with the prediction of each row."""
        if self.base is None:
            return frame.withColumn(out, F.lit(None).cast("double"))
        shared = frame.sparkSession.sparkContext.broadcast(self.plain())
        names, columns = self.binning.names, frame.columns

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model.of(shared.value)
            for batch in batches:
                part = batch.select(range(len(columns))).rename_columns(columns)
                inputs = pa.RecordBatch.from_arrays([batch.column(len(columns) + i) for i in range(len(names))], names=names)
                yield part.append_column(out, pa.array(model.values(model.binning.bins(inputs))))

        inputs = [F.col(n).cast("double").alias(f"__feature_{i}") for i, n in enumerate(names)]
        schema = frame.select("*", F.lit(0.0).alias(out)).schema
        return frame.select("*", *inputs).mapInArrow(predict, schema)


def levels(column: pa.Array) -> np.ndarray:
    """The leading 20 bits of each value as an integer of the same order; nulls and NaN lowest."""
    values = np.array(pa.compute.fill_null(column.cast(pa.float64()), float("nan")), dtype=np.float64) + 0.0
    bits = values.view(np.int64)
    ordered = np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)
    return np.where(np.isnan(values), _NULL_LEVEL, ordered >> 44)


def _cuts(found: list[tuple[int, int]], most: int) -> np.ndarray:
    """Levels that start a bin, from (level, rows) in order: all, or bins of about equal weight."""
    if len(found) <= most:
        return np.array([level for level, _ in found[1:]], np.int64)
    total, weight, cuts = sum(n for _, n in found), 0, []
    for level, n in found:
        if weight * most >= (len(cuts) + 1) * total:
            cuts.append(level)
        weight += n
    return np.array(cuts, np.int64)


def find_bins(frame: DataFrame, features: list[str], most: int = BINS) -> Binning:
    """Bins of all features from one pass; at most 2^20 levels a feature reach the driver."""
    doubles = frame.select(*[F.col(c).cast("double").alias(c) for c in features])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(features)):
                level, n = np.unique(levels(batch.column(i)), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array(np.full(len(level), i, np.int32)), "level": pa.array(level), "n": pa.array(n.astype(np.int64)),
                })

    counted = doubles.mapInArrow(count, "feature int, level long, n long").groupBy("feature", "level").agg(F.sum("n").alias("n"))
    found: list[list[tuple[int, int]]] = [[] for _ in features]
    for row in counted.collect():
        found[row["feature"]].append((row["level"], row["n"]))
    return Binning(features, [_cuts(sorted(f), most) for f in found])


def cells(frame: DataFrame, binning: Binning, label: str) -> DataFrame:
    """(bins, n, total): the distinct bin rows with their rows and sum of fixed-point labels."""
    names = binning.names
    inputs = [F.col(c).cast("double").alias(c) for c in names]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(len(names)).fill_null(float("nan")))
            kept = np.flatnonzero(np.isfinite(labels))
            bins = np.ascontiguousarray(binning.bins(batch)[kept])
            width = max(1, bins.shape[1])
            rows = (bins if bins.shape[1] else np.zeros((len(kept), 1), np.uint8)).view(f"V{width}").ravel()
            found, inverse, n = np.unique(rows, return_inverse=True, return_counts=True)
            totals = np.zeros(len(found), np.int64)
            np.add.at(totals, inverse.ravel(), np.rint(labels[kept] * SCALE).astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "bins": pa.array([x.tobytes() for x in found], pa.binary()), "n": pa.array(n.astype(np.int64)), "total": pa.array(totals),
            })

    rows = frame.select(*inputs, F.col(label).cast("double").alias("__label"))
    folded = rows.mapInArrow(fold, "bins binary, n long, total long")
    return folded.groupBy("bins").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _high(values: np.ndarray) -> np.ndarray:
    return (values >> _LOW).astype(np.float64)


def _low(values: np.ndarray) -> np.ndarray:
    return (values & ((1 << _LOW) - 1)).astype(np.float64)


def _exact(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums by index, exact: doubles are whole numbers whose sums they hold, others are summed in two such halves."""
    if values.dtype == np.float64:
        return np.bincount(index, values, size).astype(np.int64)
    sums = np.bincount(index, _high(values), size).astype(np.int64) << _LOW
    return sums + np.bincount(index, _low(values), size).astype(np.int64)


def joint_columns(bins: np.ndarray, offsets: np.ndarray) -> list[tuple[list[int], list[int], np.ndarray]]:
    """(features, their bins, joint bin of each cell), features of few bins together as long as JOINT holds the product."""
    widths, groups = np.diff(offsets).tolist(), []
    for f in sorted(range(len(widths)), key=lambda f: widths[f]):
        if not groups or int(np.prod([widths[g] for g in groups[-1]])) * widths[f] > JOINT:
            groups.append([])
        groups[-1].append(f)
    joint = []
    for group in groups:
        column = np.zeros(len(bins), np.uint8)  # JOINT bins, or one feature's, fit a byte
        for f in group:
            column = column * np.uint8(widths[f] & 255) + bins[:, f]
        joint.append((group, [widths[f] for f in group], column))
    return joint


def histograms(joint: list[tuple], node: np.ndarray, n: np.ndarray, gradient: np.ndarray, nodes: int, offsets: np.ndarray) -> np.ndarray:
    """(nodes, 2, slots): rows and gradients by (node, slot); node is a place among the nodes asked for, or -1."""
    found = np.zeros((nodes, 2, int(offsets[-1])), np.int64)
    for at in range(0, len(node), CHUNK):
        inside = np.flatnonzero(node[at : at + CHUNK] >= 0) + at
        if not len(inside):
            continue
        place, rows, sums = node[inside].astype(np.int64), n[inside], gradient[inside]
        if int(np.abs(sums).max()) < (1 << 53) // len(sums):  # doubles hold every partial sum
            sums = sums.astype(np.float64)
        for features, widths, column in joint:
            size = int(np.prod(widths))
            index = place * size + column[inside]
            for i, values in enumerate((rows, sums)):
                counted = _exact(index, values, nodes * size).reshape(nodes, *widths)
                for axis, f in enumerate(features, 1):
                    others = tuple(a for a in range(1, len(widths) + 1) if a != axis)
                    found[:, i, offsets[f] : offsets[f + 1]] += counted.sum(axis=others)
    return found


def best_cuts(rows: np.ndarray, gradients: np.ndarray, offsets: np.ndarray, min_rows: int):
    """For each node (slot or -1, rows and gradient left of the cut, rows and gradient in all)."""
    nodes, width = rows.shape
    starts = offsets[:-1]
    feature = np.repeat(np.arange(len(starts)), np.diff(offsets))

    def running(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.cumsum(values, axis=1)
        before = np.concatenate([np.zeros((nodes, 1), np.int64), sums], axis=1)[:, starts]
        return sums - before[:, feature], sums[:, offsets[1] - 1]

    left_rows, all_rows = running(rows)
    left, total = running(gradients)
    right_rows, right = all_rows[:, None] - left_rows, total[:, None] - left
    allowed = (left_rows >= min_rows) & (right_rows >= min_rows)
    allowed[:, offsets[1:] - 1] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = total.astype(float) ** 2 / all_rows
        gain = left.astype(float) ** 2 / left_rows + right.astype(float) ** 2 / right_rows - whole[:, None]
    gain = np.where(allowed, gain, -1.0)
    slot = gain.argmax(axis=1)
    at = np.arange(nodes)
    found = gain[at, slot] > 1e-9 * np.maximum(whole, 1.0)
    return np.where(found, slot, -1), left_rows[at, slot], left[at, slot], all_rows, total


def leaf_value(rate: float, gradient: int, rows: int) -> int:
    return int(np.rint(rate * (float(gradient) / rows)))


def split(tree: Tree, node: int, slot: int, left: tuple[int, int], right: tuple[int, int], offsets: np.ndarray, rate: float) -> None:
    """Cut a leaf at a slot; left and right are (rows, gradient)."""
    feature = int(np.searchsorted(offsets, slot, side="right")) - 1
    tree.feature[node], tree.cut[node], tree.left[node] = feature, slot - int(offsets[feature]), len(tree.feature)
    for rows, gradient in (left, right):
        tree.feature.append(-1)
        tree.cut.append(0)
        tree.left.append(0)
        tree.value.append(leaf_value(rate, gradient, rows))


def _level(tree: Tree, frontier: list[int], cuts, offsets: np.ndarray, settings: Settings) -> list[int]:
    """Cut the nodes of a level; the children that may be cut again."""
    following = []
    for node, slot, left_rows, left, rows, total in zip(frontier, *(c.tolist() for c in cuts)):
        if node == 0:
            tree.value[0] = leaf_value(settings.learning_rate, total, rows)
        if slot < 0:
            continue
        sides = (left_rows, left), (rows - left_rows, total - left)
        first = len(tree.feature)
        split(tree, node, slot, *sides, offsets, settings.learning_rate)
        following += [first + i for i, (n, _) in enumerate(sides) if n >= 2 * settings.min_rows]
    return following


def seen_together(bins: np.ndarray, offsets: np.ndarray, most: int) -> list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """(place of each cell, places, slots, which of these slots each place adds to) of features that are counted together.

    A place is a combination of bins that occurs, so features that depend on each other share few of them.
    """
    widths, found = np.diff(offsets).tolist(), []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        best = None
        for at, (features, place, places) in enumerate(found):
            seen = np.bincount(place * widths[f] + bins[:, f], minlength=places * widths[f]) > 0
            if seen.sum() <= most and (best is None or seen.sum() * len(best[1]) < best[1].sum() * len(seen)):
                best = at, seen
        if best is None:
            found.append(([f], bins[:, f].astype(np.int64), widths[f]))
        else:
            at, seen = best
            features, place, _ = found[at]
            found[at] = [*features, f], (np.cumsum(seen) - 1)[place * widths[f] + bins[:, f]], int(seen.sum())
    together = []
    for features, place, places in found:
        slots = np.concatenate([np.arange(offsets[f], offsets[f + 1]) for f in features])
        adds, first = np.zeros((places, len(slots))), 0
        for f in features:
            adds[place, first + bins[:, f]] = 1
            first += widths[f]
        together.append((place.astype(np.int16), places, slots, adds))
    return together


def whole_weights(values: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(doubles, shift): the values if doubles hold every sum of them, or else their halves, of which they hold CHUNK."""
    if np.abs(values.astype(np.float64)).sum() < 1 << 52:
        return [(values.astype(np.float64), 0)]
    return [(_high(values), _LOW), (_low(values), 0)]


def batches(nodes: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first node, pieces of it and the next ones), CHUNK cells or fewer at once."""
    first, pieces, held = 0, [], 0
    for i, node in enumerate(nodes):
        for at in range(0, max(len(node), 1), CHUNK):
            piece = node[at : at + CHUNK]
            if pieces and (at or held + len(piece) > CHUNK):
                yield first, pieces
                pieces, held = [], 0
            if not pieces:
                first = i
            pieces.append(piece)
            held += len(piece)
    if pieces:
        yield first, pieces


class _Part:
    """The cells of a task, with what each trial has left to explain of them."""

    def __init__(self, bins: np.ndarray, n: np.ndarray, totals: np.ndarray, offsets: np.ndarray, base: int, trials: int) -> None:
        order = np.lexsort(bins.T) if bins.shape[1] else np.arange(len(n))  # like cells go to like leaves, and lie together
        bins, n, totals = bins[order], n[order], totals[order]
        self.columns, self.offsets, self.n = np.ascontiguousarray(bins.T), offsets, n
        self.rows = [(n.astype(np.int16), 0)] if n.max(initial=0) < 1 << 15 else whole_weights(n)
        self.left = [totals - n * base for _ in range(trials)]
        self.together = [seen_together(bins, offsets, most) for most in SEEN]

    def histograms(self, nodes: list[np.ndarray], gradient: list[tuple[np.ndarray, int]]) -> np.ndarray:
        """(nodes, 2, slots): rows and gradients of the cells of each node by slot."""
        whole = len(self.rows) == len(gradient) == 1
        few, many = self.together
        # Many places pay where nodes hold more cells than there are places to sum up.
        cells = sum(len(node) for node in nodes)
        together = many if cells > 16 * len(nodes) * sum(places for _, places, _, _ in many) else few
        counted = [np.zeros((len(nodes), 2, places), np.float64 if whole else np.int64) for _, places, _, _ in together]
        for first, pieces in batches(nodes):
            some, last = np.concatenate(pieces), first + len(pieces)
            at = np.repeat(np.arange(len(pieces)), [len(piece) for piece in pieces])
            weights = [[(values.take(some), shift) for values, shift in both] for both in (self.rows, gradient)]
            for (place, places, _, _), into in zip(together, counted):
                index = at * places + place.take(some) if len(pieces) > 1 else place.take(some)
                for j, both in enumerate(weights):
                    for values, shift in both:
                        sums = np.bincount(index, values, len(pieces) * places).reshape(-1, places)
                        into[first:last, j] += sums if whole else sums.astype(np.int64) << shift
        found = np.zeros((len(nodes), 2, int(self.offsets[-1])), np.int64)
        for (_, _, slots, adds), sums in zip(together, counted):
            found[:, :, slots] = sums @ adds if whole else (_high(sums) @ adds).astype(np.int64) << _LOW
            if not whole:
                found[:, :, slots] += (_low(sums) @ adds).astype(np.int64)
        return found


class _Growing:
    """A tree that grows over the cells of a part, which lie in the order of its leaves.

    Of two children only the one with fewer rows is counted; the other is what is left of its parent.
    """

    def __init__(self, part: _Part, trial: int, settings: Settings) -> None:
        self.part, self.trial, self.settings = part, trial, settings
        self.gradient = whole_weights(part.left[trial])
        self.tree, self.levels = Tree(), settings.max_depth
        self.order, self.span = np.arange(len(part.n)), [(0, len(part.n))]  # of each node: where its cells are
        self.open = [0] if self.levels else []
        self.counted, self.source = list(self.open), [(0, -1)]  # of each open node: its place in counted, its parent's if left over
        self.whole = np.zeros((0, 2, int(part.offsets[-1])), np.int64)

    def partial(self) -> np.ndarray:
        """The histograms of the counted nodes over this part."""
        return self.part.histograms([self.order[slice(*self.span[node])] for node in self.counted], self.gradient)

    def advance(self, found: np.ndarray) -> None:
        """Cut the open nodes by the histograms of the counted ones over all parts, and move the cells."""
        tree, before = self.tree, self.open
        counted, parent = np.array(self.source).T
        whole, left_over = found[counted], parent >= 0
        whole[left_over] = self.whole[parent[left_over]] - whole[left_over]
        cuts = best_cuts(whole[:, 0], whole[:, 1], self.part.offsets, self.settings.min_rows)
        following = _level(tree, before, cuts, self.part.offsets, self.settings)
        self.levels -= 1
        self.whole, self.open, self.counted, self.source = whole, following if self.levels else [], [], []
        wanted = set(self.open)
        for i, (node, left, rows) in enumerate(zip(before, cuts[1].tolist(), cuts[3].tolist())):
            if tree.feature[node] < 0:
                continue
            self._move(node)
            first = tree.left[node]
            kept = [c for c in (first, first + 1) if c in wanted]
            if kept:
                fewer = first + (2 * left > rows)
                self.source += [(len(self.counted), -1 if c == fewer else i) for c in kept]
                self.counted.append(fewer)

    def _move(self, node: int) -> None:
        start, end = self.span[node]
        cells = self.order[start:end]
        right = self.part.columns[self.tree.feature[node]].take(cells) > self.tree.cut[node]
        above, below = cells[right], cells[~right]
        middle = start + len(below)
        self.order[start:middle], self.order[middle:end] = below, above
        self.span += [(start, middle), (middle, end)]

    def finish(self) -> Tree:
        """The tree; its part is left with what it does not explain."""
        leaves = sorted((*self.span[i], self.tree.value[i]) for i, f in enumerate(self.tree.feature) if f < 0)
        values = np.repeat([v for _, _, v in leaves], [end - start for start, end, _ in leaves])
        self.part.left[self.trial][self.order] -= self.part.n[self.order] * values
        return self.tree


def grow(part: _Part, trials: list[Settings], total: Callable[[list[np.ndarray]], list[np.ndarray]]) -> list[list[Tree]]:
    """The trees of all trials in lockstep, level by level; total sums histograms over all parts."""
    done: list[list[Tree]] = [[] for _ in trials]
    for t in range(max(s.n_estimators for s in trials)):
        growing = [_Growing(part, i, s) for i, s in enumerate(trials) if s.n_estimators > t]
        while some := [g for g in growing if g.open]:
            for g, found in zip(some, total([g.partial() for g in some])):
                g.advance(found)
        for g in growing:
            done[g.trial].append(g.finish())
    return done


def fit_cells(bins: np.ndarray, n: np.ndarray, totals: np.ndarray, offsets: np.ndarray, base: int, settings: Settings) -> list[Tree]:
    """The trees of one trial over all cells, level by level."""
    return grow(_Part(bins, n, totals, offsets, base, 1), [settings], lambda found: found)[0]


class _Meeting:
    """Sums of the arrays of all tasks of a barrier stage, which meet in a folder that all of them reach.

    A task writes its arrays of a round only when it has read all of the round before, so those can go then.
    """

    def __init__(self, folder: str, part: int, parts: int) -> None:
        self.folder, self.part, self.parts, self.round = folder, part, parts, 0

    def _path(self, turn: int, part: int) -> str:
        return os.path.join(self.folder, f"{turn}-{part}")

    def _read(self, part: int) -> np.ndarray:
        path, until = self._path(self.round, part), time.monotonic() + MEETING_SECONDS
        while not os.path.exists(path):
            if time.monotonic() > until:
                raise TimeoutError(f"part {part} of {self.parts} did not come to round {self.round}")
            time.sleep(0.0005)
        return np.fromfile(path, np.int64)

    def __call__(self, found: list[np.ndarray]) -> list[np.ndarray]:
        summed = np.concatenate([f.ravel() for f in found])
        own = self._path(self.round, self.part)
        summed.tofile(own + ".new")
        os.replace(own + ".new", own)
        for other in range(1, self.parts):
            summed += self._read((self.part + other) % self.parts)
        if self.round:
            os.remove(self._path(self.round - 1, self.part))
        self.round += 1
        edges = np.cumsum([f.size for f in found])[:-1]
        return [s.reshape(f.shape) for s, f in zip(np.split(summed, edges), found)]


def _read_cells(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    packed = batch.column("bins").cast(pa.binary())
    edges = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(batch) + 1]
    flat = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    return flat.reshape(len(batch), -1)[:, :features], *(np.asarray(batch.column(c), dtype=np.int64) for c in ("n", "total"))


def _fit_tasks(known: DataFrame, binning: Binning, base: int, trials: list[Settings]) -> list[list[Tree]]:
    """One task a trial over broadcast cells."""
    spark = known.sparkSession
    arrow = known.orderBy("bins").toArrow().combine_chunks()
    batch = arrow.to_batches()[0]
    shared = spark.sparkContext.broadcast((*_read_cells(batch, len(binning.names)), binning.offsets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                bins, n, totals, offsets = shared.value
                trees = fit_cells(bins, n, totals, offsets, base, trials[i])
                packed = pickle.dumps([t.plain() for t in trees])
                yield pa.RecordBatch.from_pydict({"trial": pa.array([i], pa.int64()), "trees": pa.array([packed], pa.binary())})

    fitted = spark.range(0, len(trials), 1, len(trials)).mapInArrow(run, "trial long, trees binary")
    return [[Tree(*t) for t in pickle.loads(r["trees"])] for r in sorted(fitted.collect())]


def meeting_parts(spark: SparkSession, cells: int) -> int:
    """Tasks that can grow trees together: as many as run at once, with PART_CELLS cells or more each; 1 if they cannot meet."""
    context = spark.sparkContext
    scala = context._jsc.sc()
    root = urlparse(shared_root(spark))
    files = (root.scheme or urlparse(scala.hadoopConfiguration().get("fs.defaultFS", "file:")).scheme) == "file"
    if not files or context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 1  # plain files are what tasks meet in, and a barrier stage needs all of its tasks at once
    slots = scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())
    return max(1, min(slots, MOST_PARTS, cells // PART_CELLS))


def _fit_parts(known: DataFrame, binning: Binning, base: int, trials: list[Settings], parts: int) -> list[list[Tree]]:
    """One barrier stage: a task holds a part of the cells, and all of them grow the same trees."""
    offsets, features = binning.offsets, len(binning.names)
    folder = urlparse(work_path(known.sparkSession, "boosting-meeting")).path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        number, tasks = context.partitionId(), len(context.getTaskInfos())
        place = os.path.join(folder, context.allGather(uuid.uuid4().hex)[0])  # what a failed attempt left is not read
        os.makedirs(place, exist_ok=True)
        nothing = np.zeros((0, features), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        read = [nothing, *(_read_cells(batch, features) for batch in batches if len(batch))]
        part = _Part(*(np.concatenate(c) for c in zip(*read)), offsets, base, len(trials))
        del read
        fitted = grow(part, trials, _Meeting(place, number, tasks))
        if number == 0:
            packed = [pickle.dumps([t.plain() for t in trees]) for trees in fitted]
            yield pa.RecordBatch.from_pydict({"trial": pa.array(range(len(trials)), pa.int64()), "trees": pa.array(packed, pa.binary())})

    fitted = known.repartition(parts).mapInArrow(run, "trial long, trees binary", barrier=True)
    return [[Tree(*t) for t in pickle.loads(r["trees"])] for r in sorted(fitted.collect())]


def _fit_spread(known: DataFrame, binning: Binning, base: int, trials: list[Settings]) -> list[list[Tree]]:
    """All trials in lockstep: one aggregation over the cells for each level of a tree."""
    context = known.sparkSession.sparkContext
    offsets, features = binning.offsets, len(binning.names)
    state = known.withColumn("sums", F.array(*[F.lit(base).cast("long") for _ in trials]))
    done: list[list[Tree]] = [[] for _ in trials]
    written = 0

    def with_recent(recent: list[list[tuple]]) -> Callable[[pa.RecordBatch], tuple]:
        def read(batch: pa.RecordBatch) -> tuple:
            bins, n, totals = _read_cells(batch, features)
            sums = np.array(batch.column("sums").flatten(), dtype=np.int64).reshape(len(batch), -1)
            for trial, trees in enumerate(recent):
                for tree in trees:
                    values = np.ascontiguousarray(sums[:, trial])
                    Tree(*tree).add(bins, values)
                    sums[:, trial] = values
            return bins, n, totals, sums
        return read

    def level(recent, growing) -> DataFrame:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = with_recent(recent.value)
            for batch in batches:
                if not len(batch):
                    continue
                bins, n, totals, sums = read(batch)
                joint = joint_columns(bins, offsets)
                for trial, (plain, frontier) in growing.value.items():
                    tree = Tree(*plain)
                    place = np.full(len(tree.feature), -1)
                    place[frontier] = np.arange(len(frontier))
                    gradient = totals - n * sums[:, trial]
                    counted = histograms(joint, place[tree.route(bins)], n, gradient, len(frontier), offsets)
                    rows, found = counted[:, 0], counted[:, 1]
                    node, slot = np.nonzero(rows)
                    yield pa.RecordBatch.from_pydict({
                        "trial": pa.array(np.full(len(node), trial, np.int64)), "node": pa.array(np.array(frontier, np.int64)[node]),
                        "slot": pa.array(slot.astype(np.int64)), "n": pa.array(rows[node, slot]), "g": pa.array(found[node, slot]),
                    })

        summed = state.mapInArrow(partial, "trial long, node long, slot long, n long, g long")
        return summed.groupBy("trial", "node", "slot").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))

    def best(group: pa.Table) -> pa.Table:
        rows, found = (np.zeros((1, int(offsets[-1])), np.int64) for _ in range(2))
        slot = np.asarray(group["slot"])
        rows[0, slot], found[0, slot] = np.asarray(group["n"]), np.asarray(group["g"])
        trial = group["trial"][0].as_py()
        cuts = best_cuts(rows, found, offsets, trials[trial].min_rows)
        names = ["slot", "left_n", "left_g", "n", "g"]
        return pa.table({"trial": [trial], "node": [group["node"][0].as_py()]} | {c: pa.array(v) for c, v in zip(names, cuts)})

    def advance(added) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = with_recent(added.value)
            for batch in batches:
                if len(batch):
                    sums = read(batch)[3]
                    offsets = np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32)
                    lists = pa.ListArray.from_arrays(offsets, sums.ravel())
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["bins", "n", "total", "sums"])
        return run

    def not_written():
        return context.broadcast([[t.plain() for t in d[written:]] for d in done])

    for t in range(max(s.n_estimators for s in trials)):
        growing = {i: (Tree(), [0]) for i, s in enumerate(trials) if s.n_estimators > t}
        trees = {i: tree for i, (tree, _) in growing.items()}
        recent = not_written()
        for depth in range(max(trials[i].max_depth for i in growing)):
            growing = {i: g for i, g in growing.items() if g[1] and trials[i].max_depth > depth}
            if not growing:
                break
            summed = level(recent, context.broadcast({i: (tree.plain(), nodes) for i, (tree, nodes) in growing.items()}))
            schema = "trial long, node long, slot long, left_n long, left_g long, n long, g long"
            found: dict[int, dict[int, tuple]] = {}
            for r in summed.groupBy("trial", "node").applyInArrow(best, schema).collect():  # a row for each open node
                found.setdefault(r["trial"], {})[r["node"]] = tuple(r)[2:]
            for i, (tree, frontier) in growing.items():
                cuts = tuple(np.array(c) for c in zip(*(found[i][node] for node in frontier)))
                growing[i] = tree, _level(tree, frontier, cuts, offsets, trials[i])
        for i, tree in trees.items():
            done[i].append(tree)
        if t + 1 - written >= STATE_TREES:
            state = materialize(state.mapInArrow(advance(not_written()), state.schema), "boosting-state")
            written = t + 1
    return done


def fit(frame: DataFrame, features: list[str], label: str, trials: list[Settings], cell_limit: int = CELL_LIMIT) -> list[Model]:
    """A model for each trial, all over the same bins and cells."""
    binning = find_bins(frame, features)
    known = materialize(cells(frame, binning, label), "cells")
    size = known.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    if not size["cells"]:
        return [Model(binning, None, [], s) for s in trials]
    base = (2 * size["total"] + size["n"]) // (2 * size["n"])
    parts = meeting_parts(frame.sparkSession, size["cells"])
    if parts > 1 and size["cells"] <= cell_limit * parts:
        fitted = _fit_parts(known, binning, base, trials, parts)
    else:
        fitted = (_fit_tasks if size["cells"] <= cell_limit else _fit_spread)(known, binning, base, trials)
    return [Model(binning, base, trees, s) for trees, s in zip(fitted, trials)]


def squared_errors(frame: DataFrame, models: list[Model], label: str) -> DataFrame:
    """(trial, n, sse) of all models from one pass over the rows with a finite label."""
    names = models[0].binning.names
    shared = frame.sparkSession.sparkContext.broadcast([m.plain() for m in models if m.base is not None])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Model.of(m) for m in shared.value]
        for batch in batches:
            labels = np.array(batch.column(len(names)).fill_null(float("nan")))
            kept = np.isfinite(labels)
            bins = known[0].binning.bins(batch)[kept] if known else None
            errors = [float(((m.values(bins) - labels[kept]) ** 2).sum()) for m in known]
            yield pa.RecordBatch.from_pydict({
                "trial": pa.array(range(len(known)), pa.int32()), "n": pa.array([int(kept.sum())] * len(known), pa.int64()),
                "sse": pa.array(errors, pa.float64()),
            })

    rows = frame.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("__label"))
    return rows.mapInArrow(judge, "trial int, n long, sse double").groupBy("trial").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"))
