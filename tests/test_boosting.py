"""Boosted trees against a plain booster, and both ways of fitting against each other."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tidewheel.operators import boosting, training

NAMES = ["a", "b", "c"]


def table(spark, rows):
    return spark.createDataFrame(rows, "a double, b int, c double, y double, prediction_note string")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    out = []
    for _ in range(900):
        a, b, c = r.choice([None, -1.5, 0.0, 2.0, 7.0]), r.randrange(12), r.choice([math.nan, 1.0, 3.0])
        y = 10 * (a or 0) + (b % 5) ** 2 + (5 if c == 3.0 else 0) + r.gauss(0, 3)
        out.append((a, b, c, y, "x"))
    out += [out[0]] * 40 + [(1.0, 3, None, None, "no label"), (1.0, 3, 1.0, math.inf, "no label")]
    return out


def rank(values):
    """Values as their places in order, null and NaN first."""
    missing = lambda v: v is None or v != v
    known = sorted({v for v in values if not missing(v)})
    first = int(any(missing(v) for v in values))
    return [0 if missing(v) else first + known.index(v) for v in values]


def plain_booster(rows, trees, rate, depth, min_rows):
    """Row by row: the same rule in plain Python, labels as fixed-point integers."""
    rows = [r for r in rows if r[3] is not None and math.isfinite(r[3])]
    x = list(zip(*(rank([r[i] for r in rows]) for i in range(3))))
    y = [int(np.rint(r[3] * boosting.SCALE)) for r in rows]
    base = (2 * sum(y) + len(y)) // (2 * len(y))
    pred = [base] * len(rows)

    def grow(members, level):
        total, n = sum(y[i] - pred[i] for i in members), len(members)
        value = int(np.rint(rate * (float(total) / n)))
        best = None
        if level < depth and n >= 2 * min_rows or level == 0:
            for f in range(3):
                for cut in range(max(x[i][f] for i in range(len(x)))):
                    left = [i for i in members if x[i][f] <= cut]
                    if min_rows <= len(left) <= n - min_rows:
                        g = sum(y[i] - pred[i] for i in left)
                        gain = float(g) ** 2 / len(left) + float(total - g) ** 2 / (n - len(left)) - float(total) ** 2 / n
                        if gain > 1e-9 * max(float(total) ** 2 / n, 1.0) and (best is None or gain > best[0]):
                            best = gain, f, cut
        if best is None:
            return {i: value for i in members}
        _, f, cut = best
        sides = [i for i in members if x[i][f] <= cut], [i for i in members if x[i][f] > cut]
        return grow(sides[0], level + 1) | grow(sides[1], level + 1)

    for _ in range(trees):
        step = grow(list(range(len(rows))), 0)
        pred = [p + step[i] for i, p in enumerate(pred)]
    return sorted((str(r[:3]), p / boosting.SCALE) for r, p in zip(rows, pred))


TRIALS = [boosting.Settings(13, 0.3, 2, 20), boosting.Settings(4, 0.5, 4, 5), boosting.Settings(1, 1.0, 1, 400)]


def fitted(frame, models):
    known = frame.where("y is not null and y < double('infinity')")
    return [sorted((str(tuple(r)[:3]), r.prediction) for r in m.transform(known).collect()) for m in models]


@pytest.mark.parametrize("partitions", [1, 5])
def test_equals_a_plain_booster(spark, rows, partitions):
    frame = table(spark, rows).repartition(partitions)
    models = boosting.fit(frame, NAMES, "y", TRIALS)
    want = [plain_booster(rows, s.n_estimators, s.learning_rate, s.max_depth, s.min_rows) for s in TRIALS]
    assert fitted(frame, models) == want


def test_spread_cells_give_the_same_trees(spark, rows):
    frame = table(spark, rows).repartition(4)
    near = boosting.fit(frame, NAMES, "y", TRIALS)
    far = boosting.fit(frame, NAMES, "y", TRIALS, cell_limit=0)
    assert [[t.plain() for t in m.trees] for m in far] == [[t.plain() for t in m.trees] for m in near]


def test_tasks_that_meet_give_the_same_trees(spark, rows, monkeypatch):
    """One barrier stage grows all trials over parts of the cells: no copy of all cells, no task with a whole trial."""
    frame = table(spark, rows).repartition(4)
    near = boosting.fit(frame, NAMES, "y", TRIALS)

    def alone(*_):
        raise AssertionError("a task with all cells")

    monkeypatch.setattr(boosting, "_fit_tasks", alone)
    monkeypatch.setattr(boosting, "_fit_spread", alone)
    monkeypatch.setattr(boosting, "PART_CELLS", 20)
    far = boosting.fit(frame, NAMES, "y", TRIALS)
    assert [[t.plain() for t in m.trees] for m in far] == [[t.plain() for t in m.trees] for m in near]


def test_half_a_million_cells_are_shared_by_tasks(spark, monkeypatch):
    frame = spark.range(600_000).selectExpr("id % 200 as a", "int(id / 200) % 200 as b", "int(id / 40000) as c", "double(id % 7) as y")

    def alone(*_):
        raise AssertionError("a trial in one task")

    monkeypatch.setattr(boosting, "_fit_tasks", alone)
    model = boosting.fit(frame, NAMES, "y", [boosting.Settings(2, 0.5, 3)])[0]
    assert [len(t.feature) > 1 for t in model.trees] == [True, True]


def test_sums_beyond_doubles_are_exact():
    """A part counts rows and gradients of its nodes exactly, with few places and with many."""
    rng = np.random.default_rng(6)
    widths = [3, 200, 2, 12, 40, 1]
    offsets = np.append(0, np.cumsum(widths))
    bins = np.stack([rng.integers(0, w, 70_000) for w in widths], axis=1).astype(np.uint8)
    n, totals = rng.integers(1, 9, 70_000), rng.integers(-(1 << 57), 1 << 57, 70_000) >> 10
    for sums in (totals, totals >> 30):
        part = boosting._Part(bins, n, sums, offsets, 3, 1)
        left, columns = part.left[0], part.columns
        for nodes in ([np.arange(70_000)], list(rng.permutation(70_000)[:900].reshape(90, 10)), [np.zeros(0, np.int64)]):
            found = part.histograms(nodes, boosting.whole_weights(left))
            for node, counted in zip(nodes, found):
                for f, width in enumerate(widths):
                    for value in range(width):
                        at = node[columns[f][node] == value]
                        assert counted[:, offsets[f] + value].tolist() == [part.n[at].sum(), left[at].sum()]


def test_errors_of_all_models_in_one_pass(spark, rows):
    frame = table(spark, rows)
    models = boosting.fit(frame, NAMES, "y", TRIALS)
    errors = {r.trial: (r.n, r.sse) for r in boosting.squared_errors(frame, models, "y").collect()}
    for i, m in enumerate(models):
        known = m.transform(frame.where("y is not null and y < double('infinity')")).collect()
        assert errors[i][0] == len(known)
        assert errors[i][1] == pytest.approx(sum((r.y - r.prediction) ** 2 for r in known))


def test_levels_keep_order_and_small_integers():
    values = sorted([*range(-512, 513), 1e300, -1e300, 0.5, 1e-300, -1e-300, 70000.0])
    levels = boosting.levels(pa.array([*values, None, math.nan, -0.0]))
    assert (np.diff(levels[: len(values)]) >= 0).all() and levels[-3] == levels[-2] < levels[0]
    assert len(set(boosting.levels(pa.array([float(i) for i in range(513)])).tolist())) == 513
    assert levels[-1] == boosting.levels(pa.array([0.0]))[0]


def test_many_values_share_bins_of_like_weight(spark):
    frame = spark.range(20000).selectExpr("double(id) * id as a", "id % 3 as b", "double(id) as y")
    binning = boosting.find_bins(frame, ["a", "b"])
    assert len(binning.cuts[1]) == 2 and 100 < len(binning.cuts[0]) < boosting.BINS
    counted = {}
    for r in boosting.cells(frame, binning, "y").collect():
        counted[r.bins[0]] = counted.get(r.bins[0], 0) + r.n
    assert sum(counted.values()) == 20000 and max(counted.values()) < 20000 / 40


def test_no_rows_and_no_labels(spark, rows):
    frame = table(spark, rows)
    for nothing in (frame.limit(0), frame.where("y is null")):
        model = boosting.fit(nothing, NAMES, "y", TRIALS[:1])[0]
        assert {r.prediction for r in model.transform(frame).collect()} == {None}


def test_tuning_is_judged_by_time(spark, sf_dir):
    """The later rows decide: with other later rows the same trials come out in another order."""
    from tidewheel.operators import bookings
    from tidewheel.plans import inputs

    known = inputs.bookings(spark, sf_dir)
    coded = training.feature_frame(known, bookings.category_codes(known, bookings.CATEGORICAL)).cache()
    trials = [{"n_estimators": 1, "learning_rate": 0.01, "max_depth": 3}, {"n_estimators": 60, "learning_rate": 0.1, "max_depth": 5}]
    same = training.tune(coded, coded, trials).collect()
    assert [r.trial for r in same] == [1, 0] and same[0].rmse < same[1].rmse
    turned = coded.withColumn(bookings.TARGET, -coded[bookings.TARGET])
    assert [r.trial for r in training.tune(coded, turned, trials).collect()] == [0, 1]
    assert [r.rmse for r in training.tune(coded, coded.limit(0), trials).collect()] == [None, None]


def test_a_million_cells_need_no_job_for_each_level(spark, monkeypatch):
    frame = spark.range(1_100_000).selectExpr("id % 200 as a", "int(id / 200) % 200 as b", "int(id / 40000) as c", "double(id % 7) as y")

    def spread(*_):
        raise AssertionError("a job for each level of each tree")

    monkeypatch.setattr(boosting, "_fit_spread", spread)
    model = boosting.fit(frame, NAMES, "y", [boosting.Settings(2, 0.5, 3)])[0]
    assert [len(t.feature) > 1 for t in model.trees] == [True, True]


def test_features_counted_together_have_their_own_sums():
    rng = np.random.default_rng(5)
    widths = [3, 200, 2, 12, 40, 1]
    offsets = np.append(0, np.cumsum(widths))
    bins = np.stack([rng.integers(0, w, 3000) for w in widths], axis=1).astype(np.uint8)
    node, n, gradient = rng.integers(-1, 4, 3000), rng.integers(1, 9, 3000), rng.integers(-(1 << 58), 1 << 58, 3000) >> 3
    joint = boosting.joint_columns(bins, offsets)
    assert sorted(f for features, _, _ in joint for f in features) == list(range(6)) and len(joint) == 3
    for sums in (gradient, gradient >> 40):
        found = boosting.histograms(joint, node, n, sums, 4, offsets)
        for place in range(4):
            for f, width in enumerate(widths):
                for value in range(width):
                    at = (node == place) & (bins[:, f] == value)
                    assert found[place, :, offsets[f] + value].tolist() == [n[at].sum(), sums[at].sum()]
