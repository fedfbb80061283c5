"""Regression metrics, profiles per window, drift distances, and the error alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.operators import ranking
from tidewheel.session import materialize

# Thresholds of the alert, and numeric floors.
ERROR_LIMIT = 30.0
ALERT_PERCENT = 45.0
LABEL_FLOOR = 2.220446049250313e-16
SHARE_FLOOR = 1e-6
QUANTILES = [0.25, 0.5, 0.75]
BINS = 10
NULL_BIN = "null"


def regression_aggregates(label: str, prediction: str) -> dict[str, Column]:
    """MAE, MSE, RMSE, R², max error, MAPE and target sums, all in one pass.

    Rows without label or prediction are left out. R² is null when the label is constant.
    """
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label))
    error = y - F.col(prediction)
    n = F.count(y)
    spread = F.var_pop(y) * n
    return {
        "n_labelled": n,
        "mae": F.avg(F.abs(error)),
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.when(spread > 0, 1 - F.sum(error * error) / spread),
        "max_error": F.max(F.abs(error)),
        "mape": F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(LABEL_FLOOR))),
        "target_sum": F.sum(y),
        "target_mean": F.avg(y),
    }


Keys = dict[str, Column]  # group key name → expression; empty for the whole table


def regression_metrics(df: DataFrame, keys: Keys, label: str, prediction: str) -> DataFrame:
    aggregates = [c.alias(name) for name, c in regression_aggregates(label, prediction).items()]
    return df.groupBy(*_aliased(keys)).agg(*aggregates)


def _aliased(keys: Keys) -> list[Column]:
    return [k.alias(name) for name, k in keys.items()]


def window_keys(time_column: str, width: str, *others: str) -> Keys:
    """Tumbling window start, plus further key columns such as the model id."""
    return {"window_start": F.window(time_column, width)["start"], **{c: F.col(c) for c in others}}


SKETCH_SIZE = 4096  # of a KLL sketch: rank errors below 0.1 % of the rows
SALTS = 64


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased frames."""
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def number_counts(df: DataFrame, keys: Keys, columns: list[str]) -> DataFrame:
    """(keys, column_name, value, n): the distinct non-null values of numeric columns with their rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = df.select(*_aliased(keys), F.inline(pairs)).where("value IS NOT NULL")
    return rows.groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, keys: Keys, columns: list[str], quantiles: list[float]) -> DataFrame:
    """(keys, column_name, distinct_count, q array): the smallest value that at least a share q of the rows reaches.

    From value counts: a range-partitioned running sum gives each value the rows below it, so no group,
    the whole table included, is sorted in one task or collected.
    """
    named = [*keys, "column_name"]
    counts = materialize(number_counts(df, keys, columns), "value-counts")
    below = ranking.running_by_key(counts, named, ["value"], {"below": "n"})
    totals = counts.groupBy(*named).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_count"))
    placed = below.alias("b").join(totals.alias("t"), _same("b", "t", named)).select("b.*", "total", "distinct_count")
    picked = []
    for q in quantiles:
        rank = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(q) * F.col("total")))
        picked.append(F.max(F.when((F.col("below") < rank) & (rank <= F.col("below") + F.col("n")), F.col("value"))))
    return placed.groupBy(*named).agg(F.max("distinct_count").alias("distinct_count"), F.array(*picked).alias("q"))


def sketched_quantiles(df: DataFrame, keys: Keys, columns: list[str], quantiles: list[float], size: int = SKETCH_SIZE) -> DataFrame:
    """(keys, column_name, q array) from KLL sketches of a fixed size, merged first by salt and then by group.

    A value's rank is within about 0.1 % of the rows of the rank asked for, at the size given above. Groups have
    at most SALTS sketches to merge in one place, however many tasks saw their rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    parts = salted.groupBy(*_aliased(keys), "_salt").agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"{c}.sketch") for c in columns]
    )
    whole = parts.groupBy(*keys).agg(*[F.kll_merge_agg_double(F.col(f"`{c}.sketch`"), F.lit(size)).alias(c) for c in columns])
    wanted = F.array(*[F.lit(q) for q in quantiles])
    # An empty sketch has no quantile: asked only where it holds rows.
    curves = [
        F.struct(F.lit(c).alias("column_name"), F.when(
            F.kll_sketch_get_n_double(F.col(c)) > 0, F.kll_sketch_get_quantile_double(F.col(c), wanted)
        ).alias("q"))
        for c in columns
    ]
    return whole.select(*keys, F.inline(F.array(*curves)))


def numeric_profile(df: DataFrame, keys: Keys, columns: list[str], exact: bool = True) -> DataFrame:
    """Long profile (keys, column_name, statistics) of numeric columns.

    Exact: quantiles and distinct counts out of value counts. Otherwise from one aggregation with
    sketches of a stated error: KLL for quantiles, HyperLogLog for distinct values.
    """
    named = [*keys, "column_name"]
    aggregates, packed = [F.count(F.lit(1)).alias("row_count")], []
    for c in columns:
        v = F.col(c).cast("double")
        parts = {"null_count": F.count_if(v.isNull()), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        if not exact:
            parts["distinct_count"] = F.approx_count_distinct(v, 0.01)
        aggregates += [part.alias(f"{c}.{p}") for p, part in parts.items()]
        packed.append(F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}.{p}`").alias(p) for p in parts]))
    wide = df.groupBy(*_aliased(keys)).agg(*aggregates)
    long = wide.select(*keys, "row_count", F.inline(F.array(*packed)))
    curves = (exact_quantiles if exact else sketched_quantiles)(df, keys, columns, QUANTILES)
    joined = long.alias("p").join(curves.alias("c"), _same("p", "c", named), "left")
    distinct = F.coalesce(F.col("c.distinct_count"), F.lit(0).cast("long")) if exact else F.col("p.distinct_count")
    return joined.select(
        *[F.col(f"p.{k}").alias(k) for k in keys], "row_count", "p.column_name", "null_count",
        distinct.alias("distinct_count"), "mean", "std", "min", "max",
        *[F.get(F.col("q"), F.lit(i)).alias(name) for i, name in enumerate(["q25", "median", "q75"])],
    )


def value_counts(df: DataFrame, keys: Keys, columns: list[str]) -> DataFrame:
    """(keys, column_name, value, n): the pre-aggregate every categorical statistic starts from."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select(*_aliased(keys), F.inline(pairs))
    return rows.groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, keys: Keys, columns: list[str]) -> DataFrame:
    """Row, null and distinct counts and the most frequent value (ties: smallest value)."""
    counts = value_counts(df, keys, columns)
    return counts.groupBy(*keys, "column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("k"), "value")))["value"].alias("top_value"),
    )


def error_alert(profile: DataFrame, limit: float = ERROR_LIMIT, percent: float = ALERT_PERCENT) -> DataFrame:
    """Share of windows whose MAE is above the limit, among windows with a finite MAE."""
    finite = F.col("mae").isNotNull() & ~F.isnan("mae") & (F.abs("mae") != float("inf"))
    counted = profile.agg(
        F.count_if(finite & (F.col("mae") > limit)).alias("high_windows"),
        F.count_if(finite).alias("finite_windows"),
    )
    share = F.try_divide(F.col("high_windows") * 100.0, F.col("finite_windows"))
    with_share = counted.withColumn("percent_high", share)
    return with_share.withColumn("alert", F.coalesce(F.col("percent_high") > percent, F.lit(False)))


# --- drift ---------------------------------------------------------------------------------


def bin_edges(baseline: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """Nine inner edges per numeric column out of the baseline deciles, plus its min and max.

    A fixed handful of numbers per column, so they travel as literals in the plan.
    """
    steps = [i / BINS for i in range(BINS + 1)]  # the first value reached by no row is the smallest one
    found = exact_quantiles(baseline, {}, columns, steps).collect()
    edges = {r["column_name"]: r["q"] for r in found}
    return {c: edges.get(c) for c in columns}


def bin_label(value: Column, edges: list[float]) -> Column:
    """Bin 0..9 as text: the number of inner edges below the value; null is its own bin."""
    below = sum((F.when(value > F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when(value.isNull(), F.lit(NULL_BIN)).otherwise(below.cast("string"))


def binned_counts(df: DataFrame, keys: Keys, edges: dict[str, list[float]], categorical: list[str]) -> DataFrame:
    """(keys, column_name, counts map bin → n) with one aggregation of map-side partials."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), bin_label(F.col(c).cast("double"), e).alias("bin"))
        for c, e in edges.items()
    ] + [
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit(NULL_BIN)).alias("bin"))
        for c in categorical
    ]
    rows = df.select(*_aliased(keys), F.inline(F.array(*pairs)))
    named = [*keys, "column_name"]
    counts = rows.groupBy(*named, "bin").agg(F.count(F.lit(1)).alias("n"))
    # One entry per bin: ten for numbers, the vocabulary for categories.
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("bin", "n"))))
    return counts.groupBy(*named).agg(entries.alias("counts"), F.sum("n").alias("total"))


def _share(counts: Column, total: Column, label: Column) -> Column:
    return F.coalesce(F.try_element_at(counts, label), F.lit(0)) / total


def drift_measures(edges: dict[str, list[float]]) -> dict[str, Column]:
    """Distances between counts/total (current) and base_counts/base_total, per row.

    PSI, Jensen-Shannon and chi-square use shares floored at a small value. KS and Wasserstein
    need ordered bins, so they are null for categories.
    """
    bins = F.array_sort(F.array_union(F.map_keys("counts"), F.map_keys("base_counts")))
    pairs = F.transform(
        bins,
        lambda b: F.struct(
            _share(F.col("counts"), F.col("total"), b).alias("p"),
            _share(F.col("base_counts"), F.col("base_total"), b).alias("q"),
        ),
    )
    floor = F.lit(SHARE_FLOOR)

    def total_of(term) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + term(x))

    def floored(x: Column) -> tuple[Column, Column]:
        return F.greatest(x["p"], floor), F.greatest(x["q"], floor)

    def psi(x: Column) -> Column:
        p, q = floored(x)
        return (p - q) * F.log(p / q)

    def js(x: Column) -> Column:
        p, q = floored(x)
        m = (p + q) / 2
        return p * F.log(p / m) / 2 + q * F.log(q / m) / 2

    def chi(x: Column) -> Column:
        expected = floored(x)[1] * F.col("total")
        observed = x["p"] * F.col("total")
        return (observed - expected) * (observed - expected) / expected

    # Ordered numeric bins: running difference of the cumulated shares over bins 0..9.
    gaps = [
        _share(F.col("counts"), F.col("total"), F.lit(str(i)))
        - _share(F.col("base_counts"), F.col("base_total"), F.lit(str(i)))
        for i in range(BINS)
    ]
    difference = F.array(*gaps)
    cumulated = F.transform(
        F.sequence(F.lit(1), F.lit(BINS)),
        lambda i: F.abs(F.aggregate(F.slice(difference, F.lit(1), i), F.lit(0.0), lambda a, x: a + x)),
    )
    ks = widths = None
    for c, e in edges.items():
        spans = F.array(*[F.lit(float(e[i + 1] - e[i])) for i in range(BINS)])
        is_c = F.col("column_name") == c
        distance = F.aggregate(
            F.zip_with(cumulated, spans, lambda d, w: d * w), F.lit(0.0), lambda a, x: a + x
        )
        ks = F.when(is_c, F.array_max(cumulated)) if ks is None else ks.when(is_c, F.array_max(cumulated))
        widths = F.when(is_c, distance) if widths is None else widths.when(is_c, distance)
    null_share = _share(F.col("counts"), F.col("total"), F.lit(NULL_BIN))
    base_null = _share(F.col("base_counts"), F.col("base_total"), F.lit(NULL_BIN))
    return {
        "psi": total_of(psi),
        "total_variation": total_of(lambda x: F.abs(x["p"] - x["q"])) / 2,
        "js_divergence": total_of(js),
        "chi_square": total_of(chi),
        "ks": ks if ks is not None else F.lit(None).cast("double"),
        "wasserstein": widths if widths is not None else F.lit(None).cast("double"),
        "null_rate_delta": null_share - base_null,
    }


def drift_vs_baseline(
    current: DataFrame, keys: Keys, baseline: DataFrame, numeric: list[str], categorical: list[str]
) -> DataFrame:
    """Drift of each window and column against the baseline table."""
    edges = bin_edges(baseline, numeric)
    now = binned_counts(current, keys, edges, categorical)
    base = binned_counts(baseline, {}, edges, categorical).select(
        "column_name", F.col("counts").alias("base_counts"), F.col("total").alias("base_total")
    )
    joined = now.join(base, "column_name")
    measures = [m.alias(name) for name, m in drift_measures(edges).items()]
    return joined.select(*keys, "column_name", "total", *measures)


def drift_vs_previous(
    current: DataFrame, keys: Keys, order: str, edges: dict[str, list[float]], categorical: list[str]
) -> DataFrame:
    """Drift of each window against the one before it. The lag runs over window totals only."""
    now = binned_counts(current, keys, edges, categorical)
    others = [c for c in keys if c != order]
    before = Window.partitionBy("column_name", *others).orderBy(order)
    lagged = now.withColumns({
        "base_counts": F.lag("counts").over(before), "base_total": F.lag("total").over(before),
    }).where("base_counts IS NOT NULL")
    measures = [m.alias(name) for name, m in drift_measures(edges).items()]
    return lagged.select(*keys, "column_name", "total", *measures)


def exact_distances(current: DataFrame, keys: Keys, baseline: DataFrame, columns: list[str]) -> DataFrame:
    """KS and Wasserstein distance between the whole distributions of each window and of the baseline.

    (keys, column_name, total, ks, wasserstein); columns without values on either side have no row.

    The baseline's distribution function, and its integral, are running sums over its sorted values, looked up at
    the values of all windows in one range-partitioned pass. Between two values of a window its own function is
    constant, so the area to the baseline follows from the integral at both ends and, where the two cross, at the
    baseline's quantile in between, found by rank in a second pass. Work grows with the distinct values of both
    sides, never with windows times values, and nothing is binned or collected.
    """
    named = [*keys, "column_name"]
    base = materialize(number_counts(baseline, {}, columns), "baseline-counts")
    base_totals = base.groupBy("column_name").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("value")).alias("mass"))
    now = number_counts(current, keys, columns).join(base_totals.select("column_name"), "column_name", "left_semi")
    now = materialize(now, "current-counts")
    totals = now.groupBy(*named).agg(F.sum("n").alias("total")).join(base_totals, "column_name")

    # The baseline at every value: rows below it and what they sum to.
    zero = F.lit(0).cast("long")
    points = now.select("column_name", "value", zero.alias("here")).unionByName(base.select("column_name", "value", F.col("n").alias("here")))
    merged = points.groupBy("column_name", "value").agg(F.sum("here").alias("here"))
    merged = merged.withColumn("weight", F.col("here") * F.col("value"))
    known = materialize(ranking.running_by_key(merged, ["column_name"], ["value"], {"below": "here", "mass_below": "weight"}), "baseline-at")
    point = F.struct("value", "below", "here", (F.col("below") * F.col("value") - F.col("mass_below")).alias("area"))  # area times m
    looked = now.join(known, ["column_name", "value"]).select(*named, "n", point.alias("point"))
    running = ranking.running_by_key(looked, named, ["point"], {"k": "n"}, previous="left")
    gaps = materialize(running.alias("r").join(totals.alias("t"), _same("r", "t", named)).select("r.*", "total", "m", "mass"), "gaps")

    # Where the two functions cross between two values: the baseline's value of that rank.
    share, m = F.col("k") / F.col("total"), F.col("m")
    left_share, right_share = (F.col("left.below") + F.col("left.here")) / m, F.col("point.below") / m
    crosses = F.coalesce((left_share < share) & (right_share > share), F.lit(False))
    rank = F.ceil(share * m).cast("long")
    targets = gaps.where(crosses).select("column_name", rank.alias("rank")).distinct()
    steps = known.where("here > 0").select(
        "column_name", (F.col("below") + F.col("here")).alias("rank"), F.lit(1).alias("is_base"), F.col("value").alias("x"),
        (F.col("below") * F.col("value") - F.col("mass_below")).alias("x_area"),
    )
    nothing = F.lit(None).cast("double")
    ranked = targets.select("column_name", "rank", F.lit(0).alias("is_base"), nothing.alias("x"), nothing.alias("x_area")).unionByName(steps)
    placed = materialize(ranking.running_by_key(ranked, ["column_name"], ["rank", "is_base"], {"j": "is_base"}), "ranks")
    found = placed.where("is_base = 0").select("column_name", "rank", "j").join(
        placed.where("is_base = 1").select("column_name", "j", "x", "x_area"), ["column_name", "j"]
    )
    crossing = gaps.withColumn("rank", F.when(crosses, rank)).join(found.drop("j"), ["column_name", "rank"], "left")

    value, area, left, left_area = F.col("point.value"), F.col("point.area") / m, F.col("left.value"), F.col("left.area") / m
    x, x_area = F.col("x"), F.col("x_area") / m
    straight = F.abs(share * (value - left) - (area - left_area))
    crossed = share * (x - left) - (x_area - left_area) + (area - x_area) - share * (value - x)
    inner = F.when(left.isNull(), area).otherwise(F.when(x.isNull(), straight).otherwise(crossed))
    is_last = F.col("k") + F.col("n") == F.col("total")
    tail = F.when(is_last, F.col("mass") / m - value + area).otherwise(0.0)
    below = F.abs(share - F.col("point.below") / m)
    up_to = F.abs((F.col("k") + F.col("n")) / F.col("total") - (F.col("point.below") + F.col("point.here")) / m)
    return crossing.groupBy(*named).agg(
        F.max("total").alias("total"), F.max(F.greatest(below, up_to)).alias("ks"),
        F.sum(F.greatest(inner, F.lit(0.0)) + F.greatest(tail, F.lit(0.0))).alias("wasserstein"),
    )
