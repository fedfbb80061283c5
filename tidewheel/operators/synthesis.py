"""Synthetic rows from a Gaussian copula over numeric and categorical columns.

Whether a number is missing is a margin of its own, correlated with the others; a missing category is a category.
Correlations of normal scores come from the rows in which both columns have one, all pairs in one
aggregation, and the nearest correlation matrix is taken where they do not fit together.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import dates

GRID = 100
CLIP = 3.5
CATEGORY_LIMIT = 10_000
MISSING = "{}__missing"


def _z(p: float) -> float:
    if p <= 0:
        return -CLIP
    if p >= 1:
        return CLIP
    return max(-CLIP, min(CLIP, NormalDist().inv_cdf(p)))


def _at(z: Column, values: list[float]) -> Column:
    """Value at a normal score, linear between grid points that are evenly spaced in z."""
    grid = F.array(*[F.lit(float(v)) for v in values])
    step = 2 * CLIP / GRID
    place = (F.greatest(F.least(z, F.lit(CLIP)), F.lit(-CLIP)) + CLIP) / step
    left = F.least(F.floor(place), F.lit(GRID - 1)).cast("int")
    low, high = F.get(grid, left), F.get(grid, left + 1)
    return low + (place - left) * (high - low)


def _moments(df: DataFrame, curves: dict[str, tuple[list[float], list[float]]], scores: list[Column]) -> np.ndarray:
    """(4, k, k) of the normal scores of k columns: over the rows that have both of a pair, their number, sums of the first
    column, of its squares, and of products. Numbers are mapped along their quantile curves, `scores` come as they are.

    Tasks hand on one row each; scores lie within CLIP, so plain sums keep their digits.
    """
    points = list(curves.values())
    numbers = [F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(curves)]
    width = len(numbers) + len(scores)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, width, width))
        for batch in batches:
            columns = [np.array(c.fill_null(float("nan")), dtype=np.float64) for c in batch.columns]
            z = np.column_stack([np.interp(c, *points[i]) if i < len(points) else c for i, c in enumerate(columns)])
            has = (~np.isnan(z)).astype(np.float64)
            z = np.where(has > 0, z, 0.0)
            sums += np.stack([has.T @ has, z.T @ has, (z * z).T @ has, z.T @ z])
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()])], names=["sums"])

    parts = df.select(*numbers, *scores).mapInArrow(add_up, "sums array<double>").collect()  # a row for each task
    return np.sum([r["sums"] for r in parts], axis=0).reshape(4, width, width)


def _categories(df: DataFrame, value: Column, name: str) -> tuple[dict, Column]:
    """Labels with the upper ends of their stretches of the normal, null last, and each row's score."""
    counts = df.groupBy(value.cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.orderBy(F.col("v").asc_nulls_last()).limit(CATEGORY_LIMIT + 2).collect()
    if len(found) > CATEGORY_LIMIT + 1:
        raise ValueError(f"{name} is no category: more than {CATEGORY_LIMIT} values")
    shares = np.array([r["n"] for r in found], dtype=float)
    upper = np.cumsum(shares / shares.sum())
    lower = np.concatenate([[0.0], upper[:-1]])
    middles = {r["v"]: _z((a + b) / 2) for r, a, b in zip(found, lower, upper)}
    nothing = middles.pop(None, 0.0)
    lookup = F.create_map(*[x for v, z in middles.items() for x in (F.lit(v), F.lit(z))]) if middles else None
    score = F.coalesce(F.try_element_at(lookup, value.cast("string")), F.lit(nothing)) if middles else F.lit(nothing)
    return {"labels": [r["v"] for r in found], "upper_z": [_z(u) for u in upper]}, score


def _correlations(sums: np.ndarray) -> np.ndarray:
    """Each pair's, of the rows that have both; 0 where there are none or one of the two is constant there."""
    n = np.maximum(sums[0], 1.0)
    mean = sums[1] / n
    spread = np.maximum(sums[2] / n - mean**2, 0.0)
    product = np.sqrt(spread * spread.T)
    moves = (spread > 1e-12) & (spread.T > 1e-12)
    found = np.divide(sums[3] / n - mean * mean.T, product, out=np.zeros_like(mean), where=moves)
    np.fill_diagonal(found, 1.0)
    return found


def _nearest_correlation(matrix: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Alternating projections on matrices without negative directions and on those with a diagonal of 1."""
    near, correction = matrix.copy(), np.zeros_like(matrix)
    for _ in range(rounds):
        values, vectors = np.linalg.eigh(near - correction)
        raised = vectors @ np.diag(np.maximum(values, 1e-9)) @ vectors.T
        correction = raised - (near - correction)
        before, near = near, raised.copy()
        np.fill_diagonal(near, 1.0)
        if np.abs(near - before).max() < 1e-10:
            break
    values, vectors = np.linalg.eigh(near)
    fixed = vectors @ np.diag(np.maximum(values, 1e-9)) @ vectors.T
    scale = np.sqrt(np.diag(fixed))
    return fixed / np.outer(scale, scale)


def fit(df: DataFrame, numeric: list[str], categorical: list[str]) -> dict:
    """Marginals (quantile grids, category shares) and the correlation of normal scores.

    What reaches the driver is one grid per column, one share per category and a k × k matrix. A number that is
    null in every row is null in every synthetic one. df is read once for the curves, once for each category and once
    for the correlations: hand in written rows.
    """
    z_grid = [-CLIP + 2 * CLIP * i / GRID for i in range(GRID + 1)]
    steps = [0.0, *[NormalDist().cdf(z) for z in z_grid[1:-1]], 1.0]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.percentile_approx(F.col(c).cast("double"), steps, 100_000).alias(c) for c in numeric],
        *[F.count(F.col(c).cast("double")).alias(MISSING.format(c)) for c in numeric],
    ).first()
    if not row["_rows"]:
        raise ValueError("no rows to fit")
    known = [c for c in numeric if row[c] is not None]
    gappy = [c for c in numeric if 0 < row[MISSING.format(c)] < row["_rows"]]
    model: dict = {
        "numeric": {c: row[c] for c in known}, "never": [c for c in numeric if row[c] is None], "categorical": {},
        "gappy": gappy, "columns": [*known, *categorical, *[MISSING.format(c) for c in gappy]], "order": [*numeric, *categorical],
    }
    curves = {}
    for c in known:
        # A value repeated over many quantiles maps to the middle of its stretch.
        values, zs = np.array(row[c], dtype=float), np.array(z_grid)
        found = np.unique(values)
        curves[c] = (found.tolist(), [float(zs[values == v].mean()) for v in found])
    scores = []
    for c, value in [*[(c, F.col(c)) for c in categorical], *[(MISSING.format(c), F.col(c).isNull()) for c in gappy]]:
        model["categorical"][c], score = _categories(df, value, c)
        scores.append(score.alias(c))
    matrix = _correlations(_moments(df, curves, scores)) if model["columns"] else np.eye(0)
    model["factor"] = np.linalg.cholesky(_nearest_correlation(matrix))
    return model


def sample(spark, model: dict, n: int, seed: int = 42) -> DataFrame:
    """n synthetic rows: correlated normals, mapped back through each marginal."""
    columns, factor = model["columns"], model["factor"]
    noise = spark.range(n).select("id", *[F.randn(seed + i).alias(f"_e{i}") for i in range(len(columns))])
    mixed = noise.select("id", *[
        sum((F.lit(float(factor[i, j])) * F.col(f"_e{j}") for j in range(i + 1)), F.lit(0.0)).alias(f"_z{i}")
        for i in range(len(columns))
    ])
    out = []
    for i, c in enumerate(columns):
        z = F.col(f"_z{i}")
        if c in model["numeric"]:
            out.append(_at(z, model["numeric"][c]).alias(c))
        else:
            known = model["categorical"][c]
            edges = F.array(*[F.lit(float(u)) for u in known["upper_z"][:-1]])
            place = F.size(F.filter(edges, lambda e: e < z))
            out.append(F.get(F.array(*[F.lit(v).cast("string") for v in known["labels"]]), place).alias(c))
    rows = mixed.select("id", *out)
    for c in model["gappy"]:
        rows = rows.withColumn(c, F.when(F.col(MISSING.format(c)) == "false", F.col(c)))
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in model["never"]})
    return rows.select("id", *model["order"])


def next_month_rows(spark, model: dict, newest, n: int, integers: list[str], seed: int = 42) -> DataFrame:
    """Synthetic bookings dated at random days of the month after the newest date."""
    start = dates.next_month_start(F.lit(str(newest)).cast("date"))
    rows = sample(spark, model, n, seed).withColumns({c: F.round(c).cast("int") for c in integers})
    dated = rows.withColumn("date_of_reservation", dates.random_day_of_month(start, seed + 1000).cast("timestamp_ntz"))
    arrival = dates.add_days(F.col("date_of_reservation"), F.col("lead_time"))
    return dated.withColumn("arrival_date", arrival).withColumn("arrival_month", F.month("arrival_date"))
