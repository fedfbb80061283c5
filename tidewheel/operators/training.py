"""Distributed training, scoring, tuning, promotion, and A/B scoring of booking prices."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import routing
from tidewheel.operators import boosting, bookings, quality

# Model parameters, and the search space of the tuning job.
DEFAULT_PARAMETERS = {"learning_rate": 0.05, "n_estimators": 200, "max_depth": 3}
SEARCH_SPACE = {"n_estimators": (50, 700, 50), "learning_rate": (0.01, 0.2), "max_depth": (3, 5, 10, 15)}
TRIALS = 5
SEED = 42
CODE_SUFFIX = "_code"


def feature_frame(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with integer codes for every category; an unknown one is 0."""
    coded = bookings.encode(rows, codes, bookings.CATEGORICAL, CODE_SUFFIX)
    shifted = {f"{c}{CODE_SUFFIX}": F.col(f"{c}{CODE_SUFFIX}") + 1 for c in bookings.CATEGORICAL}
    return coded.withColumns(shifted)


FEATURES = [*bookings.NUMERIC, *[f"{c}{CODE_SUFFIX}" for c in bookings.CATEGORICAL]]


def train(frame: DataFrame, parameters: dict | None = None) -> boosting.Model:
    """Boosted trees over an encoded frame."""
    settings = boosting.Settings(**{**DEFAULT_PARAMETERS, **(parameters or {})})
    return boosting.fit(frame, FEATURES, bookings.TARGET, [settings])[0]


def score(model: boosting.Model, frame: DataFrame, key: str = "Booking_ID") -> DataFrame:
    """Keyed prediction table."""
    return model.transform(frame).select(key, *bookings.NUMERIC, *bookings.CATEGORICAL, bookings.TARGET, "prediction")


def metrics(model: boosting.Model, frame: DataFrame) -> DataFrame:
    return quality.regression_metrics(model.transform(frame), {}, bookings.TARGET, "prediction")


def random_trials(space: dict | None = None, trials: int = TRIALS, seed: int = SEED) -> list[dict]:
    """Random settings: trees on a step grid, rate log-uniform, depth from a list."""
    import math

    space = {**SEARCH_SPACE, **(space or {})}
    rng = random.Random(seed)
    low, high, step = space["n_estimators"]
    bottom, top = space["learning_rate"]
    return [
        {
            "n_estimators": rng.randrange(low, high + 1, step),
            "learning_rate": math.exp(rng.uniform(math.log(bottom), math.log(top))),
            "max_depth": rng.choice(list(space["max_depth"])),
        }
        for _ in range(trials)
    ]


def tune(train_rows: DataFrame, later_rows: DataFrame, trials: list[dict]) -> DataFrame:
    """Trial table (trial, settings, rmse), best first: fitted on one side of a time split, judged on the other.

    All trials are fitted over the same bins and cells, and judged in one pass over the later rows.
    Without later rows that have a label, rmse is null.
    """
    models = boosting.fit(train_rows, FEATURES, bookings.TARGET, [boosting.Settings(**t) for t in trials])
    errors = boosting.squared_errors(later_rows, models, bookings.TARGET)
    rows = [(i, t["n_estimators"], t["learning_rate"], t["max_depth"]) for i, t in enumerate(trials)]
    settings = train_rows.sparkSession.createDataFrame(
        rows, "trial int, n_estimators int, learning_rate double, max_depth int"
    )
    judged = errors.select("trial", F.sqrt(F.col("sse") / F.nullif("n", F.lit(0))).alias("rmse"))
    return settings.join(judged, "trial", "left").orderBy(F.col("rmse").asc_nulls_last(), "trial")


def promotion(champion: DataFrame | None, challenger: DataFrame) -> DataFrame:
    """Decision row: register only when the new RMSE is strictly lower; a first model always.

    Both inputs are one-row metric tables of the same test set.
    """
    nothing = F.lit(None).cast("double")
    rows = challenger.select(F.col("rmse").alias("new_rmse"), nothing.alias("old_rmse"))
    if champion is not None:
        rows = rows.unionByName(champion.select(nothing.alias("new_rmse"), F.col("rmse").alias("old_rmse")))
    both = rows.agg(F.max("new_rmse").alias("new_rmse"), F.max("old_rmse").alias("old_rmse"))
    better = F.col("old_rmse").isNull() | (F.col("new_rmse") < F.col("old_rmse"))
    return both.withColumn("register", F.col("new_rmse").isNotNull() & F.coalesce(better, F.lit(False)))


def ab_score(frame: DataFrame, key: str, models: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Every row scored by the model of its variant, price adjusted, variant kept."""
    routed = frame.withColumn("variant", routing.ab_variant(F.col(key)))
    parts = [model(routed.where(F.col("variant") == name)) for name, model in models.items()]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored.withColumn("price", routing.adjust_price(F.col("prediction")))


def ab_outcome(scored: DataFrame, label: str) -> DataFrame:
    """Rows, mean price and error metrics per variant."""
    aggregates = quality.regression_aggregates(label, "price")
    return scored.groupBy("variant").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("price").alias("mean_price"),
        *[aggregates[m].alias(m) for m in ("mae", "rmse", "max_error")],
    )


