"""Training, tuning, promotion, synthesis and resampling on the booking table.

Boosted trees and random trials have no SQL twin; they are tested against a plain booster instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates
from tidewheel.operators import bookings as booking_ops
from tidewheel.operators import sampling, synthesis, training
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.session import materialize

def frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Encoded train and test rows out of bookings that are derived and written once."""
    booked = inputs.bookings(spark, sf_dir)
    newest = booking_ops.newest_date(booked)
    if newest is not None:
        bounds = dates.split_bounds(newest)
        booked = booking_ops.between_dates(booked, "arrival_date", bounds["train_start"], bounds["test_end"])
    train, test = booking_ops.time_split(materialize(booked, "bookings"), max_date=newest)
    codes = materialize(booking_ops.category_codes(train, booking_ops.CATEGORICAL), "codes")
    return materialize(training.feature_frame(train, codes), "train-coded"), training.feature_frame(test, codes)


@query("gbt_scores")
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with the prediction of a model fitted on the train window."""
    train, test = frames(spark, sf_dir)
    return training.score(training.train(train), test)


@query("hpo_trials")
def hpo_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random trials fitted on the train window and judged on the test window."""
    train, test = frames(spark, sf_dir)
    return training.tune(train, test, training.random_trials())


@query("promotion_gate")
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model of the train window against that of a month before, on the same test rows."""
    train, test = frames(spark, sf_dir)
    test = materialize(test, "test-coded")
    newest = train.agg(F.max("arrival_date")).first()[0]
    earlier = train.where(F.col("arrival_date") <= F.lit(newest) - F.expr("INTERVAL 1 MONTH"))
    champion = training.metrics(training.train(earlier), test)
    challenger = training.metrics(training.train(train), test)
    return training.promotion(champion, challenger)


@query("synthetic_next_month")
def synthetic_next_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many synthetic bookings as there are real ones, dated into the next month."""
    categorical = ["type_of_meal", "room_type", "market_segment_type"]
    used = [*booking_ops.NUMERIC, booking_ops.TARGET, *categorical, "date_of_reservation"]
    rows = materialize(inputs.bookings(spark, sf_dir).select(*used), "bookings")
    model = synthesis.fit(rows, [*booking_ops.NUMERIC, booking_ops.TARGET], categorical)
    return synthesis.next_month_rows(spark, model, booking_ops.newest_date(rows), rows.count(), booking_ops.NUMERIC)


@query(
    "synthetic_month_checks",
    """SELECT count(*) AS rows, true AS one_month, true AS inside_ranges, true AS known_categories, true AS correlations_near FROM orders""",
)
def synthetic_month_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the synthetic month: rows, dates, ranges, categories, and correlations within 0.15."""
    real, made = inputs.bookings(spark, sf_dir), synthetic_next_month(spark, sf_dir)
    numbers = ["lead_time", booking_ops.TARGET]
    bounds = [f(c).alias(f"{n}_{c}") for c in numbers for n, f in (("low", F.min), ("high", F.max))]
    pairs = [("number_of_adults", booking_ops.TARGET), ("number_of_week_nights", "number_of_weekend_nights")]
    near = [F.corr(a, b).alias(f"corr_{i}") for i, (a, b) in enumerate(pairs)]
    kinds = F.collect_set("market_segment_type").alias("kinds")  # at most CATEGORY_LIMIT
    rows = F.count(F.lit(1)).alias("rows")
    months = [f(F.trunc("date_of_reservation", "MM")).alias(n) for n, f in (("first", F.min), ("last", F.max))]
    a = real.agg(rows, *bounds, *near, kinds, F.max("date_of_reservation").alias("newest"), F.lit(None).cast("date").alias("first"), F.lit(None).cast("date").alias("last"), F.lit(True).alias("real"))
    b = made.agg(rows, *bounds, *near, kinds, F.lit(None).cast("timestamp_ntz").alias("newest"), *months, F.lit(False).alias("real"))
    both = a.unionByName(b)

    def of(column: str, side: bool):
        return F.max(F.when(F.col("real") == side, F.col(column)))

    inside = [(of(f"low_{c}", False) >= of(f"low_{c}", True)) & (of(f"high_{c}", False) <= of(f"high_{c}", True)) for c in numbers]
    close = [F.abs(of(f"corr_{i}", False) - of(f"corr_{i}", True)) < 0.15 for i in range(len(pairs))]
    next_month = F.trunc(F.add_months(of("newest", True).cast("date"), 1), "MM")
    return both.agg(
        of("rows", False).alias("rows"), ((of("first", False) == next_month) & (of("last", False) == next_month)).alias("one_month"),
        (inside[0] & inside[1]).alias("inside_ranges"),
        (F.size(F.array_except(of("kinds", False), of("kinds", True))) == 0).alias("known_categories"),
        (close[0] & close[1]).alias("correlations_near"),
    )


def _draws_sql(source: str, seed: int) -> str:
    digest = f"substr(md5('{seed}:' || CAST(i AS VARCHAR)), 1, 15)"
    number = f"list_reduce(list_transform(string_split({digest}, ''), lambda c: CAST(instr('0123456789abcdef', c) - 1 AS BIGINT)), lambda a, b: a * 16 + b)"
    return f"""SELECT p.* EXCLUDE (place, total) FROM range(2000) r(i)
      JOIN (SELECT *, row_number() OVER (ORDER BY md5("Booking_ID")) AS place, count(*) OVER () AS total FROM {source}) p
      ON p.place = {number} % p.total + 1"""


RESAMPLE_SQL = f"""WITH {inputs.BOOKINGS_SQL},
segment AS (SELECT * FROM bookings WHERE market_segment_type = 'BUILDING')
{_draws_sql('bookings', 2)} UNION ALL {_draws_sql('segment', 1)}"""


@query("resample_with_replacement", RESAMPLE_SQL)
def resample_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples with replacement, one of all rows and one of a segment, concatenated."""
    rows = inputs.bookings(spark, sf_dir)
    key = F.col("Booking_ID")
    segment = sampling.resample(rows.where("market_segment_type = 'BUILDING'"), key, 2000, seed=1)
    whole = sampling.resample(rows, key, 2000, seed=2)
    return whole.unionByName(segment)
