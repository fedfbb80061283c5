"""Booking table: cleaning, time-based split, category codes, feature lookup."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import dates, text

# Column roles of the booking contract.
NUMERIC = [
    "number_of_adults", "number_of_children", "number_of_weekend_nights", "number_of_week_nights",
    "car_parking_space", "special_requests", "lead_time",
]
CATEGORICAL = ["type_of_meal", "room_type", "arrival_month", "market_segment_type"]
TARGET = "average_price"
UNKNOWN_CODE = -1


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: text.column_name(c) for c in df.columns})


def with_arrival(df: DataFrame) -> DataFrame:
    """Arrival date and month out of reservation date and lead time."""
    arrival = dates.add_days(F.col("date_of_reservation"), F.col("lead_time"))
    return df.withColumn("arrival_date", arrival).withColumn("arrival_month", F.month("arrival_date"))


def clean(df: DataFrame) -> DataFrame:
    """Raw rows to the clean table; an unreadable reservation date raises."""
    parsed = dates.parse_date(F.col("date_of_reservation"), strict=True)
    return with_arrival(rename_columns(df).withColumn("date_of_reservation", parsed))


def clean_or_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and the rows whose reservation date cannot be read."""
    named = rename_columns(df)
    parsed = named.withColumn("_date", dates.parse_date(F.col("date_of_reservation"), strict=False))
    good = parsed.where("_date IS NOT NULL").drop("date_of_reservation")
    bad = parsed.where("_date IS NULL").drop("_date")
    return with_arrival(good.withColumnRenamed("_date", "date_of_reservation")), bad


def newest_date(df: DataFrame, column: str = "date_of_reservation") -> date | None:
    newest = df.agg(F.max(column).alias("d")).first()["d"]
    return newest.date() if hasattr(newest, "date") else newest


def between_dates(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Rows of whole days start..end, both included, written so that the scan can prune."""
    low = F.lit(str(start)).cast("timestamp_ntz")
    high = F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz")
    value = F.col(column)
    if dict(df.dtypes)[column] == "timestamp":
        low, high = low.cast("timestamp"), high.cast("timestamp")
    return df.where((value >= low) & (value < high))


def time_split(
    df: DataFrame, test_months: int = 1, train_months: int = 12, max_date: date | None = None,
    filter_column: str = "arrival_date",
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows around the newest reservation month."""
    newest = max_date or newest_date(df)
    if newest is None:
        return df.limit(0), df.limit(0)
    b = dates.split_bounds(newest, test_months, train_months)
    train = between_dates(df, filter_column, b["train_start"], b["train_end"])
    return train, between_dates(df, filter_column, b["test_start"], b["test_end"])


def shared_keys(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Keys found on both sides of a split; must be empty."""
    return train.select(key).intersect(test.select(key))


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, category, code): codes 0.. over the sorted distinct values of each column.

    Distinct values are found in one pass with map-side combine; only that vocabulary is ranked.
    """
    from pyspark.sql.window import Window

    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns
    ])
    seen = df.select(F.inline(pairs)).where("category IS NOT NULL").distinct()
    order = Window.partitionBy("column_name").orderBy("category")
    return seen.withColumn("code", (F.dense_rank().over(order) - 1).cast("int"))


def encode(df: DataFrame, codes: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Add an integer code per category column; unseen and null become -1.

    One equi-join per column against its slice of the vocabulary. A vocabulary is tiny next to
    the data, so Spark sees its size at run time and broadcasts it; a large one is shuffled.
    Pass a written table of codes: a lazy one would scan the training rows once per column.
    """
    for c in columns:
        of_column = codes.where(F.col("column_name") == c).select(
            F.col("category").alias("_cat"), F.col("code").alias("_code")
        )
        joined = df.join(of_column, df[c].cast("string") == F.col("_cat"), "left")
        df = joined.withColumn(c + suffix, F.coalesce("_code", F.lit(UNKNOWN_CODE))).drop("_cat", "_code")
    return df


def feature_lookup(rows: DataFrame, features: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Rows with chosen features of a table keyed by `key`. Check the key first (require_key)."""
    return rows.join(features.select(key, *names), key, "left")


def training_set(
    rows: DataFrame, features: DataFrame, key: str, names: list[str], label: str, exclude: list[str]
) -> DataFrame:
    """Looked-up and computed features with the label; columns outside the contract dropped."""
    looked = feature_lookup(rows, features, key, names)
    computed = looked.withColumns({
        "lead_time": dates.whole_days_between(F.col("arrival_date"), F.col("date_of_reservation")),
        "arrival_month": dates.month_number(F.col("arrival_date")),
    })
    kept = [c for c in computed.columns if c not in exclude and c != label]
    return computed.select(*kept, label)


def roles(df: DataFrame, segment: Column | None = None) -> DataFrame:
    """Features and target by role list, of one segment when given."""
    rows = df if segment is None else df.where(segment)
    return rows.select(*NUMERIC, *CATEGORICAL, TARGET)
