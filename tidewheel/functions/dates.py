"""Date and time expressions, including times packed as a YYYYMMDDHHMM number."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one literal that is repaired, and the accepted input format.
BROKEN_DATE = "2018-2-29"
REPAIRED_DATE = "3/1/2018"
INPUT_DATE_FORMAT = "M/d/yyyy"
PACKED_FORMAT = "yyyyMMddHHmm"


def repair_date(text: Column) -> Column:
    """Replace the one known invalid literal; leave everything else alone."""
    return F.when(text == BROKEN_DATE, F.lit(REPAIRED_DATE)).otherwise(text)


def parse_date(text: Column, strict: bool = True) -> Column:
    """Month/day/year text to a timestamp. Strict raises on junk, otherwise junk is null."""
    parser = F.to_timestamp if strict else F.try_to_timestamp
    fmt = INPUT_DATE_FORMAT if strict else F.lit(INPUT_DATE_FORMAT)
    return parser(repair_date(text), fmt)


def add_days(moment: Column, days: Column) -> Column:
    """Timestamp moved by a number of days."""
    zero = F.lit(0)
    return moment + F.make_dt_interval(days.cast("int"), zero, zero, F.lit(0).cast("decimal(18,6)"))


def pack_minute(moment: Column) -> Column:
    """Timestamp to its packed YYYYMMDDHHMM number."""
    return F.date_format(moment, PACKED_FORMAT).cast("long")


def packed_parts(packed: Column) -> dict[str, Column]:
    """Year, month and day of a packed number."""
    return {
        "year": F.floor(packed / 100000000).cast("int"),
        "month": F.floor((packed % 100000000) / 1000000).cast("int"),
        "day": F.floor((packed % 1000000) / 10000).cast("int"),
    }


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Floor of the day difference (minus one and a half days gives minus two)."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return F.floor(seconds / 86400).cast("long")


def month_number(moment: Column) -> Column:
    return F.month(moment).cast("long")


def seconds_from_ms(ms: Column) -> Column:
    return ms.cast("double") / F.lit(1000.0)


def truncate(unit: str, moment: Column) -> Column:
    """date_trunc that keeps the zone-less type."""
    return F.date_trunc(unit, moment).cast("timestamp_ntz")


def next_month_start(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), 1)


def random_day_of_month(month_start: Column, seed: int) -> Column:
    """Uniform day of the month that starts at month_start."""
    days = F.day(F.last_day(month_start))
    return F.date_add(month_start, F.floor(F.rand(seed) * days).cast("int"))


def _shift_months(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def split_bounds(max_date: date, test_months: int = 1, train_months: int = 12) -> dict[str, date]:
    """Train and test windows around the month of the newest date.

    The test window opens test_months - 1 months before the newest month and runs up to the
    newest date. The train window opens train_months before the newest month and closes the
    day before the test window, so the two never overlap.
    """
    month = max_date.replace(day=1)
    test_start = _shift_months(month, -(test_months - 1))
    return {
        "train_start": _shift_months(month, -train_months),
        "train_end": test_start - timedelta(days=1),
        "test_start": test_start,
        "test_end": max_date,
    }
