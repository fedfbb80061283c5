"""JSON, array and map expressions that never raise on short arrays or bad numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_each(df: DataFrame, items: Column | str, name: str, position: str | None = None) -> DataFrame:
    """One row per array item, with its position when named; empty and null arrays give none.

    An inner explode makes Spark infer a not-empty filter that evaluates the array expression
    again (a second parse of every document). The outer form with a test of the position does not.
    """
    place = position or "_position"
    rows = df.select("*", F.posexplode_outer(items).alias(place, name)).where(F.col(place).isNotNull())
    return rows if position else rows.drop(place)


def first_match(items: Column, test: Callable[[Column], Column]) -> Column:
    """First array element passing the test, null when there is none."""
    return F.get(F.filter(items, test), F.lit(0))


def last_item(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def is_blank_array(items: Column) -> Column:
    """True for a null or an empty array."""
    return items.isNull() | (F.size(items) == 0)


def json_int(document: Column, *keys: str) -> Column:
    """Integer under a key path of a JSON string; null when absent or not a number."""
    return F.get_json_object(document, "$." + ".".join(keys)).try_cast("int")


def any_item(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(items, test), F.lit(False))


def concat_texts(content: Column) -> Column:
    """Texts of a content array glued together without a separator."""
    return F.array_join(F.transform(content, lambda c: c["text"]), "")


def tag_equals(tags: Column, key: str, value: str) -> Column:
    return F.try_element_at(tags, F.lit(key)) == F.lit(value)


def drop_null_tags(tags: Column) -> Column:
    """Map without the entries that have no value."""
    return F.map_filter(tags, lambda _, v: v.isNotNull())


def tri_state(value: Column, passing: str) -> Column:
    """1 for the passing value, null for none, 0 for anything else."""
    return F.when(value == passing, 1).when(value.isNotNull(), 0).cast("int")
