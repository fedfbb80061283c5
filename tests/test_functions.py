"""Expressions on literal rows, with the values the contract fixes."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.functions import dates, nested, routing, text


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return rows.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [
    ("docu-\nments", "documents"),
    ("Schö-\n ön", "Schöön"),
    ("a - \n b", "a - b"),
    (" one\n\n\ntwo\t\tthree  ", "one two three"),
    ("no break", "no break"),
    ("", ""),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, text.clean_text(F.col("t")), t=raw) == clean


@pytest.mark.parametrize("words, within", [(0, True), (349, True), (350, False)])
def test_word_limit(spark, words, within):
    assert one(spark, text.within_word_limit(F.col("t")), t="w " * words) is within


def test_word_limit_of_null(spark):
    assert one(spark, text.within_word_limit(F.lit(None).cast("string"))) is None


def test_word_count_unicode_space(spark):
    assert one(spark, text.word_count(F.col("t")), t="a b c") == 3


@pytest.mark.parametrize("path, ident", [("/v/2024/1234.5678.pdf", "1234.5678"), ("x.pdf.pdf", "x"), ("plain", "plain")])
def test_path_to_id(spark, path, ident):
    assert one(spark, text.path_to_id(F.col("p")), p=path) == ident


def test_composite_id_skips_null(spark):
    assert one(spark, text.composite_id(F.lit("p"), F.lit(None).cast("string"))) == "p"
    assert one(spark, text.composite_id(F.lit("p"), F.lit("3"))) == "p_3"


@pytest.mark.parametrize("sku, stripped", [
    ("SERVERLESS_US_EAST", "SERVERLESS"), ("SERVERLESS_US_WEST_2", "SERVERLESS"), ("A_EU_WEST_B", "A_EU_WEST_B"),
])
def test_strip_region(spark, sku, stripped):
    assert one(spark, text.strip_region(F.col("s")), s=sku) == stripped


def test_column_name():
    assert text.column_name("P-not-C") == "P_not_C" and text.column_name("type of meal") == "type_of_meal"


def test_leap_day_repair(spark):
    assert one(spark, dates.parse_date(F.col("d")), d="2018-2-29") == datetime(2018, 3, 1)
    assert one(spark, dates.parse_date(F.col("d")), d="10/2/2015") == datetime(2015, 10, 2)


def test_bad_date(spark):
    with pytest.raises(Exception):
        one(spark, dates.parse_date(F.col("d")), d="2019-01-05")
    assert one(spark, dates.parse_date(F.col("d"), strict=False), d="2019-01-05") is None


def test_packed_minute(spark):
    assert one(spark, dates.pack_minute(F.lit(datetime(2025, 3, 4, 5, 6)))) == 202503040506
    parts = spark.range(1).select(F.lit(202503040506).alias("p")).select(
        *[c.alias(n) for n, c in dates.packed_parts(F.col("p")).items()]
    ).first()
    assert tuple(parts) == (2025, 3, 4)


def test_day_difference_is_floored(spark):
    early, late = F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 2, 12))
    assert one(spark, dates.whole_days_between(late, early)) == 1
    assert one(spark, dates.whole_days_between(early, late)) == -2


def test_split_bounds():
    b = dates.split_bounds(date(2024, 12, 15), 1, 12)
    assert [str(b[k]) for k in ("train_start", "train_end", "test_start", "test_end")] == [
        "2023-12-01", "2024-11-30", "2024-12-01", "2024-12-15",
    ]
    wide = dates.split_bounds(date(2024, 1, 31), 3, 12)
    assert str(wide["test_start"]) == "2023-11-01" and str(wide["train_end"]) == "2023-10-31"


def test_next_month(spark):
    assert one(spark, dates.next_month_start(F.lit(date(2024, 12, 15)))) == date(2025, 1, 1)
    assert one(spark, dates.random_day_of_month(F.lit(date(2025, 2, 1)), 7)).month == 2


@pytest.mark.parametrize("price, adjusted", [(100.0, 105.0), (99.99, 104.99), (200.0, 210.0)])
def test_adjust_price(spark, price, adjusted):
    assert one(spark, routing.adjust_price(F.col("p")), p=price) == adjusted


def test_ab_variant(spark):
    import hashlib

    for ident in ("INN1", "INN2", "INN3", ""):
        expected = "A" if int(hashlib.md5(ident.encode()).hexdigest(), 16) % 2 else "B"
        assert one(spark, routing.ab_variant(F.col("i")), i=ident) == expected
    missing = one(spark, routing.ab_variant(F.lit(None).cast("string")))
    assert missing == one(spark, routing.ab_variant(F.lit("")))


def test_weighted_route_needs_whole_percent():
    with pytest.raises(ValueError):
        routing.weighted_route(F.lit("x"), [("a", 50)])


def test_json_int(spark):
    good = '{"usage": {"total_tokens": "12"}}'
    assert one(spark, nested.json_int(F.col("j"), "usage", "total_tokens"), j=good) == 12
    assert one(spark, nested.json_int(F.col("j"), "usage", "total_tokens"), j='{"usage": {"total_tokens": "many"}}') is None
    assert one(spark, nested.json_int(F.col("j"), "usage", "total_tokens"), j="no json") is None


def test_tri_state(spark):
    values = spark.createDataFrame([("Pass",), ("Fail",), (None,)], "v string")
    assert [r[0] for r in values.select(nested.tri_state(F.col("v"), "Pass")).collect()] == [1, 0, None]


def test_array_helpers(spark):
    items = F.array(F.struct(F.lit("Hello, ").alias("text")), F.struct(F.lit("world").alias("text")))
    assert one(spark, nested.concat_texts(items)) == "Hello, world"
    assert one(spark, nested.last_item(F.array(F.lit(1), F.lit(2)))) == 2
    assert one(spark, nested.first_match(F.array(F.lit(1), F.lit(2)), lambda x: x > 5)) is None
    assert one(spark, nested.is_blank_array(F.lit(None).cast("array<int>"))) is True


def test_one_row_each(spark):
    rows = spark.createDataFrame([(1, [7, None]), (2, []), (3, None)], "id int, items array<int>")
    out = nested.one_row_each(rows, "items", "item", "pos").select("id", "pos", "item").collect()
    assert [tuple(r) for r in out] == [(1, 0, 7), (1, 1, None)]


def test_null_tags_dropped(spark):
    tags = nested.drop_null_tags(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string")))
    assert one(spark, tags) == {"a": "1"}
