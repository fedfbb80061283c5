"""Plan properties that matter at scale: no pair products, pushed filters, no needless shuffle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.functions import nested
from tidewheel.operators import bookings, chunks, inference_log, traces
from tidewheel.plans import inputs

HEAVY = {"gbt_scores", "hpo_trials", "synthetic_next_month", "knn_cells"}


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in HEAVY and not n.startswith("stream_")))
def test_no_pair_products(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    from datetime import date

    path = str(tmp_path / "b")
    inputs.bookings(spark, sf_dir).write.parquet(path)
    table = spark.read.parquet(path)
    dated = plan(bookings.between_dates(table, "arrival_date", date(1997, 1, 1), date(1997, 1, 31)).select("lead_time"))
    assert "GreaterThanOrEqual(arrival_date" in dated and "LessThan(arrival_date" in dated
    assert "ReadSchema: struct<lead_time:int,arrival_date:timestamp_ntz>" in dated

    parsed, papers = str(tmp_path / "p"), inputs.papers(spark, sf_dir)
    chunks.parse_documents(inputs.document_files(spark, sf_dir), F.col("text"), F.col("processed")).write.parquet(parsed)
    batch = plan(chunks.chunk_table(spark.read.parquet(parsed), papers, 202401020000))
    assert "EqualTo(processed,202401020000)" in batch


def test_increment_mark_is_a_pushed_literal(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    inputs.request_log(spark, sf_dir).write.parquet(path)
    log = spark.read.parquet(path)
    text = plan(inference_log.new_payload(log, log.where("request_time < '2024-01-10'").select("request_id", "request_time")))
    assert "GreaterThan(request_time,2024-01-0" in text


def test_rollup_and_review_do_not_shuffle(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    inputs.trace_log(spark, sf_dir).write.parquet(path)
    table = spark.read.parquet(path)
    assert "Exchange" not in plan(traces.rollup(table))
    assert "Exchange" not in plan(traces.performance_review(table))


def test_payload_is_parsed_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    inputs.request_log(spark, sf_dir).write.parquet(path)
    parsed = inference_log.parse_payload(spark.read.parquet(path))
    assert plan(parsed).count("from_json(StructField(dataframe_records") == 1


def test_outer_explode_infers_no_filter(spark, tmp_path):
    path = str(tmp_path / "j")
    spark.createDataFrame([("[1]",)], "j string").write.parquet(path)
    rows = spark.read.parquet(path).select(F.from_json("j", "array<int>").alias("a"))
    assert "size(from_json" not in plan(nested.one_row_each(rows, "a", "x"))
