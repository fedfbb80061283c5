"""Inference log, metrics, profile, drift and alert on literal rows."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import bookings, inference_log, quality

LOG = "request_time timestamp_ntz, request_id string, client_request_id string, execution_duration_ms long, request string, response string"


def payload(leads, prices):
    import json

    request = {"dataframe_records": [{"lead_time": x, "type_of_meal": "Meal 1"} for x in leads]}
    return json.dumps(request), json.dumps({"predictions": {"Total price per night": prices}})


def log(spark, *rows):
    data = [(t, rid, bid, 5, *(p if isinstance(p, tuple) else (p, "{}"))) for t, rid, bid, p in rows]
    return spark.createDataFrame(data, LOG)


T0, T1, T2 = datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)


def test_prediction_by_position(spark):
    rows = inference_log.parse_payload(log(spark, (T0, "r", "b", payload([1, 2, 3], [10.0, 20.0])))).collect()
    assert sorted((r.lead_time, r.prediction) for r in rows) == [(1, 10.0), (2, 20.0), (3, None)]
    assert rows[0].type_of_meal == "Meal 1" and rows[0].number_of_adults is None


def test_bad_json_is_counted(spark):
    frame = log(spark, (T0, "r1", "b", "no json"), (T0, "r2", "b", payload([1], [1.0])))
    assert inference_log.parse_payload(frame).count() == 1
    assert [r.request_id for r in inference_log.unreadable_payloads(frame).collect()] == ["r1"]


def test_increment_keeps_ties_and_late_rows(spark):
    frame = log(spark, *[(t, f"r{i}", "b", payload([1], [1.0])) for i, t in enumerate([T0, T1, T1, T2])])
    loaded = frame.where("request_id IN ('r0', 'r1')")
    fresh = inference_log.new_payload(frame, loaded, overlap_minutes=90)
    assert sorted(r.request_id for r in fresh.collect()) == ["r2", "r3"]
    newest = frame.where("request_id = 'r3'")
    assert sorted(r.request_id for r in inference_log.new_payload(frame, newest).collect()) == ["r0", "r1", "r2"]
    assert inference_log.new_payload(frame, None).count() == 4
    assert inference_log.new_payload(frame, loaded.limit(0)).count() == 4


def test_truth_does_not_multiply_rows(spark):
    truth = spark.createDataFrame([("b", 5.0), ("b", 5.0)], "Booking_ID string, average_price double")
    rows = inference_log.monitoring_rows(log(spark, (T0, "r", "b", payload([1], [1.0])), (T0, "s", "c", payload([1], [1.0]))), truth)
    assert sorted((r.Booking_ID, r.average_price) for r in rows.collect()) == [("b", 5.0), ("c", None)]
    late = spark.createDataFrame([("c", 7.0), ("b", 9.0)], "Booking_ID string, average_price double")
    filled = inference_log.backfill_truth(rows, late)
    assert filled.columns == rows.columns
    assert sorted((r.Booking_ID, r.average_price) for r in filled.collect()) == [("b", 5.0), ("c", 7.0)]


def test_update_job_on_tables(spark):
    from tidewheel.operators import increments

    for name in ("job_log", "job_truth", "job_target"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([("b", 5.0)], "Booking_ID string, average_price double").write.saveAsTable("job_truth")
    log(spark, (T0, "r0", "b", payload([1, 2], [1.0, 2.0])), (T1, "r1", "c", payload([1], [1.0]))).write.saveAsTable("job_log")

    def update():
        return increments.update_monitoring_table(spark, "job_log", "job_truth", "job_target")

    assert update() == 3 and update() == 0
    log(spark, (T1, "r2", "b", payload([3], [3.0])), (T2, "r3", "c", payload([4], [4.0]))).write.mode("append").saveAsTable("job_log")
    assert update() == 2 and update() == 0
    assert spark.table("job_target").count() == 5 and increments.pending_truth(spark, "job_target") == 2
    for name in ("job_log", "job_truth", "job_target"):
        spark.sql(f"DROP TABLE {name}")


def test_chunk_job_is_idempotent(spark):
    from tidewheel.operators import increments

    for name in ("doc_parsed", "doc_papers", "doc_chunks"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    doc = '{"document": {"elements": [{"id": "0", "type": "text", "content": "a"}, {"id": "1", "type": "text", "content": "b"}]}}'
    spark.createDataFrame([("/v/p1.pdf", doc, 1), ("/v/p2.pdf", doc, 2)], "path string, parsed_content string, processed long").write.saveAsTable("doc_parsed")
    spark.createDataFrame([("p1", "T", "S", ["A"], 202401010000)], "paper_id string, title string, summary string, authors array<string>, published long").write.saveAsTable("doc_papers")

    def update(batch):
        return increments.update_chunk_table(spark, "doc_parsed", "doc_papers", "doc_chunks", batch)

    assert [update(1), update(1), update(2), update(2)] == [2, 0, 2, 0]
    assert spark.table("doc_chunks").count() == 4
    for name in ("doc_parsed", "doc_papers", "doc_chunks"):
        spark.sql(f"DROP TABLE {name}")


def test_split_payload_and_contract(spark):
    request = '{"dataframe_split": {"columns": ["a", "b"], "data": [[1, "x"], [2, null]]}}'
    frame = spark.createDataFrame([(request,)], "r string")
    rows = frame.select(F.explode(inference_log.parse_split_payload(F.col("r"))).alias("m")).collect()
    assert [r.m for r in rows] == [{"a": "1", "b": "x"}, {"a": "2", "b": None}]
    gaps = inference_log.contract_gaps(F.array(F.lit("b"), F.lit("z")), ["a", "b"])
    row = spark.range(1).select(*[c.alias(n) for n, c in gaps.items()]).first()
    assert (row.missing, row.extra) == (["a"], ["z"])


def test_chat_without_input_is_kept(spark):
    frame = spark.createDataFrame([(1, '{"custom_inputs": {"session_id": "s", "request_id": "q"}}')], "id int, request string")
    row = inference_log.parse_chat(frame).first()
    assert (row.session_id, row.chat_request_id, row.role) == ("s", "q", None)


def test_regression_metrics(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 9.0), (5.0, None)], "y double, p double")
    m = quality.regression_metrics(rows, {}, "y", "p").first()
    assert (m.n_labelled, m.mae, m.mse, m.max_error, m.target_sum) == (2, 0.5, 0.5, 1.0, 4.0)
    assert m.r2 == pytest.approx(1 - 1.0 / 2.0) and m.mape == pytest.approx(0.5)
    constant = quality.regression_metrics(rows.where("y = 3"), {}, "y", "p").first()
    assert constant.r2 is None


def test_alert_ignores_nan_and_null(spark):
    profile = spark.createDataFrame([(40.0,), (10.0,), (float("nan"),), (None,)], "mae double")
    row = quality.error_alert(profile).first()
    assert (row.high_windows, row.finite_windows, row.percent_high, row.alert) == (1, 2, 50.0, True)
    empty = quality.error_alert(profile.where("mae IS NULL")).first()
    assert empty.percent_high is None and empty.alert is False


def test_profile_approximate_distinct(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("v"))
    stats = quality.numeric_profile(rows, {}, ["v"]).first()
    assert stats.row_count == 1000 and stats.distinct_count == 10 and stats.median == 4.0


def test_drift_of_equal_tables_is_zero(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 3).cast("string").alias("c"))
    out = quality.drift_vs_baseline(rows, {}, rows, ["v"], ["c"]).collect()
    assert len(out) == 2
    for r in out:
        assert r.psi == pytest.approx(0) and r.total_variation == pytest.approx(0) and r.chi_square == pytest.approx(0)


def test_drift_of_disjoint_categories(spark):
    base = spark.createDataFrame([("a",)] * 4, "c string")
    now = spark.createDataFrame([("b",)] * 4, "c string")
    rows = base.withColumn("v", F.lit(1.0)), now.withColumn("v", F.lit(2.0))
    out = {r.column_name: r for r in quality.drift_vs_baseline(rows[1], {}, rows[0], ["v"], ["c"]).collect()}
    assert out["c"].total_variation == pytest.approx(1.0)
    assert out["c"].js_divergence == pytest.approx(math.log(2), abs=1e-3)
    assert out["v"].ks == pytest.approx(1.0) and out["c"].ks is None


def test_between_includes_the_whole_last_day(spark):
    from datetime import date

    rows = spark.createDataFrame([(datetime(2024, 1, 31, 23, 59),), (datetime(2024, 2, 1),)], "t timestamp_ntz")
    assert bookings.between_dates(rows, "t", date(2024, 1, 1), date(2024, 1, 31)).count() == 1


def test_clean_raw_rows(spark):
    rows = spark.createDataFrame([("INN1", 10, 1, "10/2/2015"), ("INN2", 0, 2, "2018-2-29")], "`Booking_ID` string, `lead time` int, `P-C` int, `date of reservation` string")
    out = {r.Booking_ID: r for r in bookings.clean(rows).collect()}
    assert out["INN1"].arrival_date == datetime(2015, 10, 12) and out["INN1"].arrival_month == 10 and out["INN1"].P_C == 1
    assert out["INN2"].date_of_reservation == datetime(2018, 3, 1)
    broken = rows.union(spark.createDataFrame([("INN3", 1, 1, "2018-03-04")], rows.schema))
    with pytest.raises(Exception):
        bookings.clean(broken).collect()
    good, bad = bookings.clean_or_quarantine(broken)
    assert good.count() == 2 and [r.Booking_ID for r in bad.collect()] == ["INN3"]


def test_unseen_and_null_categories(spark):
    fitted = spark.createDataFrame([("b",), ("a",), ("c",)], "room_type string")
    codes = bookings.category_codes(fitted, ["room_type"])
    rows = spark.createDataFrame([("a",), ("c",), ("Room_Type_999",), (None,)], "room_type string")
    out = {r.room_type: r.room_type_code for r in bookings.encode(rows, codes, ["room_type"]).collect()}
    assert out == {"a": 0, "c": 2, "Room_Type_999": -1, None: -1}
