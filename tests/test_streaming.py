"""Streams continue from their checkpoint and count every row once."""

from pyspark.sql import functions as F

from tidewheel.plans import inputs
from tidewheel.streaming import jobs


def test_second_run_takes_only_new_files(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(10).select("id", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    rows.write.mode("append").parquet(source)

    def run():
        stream = jobs.file_stream(spark, source, "*.parquet", rows.schema)
        return jobs.read_rows(spark, jobs.run_to_table(stream, "t", root=root), rows.schema)

    assert run().count() == 10
    rows.limit(4).write.mode("append").parquet(source)
    assert run().count() == 14
    assert run().count() == 14


def test_update_mode_over_several_batches(spark, tmp_path):
    """A window that is touched by several batches ends with its full count."""
    source = str(tmp_path / "in")
    rows = spark.range(60).select(
        F.col("id"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 7).cast("int"))).alias("ts"),
        F.lit("k").alias("key"), F.col("id").cast("double").alias("value"),
    )
    rows.repartition(6).write.parquet(source)
    stream = jobs.file_stream(spark, source, "*.parquet", rows.schema, files_per_batch=1)
    profile = jobs.window_profile(stream, "ts", "5 minutes", ["key"], "value", "1 hour")
    folder = jobs.run_to_table(profile, "p", "update", root=str(tmp_path / "out"))
    latest = jobs.read_latest(spark, folder, profile.schema, ["window_start", "key"])
    expected = rows.groupBy(F.window("ts", "5 minutes")["start"].alias("w")).count().collect()
    assert {(r.window_start, r.row_count) for r in latest.collect()} == {(r.w, r["count"]) for r in expected}


def test_payload_stream_equals_batch(spark, sf_dir, tmp_path):
    source = str(tmp_path / "log")
    log = inputs.request_log(spark, sf_dir)
    log.repartition(3).write.parquet(source)
    parsed = jobs.parsed_requests(jobs.file_stream(spark, source, "*.parquet", log.schema, files_per_batch=1))
    streamed = jobs.read_rows(spark, jobs.run_to_table(parsed, "s", root=str(tmp_path / "out")), parsed.schema)
    from tidewheel.operators import inference_log

    batch = inference_log.parse_payload(log)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch.select(streamed.columns)).count() == 0


def test_newest_hours_are_in_the_results(spark, sf_dir):
    """Rows of the last three hours, which the settled queries leave out, are in the whole ones."""
    from tidewheel.plans import stream_queries as q

    newest = inputs.table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    since = F.lit(newest).cast("timestamp_ntz") - F.expr("INTERVAL 3 HOURS")
    asked = inputs.table(spark, sf_dir, "events").where(F.col("ts") >= since).count()
    found = q.stream_truth_join_all(spark, sf_dir).where(F.col("request_time") >= since)
    assert found.select("request_key").distinct().count() == asked > 0
    sessions = q.stream_sessions_all(spark, sf_dir)
    assert sessions.agg(F.sum("events")).first()[0] == inputs.table(spark, sf_dir, "events").count()
