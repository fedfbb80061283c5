"""Snapshots, sinks, change feed, constraints and ingest on small frames in fresh folders."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql import types as T

from tidewheel.sources import changes, ingest, snapshots, tables


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    assert snapshots.latest_version(spark, root) is None
    assert snapshots.write_snapshot(spark.range(3), root) == 0
    assert snapshots.write_snapshot(spark.range(5), root) == 1
    assert snapshots.latest_version(spark, root) == 1
    assert snapshots.read_snapshot(spark, root, 0).count() == 3
    assert snapshots.read_snapshot(spark, root).count() == 5
    assert sorted(r["rows"] for r in snapshots.history(spark, root).collect()) == [3, 5]
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, root, 9)


def test_uncommitted_version_is_not_read(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(spark.range(3), root)
    spark.range(9).write.parquet(f"{root}/v=1")
    assert snapshots.read_snapshot(spark, root).count() == 3


def test_lineage_row(spark):
    row = snapshots.lineage_row(spark.range(4), "r1", "train", "SELECT 1", 2).first()
    assert (row["run_id"], row["role"], row["version"], row["row_count"]) == ("r1", "train", 2, 4)


def test_csv_declared_schema(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("Booking_ID,lead time\nINN1,3\nINN2,0\n")
    rows = tables.read_csv(spark, str(path), "Booking_ID string, `lead time` int")
    assert [tuple(r) for r in rows.collect()] == [("INN1", 3), ("INN2", 0)]
    path.write_text("Booking_ID,lead time\nINN1,soon\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path), "Booking_ID string, `lead time` int").collect()


def test_lines_and_inputs(spark, tmp_path):
    path = tmp_path / "q.txt"
    path.write_text("  what?  \n\n   \nwhy?\n")
    rows = tables.evaluation_inputs(tables.read_lines(spark, str(path)))
    assert sorted(r.inputs.question for r in rows.collect()) == ["what?", "why?"]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    rows = tables.read_binary(spark, str(tmp_path), "*.pdf").collect()
    assert [bytes(r.content) for r in rows] == [b"one"]


def test_table_sinks(spark):
    spark.sql("DROP TABLE IF EXISTS sink_t")
    assert not tables.table_exists(spark, "sink_t")
    assert tables.write_counted(spark.range(4).toDF("id"), "sink_t") == 4
    tables.append_table(spark.range(2).toDF("id"), "sink_t")
    assert tables.read_table(spark, "sink_t").count() == 6
    assert tables.write_counted(spark.range(0).toDF("id"), "sink_t") == 0
    tables.overwrite_table(spark.range(1).toDF("id"), "sink_t")
    assert tables.table_exists(spark, "sink_t") and spark.table("sink_t").count() == 1
    tables.replace_table_as(spark.range(2).select(F.col("id"), F.lit("x").alias("tag")), "sink_t")
    assert spark.table("sink_t").columns == ["id", "tag"]
    tables.define_view(spark, "sink_v", "SELECT count(*) AS n FROM sink_t")
    assert spark.table("sink_v").first()["n"] == 2
    spark.sql("DROP VIEW sink_v")
    spark.sql("DROP TABLE sink_t")


def test_insert_into_creates(spark):
    spark.sql("DROP TABLE IF EXISTS ins_t")
    for _ in range(2):
        tables.insert_into(spark.range(2).select(F.lit("p").alias("path"), F.col("id")), "ins_t", "id BIGINT, path STRING")
    assert spark.table("ins_t").count() == 4 and spark.table("ins_t").columns == ["id", "path"]
    spark.sql("DROP TABLE ins_t")


def test_driver_rows(spark):
    schema = T.StructType([T.StructField("paper_id", T.StringType(), False), T.StructField("authors", T.ArrayType(T.StringType()))])
    rows = tables.rows_with_ingest_time(spark, [("p1", ["a", "b"])], schema)
    assert rows.schema["paper_id"].nullable is False and rows.first()["ingest_ts"] is not None


def test_change_feed_and_merge(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "id int, v string").where("id <> 1")
    feed = changes.change_feed(before, after, ["id"])
    assert sorted((r.id, r._change_type) for r in feed.collect()) == [(1, "delete"), (2, "update"), (4, "insert")]
    merged = changes.apply_changes(before, feed, ["id"])
    assert sorted(map(tuple, merged.collect())) == [(2, "B"), (3, None), (4, "d")]


def test_constraints(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert sorted((r.violation, r.n_rows) for r in changes.constraint_violations(rows, ["id"]).collect()) == [
        ("duplicate_key", 2), ("null_key", 1),
    ]
    with pytest.raises(ValueError):
        changes.require_key(rows, ["id"])
    changes.require_key(rows.where("id = 2"), ["id"])


def test_range_start(spark):
    now = F.lit("2024-06-10 12:30:00").cast("timestamp_ntz")
    papers = spark.createDataFrame([(202406010000,), (202405010000,)], "processed long")
    assert ingest.range_start(papers, now).first()[0] == 202406010000
    assert ingest.range_start(papers.limit(0), now).first()[0] == 202406071230
    assert ingest.range_start(papers, now, forced="true").first()[0] == 202406071230
    assert ingest.range_start(papers, now, forced="false").first()[0] == 202406010000


def test_range_ingest_keeps_going(spark):
    rows = spark.createDataFrame([(5, "cs", "1"), (6, "cs", "x"), (7, "math", "2"), (99, "cs", "3")], "t long, cat string, n string")
    good, bad = ingest.range_ingest(rows, F.col("cat") == "cs", "t", 5, 10, {"no_number": F.col("n").try_cast("int")})
    assert [r.t for r in good.collect()] == [5]
    assert [(r.t, r.failure) for r in bad.collect()] == [(6, "no_number")]


def test_request_payload(spark):
    import json

    row = spark.createDataFrame([(2, "Meal 1")], "lead_time int, meal string").select(
        ingest.request_payload(ingest.record_array(["lead_time", "meal"]), F.lit("INN1"), F.struct(F.lit("INN1").alias("booking_id"))).alias("j")
    ).first()["j"]
    assert json.loads(row) == {
        "client_request_id": "INN1", "dataframe_records": [{"lead_time": 2, "meal": "Meal 1"}], "params": {"booking_id": "INN1"},
    }


def test_change_feed_sees_moved_and_null_values(spark):
    from tidewheel.sources.changes import apply_changes, change_feed

    kind = "id int, a string, b string"
    before = spark.createDataFrame([(1, None, "x"), (2, "y", None), (None, "n", "n"), (4, "d", None)], kind)
    after = spark.createDataFrame([(1, "x", None), (2, "y", None), (None, "n", "n"), (5, None, None)], kind)
    feed = change_feed(before, after, ["id"])
    assert {(r.id, r._change_type) for r in feed.collect()} == {(1, "update"), (4, "delete"), (5, "insert")}
    assert sorted(map(str, apply_changes(before, feed, ["id"]).collect())) == sorted(map(str, after.collect()))


def test_positions_keep_null_keys(spark):
    from tidewheel.operators.ranking import positions_by_hash, positions_by_key

    rows = [(None if i % 3 else "k", None if i == 4 else i // 2, i) for i in range(60)]
    frame = spark.createDataFrame(rows, "key string, t int, tie int")
    one = positions_by_key(frame, ["key"], "t", "tie", previous="before")
    whole = Window.partitionBy("key").orderBy("t", "tie")
    plain = frame.withColumns({"position": F.row_number().over(whole).cast("long"), "before": F.lag("t").over(whole)})
    assert sorted(map(str, one.collect())) == sorted(map(str, plain.collect()))
    numbered = positions_by_hash(frame, frame["key"])
    assert sorted(r.position for r in numbered.collect()) == list(range(1, 61))
