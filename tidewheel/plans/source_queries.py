"""File sources, table sinks and whole incremental jobs, written from the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import nested
from tidewheel.operators import evaluation, increments, inference_log
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.plans.monitoring_queries import LOADED_UNTIL
from tidewheel.session import work_path
from tidewheel.sources import ingest, snapshots, tables

# The customer segment whose view is defined.
SEGMENT = "BUILDING"


def fresh_database(spark: SparkSession, name: str) -> str:
    """A database of its own for one run, with its tables in the shared folder."""
    database = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_path(spark, database)}'")
    return database


@query("csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header, under a declared schema."""
    path = work_path(spark, "csv")
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    rows.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")


@query(
    "binary_scan",
    """SELECT s_nationkey, octet_length(encode(body)) AS n_bytes, sha256(body) AS digest
    FROM (SELECT s_nationkey, string_agg(s_name, chr(10) ORDER BY s_suppkey) || chr(10) AS body FROM supplier GROUP BY s_nationkey)""",
)
def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files by path: one list of supplier names for each nation."""
    path = work_path(spark, "lists")
    names = inputs.table(spark, sf_dir, "supplier").repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    names.select("s_nationkey", "s_name").write.partitionBy("s_nationkey").text(path)
    files = tables.read_binary(spark, path, "*.txt")
    return files.select(
        F.regexp_extract("path", "s_nationkey=([0-9]+)", 1).cast("int").alias("s_nationkey"),
        F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("digest"),
    )


@query(
    "evaluation_lines",
    r"""SELECT question FROM (SELECT trim(unnest(regexp_split_to_array(text, '\r\n|\r|\n')), ' ') AS question FROM benchmark)
    WHERE len(question) > 0""",
)
def evaluation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files as rows of an evaluation run."""
    path = work_path(spark, "questions")
    inputs.table(spark, sf_dir, "benchmark").where("text IS NOT NULL").select("text").write.text(path)
    return tables.evaluation_inputs(tables.read_lines(spark, path)).select("inputs.question")


@query(
    "table_sinks",
    f"""SELECT 'appended' AS sink, c_nationkey, 2 * count(*) AS rows FROM customer GROUP BY c_nationkey
    UNION ALL SELECT 'overwritten', c_nationkey, count(*) FROM customer GROUP BY c_nationkey
    UNION ALL SELECT 'inserted', c_nationkey, 2 * count(*) FROM customer GROUP BY c_nationkey
    UNION ALL SELECT 'viewed', c_nationkey, count(*) FROM customer WHERE c_mktsegment = '{SEGMENT}' GROUP BY c_nationkey""",
)
def table_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sink run twice: appends and inserts add up, overwrites do not; a view follows its table."""
    at = fresh_database(spark, "sinks")
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    for _ in range(2):
        tables.append_table(rows, f"{at}.appended")
        tables.overwrite_table(rows, f"{at}.overwritten")
        # Columns in another order: inserted by name.
        tables.insert_into(rows, f"{at}.inserted", "c_mktsegment string, c_custkey long, c_nationkey int")
    tables.define_view(spark, f"{at}.viewed", f"SELECT * FROM {at}.overwritten WHERE c_mktsegment = '{SEGMENT}'")

    def counted(name: str) -> DataFrame:
        read = tables.read_table(spark, f"{at}.{name}").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("rows"))
        return read.select(F.lit(name).alias("sink"), "c_nationkey", "rows")

    return counted("appended").union(counted("overwritten")).union(counted("inserted")).union(counted("viewed"))


@query(
    "monitoring_table_job",
    f"""WITH {inputs.MONITORING_SQL},
    runs AS (
      SELECT count(*) FILTER (WHERE request_time < TIMESTAMP '{LOADED_UNTIL}') AS first_run,
        count(*) FILTER (WHERE request_time >= TIMESTAMP '{LOADED_UNTIL}') AS second_run FROM monitoring)
    SELECT monitoring.*, first_run, second_run, CAST(0 AS BIGINT) AS third_run FROM monitoring, runs""",
)
def monitoring_table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table job over a growing log: a first load, an increment, and a run with nothing new."""
    at = fresh_database(spark, "monitoring")
    log, truth, target = f"{at}.log", f"{at}.truth", f"{at}.monitoring"
    tables.overwrite_table(inputs.ground_truth(spark, sf_dir), truth)
    whole = inputs.request_log(spark, sf_dir)
    early = F.col("request_time") < F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    tables.append_table(whole.where(early), log)
    runs = {"first_run": increments.update_monitoring_table(spark, log, truth, target)}
    tables.append_table(whole.where(~early), log)
    for name in ("second_run", "third_run"):
        runs[name] = increments.update_monitoring_table(spark, log, truth, target)
    return tables.read_table(spark, target).withColumns({k: F.lit(v).cast("long") for k, v in runs.items()})


@query(
    "lineage_rows",
    """SELECT 'run-1' AS run_id, CASE WHEN o_orderstatus = 'P' THEN 'test' ELSE 'train' END AS role,
      CAST(3 AS BIGINT) AS version, count(*) AS row_count FROM orders GROUP BY ALL""",
)
def lineage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run trained and tested on."""
    orders = inputs.table(spark, sf_dir, "orders")
    parts = {"train": "o_orderstatus <> 'P'", "test": "o_orderstatus = 'P'"}
    train, test = (snapshots.lineage_row(orders.where(sql), "run-1", role, sql, 3) for role, sql in parts.items())
    return train.union(test).select("run_id", "role", "version", "row_count")


@query(
    "monitoring_two_records",
    f"""WITH {inputs.MONITORING_SQL}
    SELECT "Booking_ID", request_id, CAST(lead_time + i AS INTEGER) AS lead_time,
      CASE WHEN i < 2 THEN prediction + i END AS prediction FROM monitoring, (SELECT unnest([0, 1, 2]) AS i)""",
)
def monitoring_two_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of three records with two predictions: matched by place, the third has none."""
    calls = inputs.scored_requests(spark, sf_dir)
    fields = inference_log.RECORD_FIELDS

    def record(i: int):
        return F.struct(*[(F.col(c) + i if c == "lead_time" else F.col(c)).alias(c) for c in fields])

    prices = F.struct(F.array("prediction", F.col("prediction") + 1).alias("Total price per night"))
    log = calls.select(
        F.col("ts").alias("request_time"), F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("Booking_ID").alias("client_request_id"), F.lit(0).cast("long").alias("execution_duration_ms"),
        ingest.request_payload(F.array(*[record(i) for i in range(3)]), F.col("Booking_ID")).alias("request"),
        F.to_json(F.struct(prices.alias("predictions"))).alias("response"),
    )
    return inference_log.parse_payload(log).select("Booking_ID", "request_id", "lead_time", "prediction")


@query(
    "payload_contract_gaps",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'lead_time,room_type' ELSE '' END AS missing,
      CASE WHEN o_orderstatus = 'P' THEN 'rooms' ELSE '' END AS extra FROM orders""",
)
def payload_contract_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names of JSON payloads against the contract."""
    fields = inference_log.RECORD_FIELDS
    wrong = [c for c in fields if c not in ("lead_time", "room_type")] + ["rooms"]
    names = F.when(F.col("o_orderstatus") == "P", F.array(*map(F.lit, wrong))).otherwise(F.array(*map(F.lit, fields)))
    split = F.struct(names.alias("columns"), F.array(F.array(F.lit("1"))).alias("data"))
    log = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(F.struct(split.alias("dataframe_split"))).alias("request")
    )
    given = F.from_json("request", inference_log.SPLIT_SCHEMA)["dataframe_split"]["columns"]
    gaps = inference_log.contract_gaps(given, fields)
    return log.select("o_orderkey", *[F.array_join(gap, ",").alias(name) for name, gap in gaps.items()])


@query("tool_text", "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents")
def tool_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content blocks of a tool's answer as one text."""
    content = F.transform(F.split("text", "\n"), lambda line: F.struct(F.lit("text").alias("type"), line.alias("text")))
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return docs.select("doc_id", nested.concat_texts(F.col("content")).alias("text"))


@query(
    "ingest_range",
    f"""WITH {inputs.PAPERS_SQL}
    SELECT paper_id, published, CASE WHEN summary = '' THEN 'no_summary' ELSE 'ok' END AS outcome FROM papers
    WHERE lang = 'en' AND published BETWEEN 202401030000 AND 202401092300""",
)
def ingest_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of one language and one week, both ends included, split by whether they can be read."""
    good, bad = ingest.range_ingest(
        inputs.papers(spark, sf_dir), F.col("lang") == "en", "published", 202401030000, 202401092300,
        {"no_summary": F.nullif("summary", F.lit(""))},
    )
    kept = good.select("paper_id", "published", F.lit("ok").alias("outcome"))
    return kept.unionByName(bad.select("paper_id", "published", F.col("failure").alias("outcome")))


@query(
    "judged_by_both_tone",
    "SELECT 'tr-' || event_id AS trace_id FROM events WHERE event_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)",
)
def judged_by_both_tone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only some people judged the tone that a judge judged on every labelled trace."""
    told = F.transform("assessments", lambda a: F.struct(
        F.when((a["source"] == "HUMAN") & (a["feedback"]["value"] == "Pass"), "polite_tone").otherwise(a["name"]).alias("name"),
        a["feedback"].alias("feedback"), a["source"].alias("source"),
    ))
    log = inputs.trace_log(spark, sf_dir).withColumn("assessments", told)
    return evaluation.judged_by_both(log, "polite_tone").select("trace_id")
