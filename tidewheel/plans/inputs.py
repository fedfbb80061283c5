"""Domain tables derived from the given ones, in Spark and (for the checks) in SQL.

Every table is a whole-table projection or an equi-join of given tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates, nested, text
from tidewheel.operators import bookings as booking_ops
from tidewheel.operators import inference_log, sessions, traces
from tidewheel.sources import ingest

# White space as Unicode counts it, for regular expressions that know ASCII only.
SQL_SPACE = r"\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- bookings ------------------------------------------------------------------------------


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean booking table; `order_key` and `order_status` are kept for joins."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").cast("int").alias("open_lines"),
        F.count_if(F.col("l_linestatus") == "F").cast("int").alias("closed_lines"),
        F.count_if(F.col("l_discount") >= 0.05).cast("int").alias("discounted"),
    )
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").join(
        customers, orders.o_custkey == customers.c_custkey, "left"
    )

    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    rows = joined.select(
        F.concat(F.lit("INN"), F.col("o_orderkey").cast("string")).alias("Booking_ID"),
        number("lines").alias("number_of_adults"),
        number("returned").alias("number_of_children"),
        number("open_lines").alias("number_of_weekend_nights"),
        number("closed_lines").alias("number_of_week_nights"),
        (F.col("o_custkey") % 2).cast("int").alias("car_parking_space"),
        number("discounted").alias("special_requests"),
        (F.col("o_orderkey") * 7 % 90).cast("int").alias("lead_time"),
        F.col("o_orderpriority").alias("type_of_meal"),
        F.concat(F.lit("Room_"), F.col("o_orderstatus")).alias("room_type"),
        F.col("c_mktsegment").alias("market_segment_type"),
        (F.floor(F.col("o_totalprice") * 100 / F.greatest(number("lines"), F.lit(1))) / 100).alias("average_price"),
        F.col("o_orderdate").alias("date_of_reservation"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("order_status"),
    )
    return booking_ops.with_arrival(rows)


BOOKINGS_SQL = """
line_facts AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS lines,
    CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS returned,
    CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS INTEGER) AS open_lines,
    CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS INTEGER) AS closed_lines,
    CAST(count(*) FILTER (WHERE l_discount >= 0.05) AS INTEGER) AS discounted
  FROM lineitem GROUP BY l_orderkey),
booking_rows AS (
  SELECT 'INN' || o_orderkey AS "Booking_ID",
    coalesce(lines, 0) AS number_of_adults, coalesce(returned, 0) AS number_of_children,
    coalesce(open_lines, 0) AS number_of_weekend_nights, coalesce(closed_lines, 0) AS number_of_week_nights,
    CAST(o_custkey % 2 AS INTEGER) AS car_parking_space, coalesce(discounted, 0) AS special_requests,
    CAST(o_orderkey * 7 % 90 AS INTEGER) AS lead_time, o_orderpriority AS type_of_meal,
    'Room_' || o_orderstatus AS room_type, c_mktsegment AS market_segment_type,
    floor(o_totalprice * 100 / greatest(coalesce(lines, 0), 1)) / 100 AS average_price,
    o_orderdate AS date_of_reservation, o_orderkey AS order_key, o_orderstatus AS order_status
  FROM orders LEFT JOIN line_facts ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
bookings AS (
  SELECT *, date_of_reservation + to_days(lead_time) AS arrival_date,
    CAST(month(date_of_reservation + to_days(lead_time)) AS INTEGER) AS arrival_month
  FROM booking_rows)"""


# --- inference log -------------------------------------------------------------------------


def scored_requests(spark: SparkSession, sf_dir: str, booked: DataFrame | None = None) -> DataFrame:
    """One serving call per event, for the booking of the same number, with its prediction.

    `booked`: the bookings, where a query has them already; they are derived again otherwise.
    """
    events = table(spark, sf_dir, "events")
    booked = bookings(spark, sf_dir) if booked is None else booked
    joined = events.join(booked, events.event_id == booked.order_key)
    return joined.withColumn("prediction", F.floor((F.col("average_price") + F.col("value") - 50) * 100) / 100)


def request_log(spark: SparkSession, sf_dir: str, booked: DataFrame | None = None) -> DataFrame:
    """Inference log with JSON request and response."""
    calls = scored_requests(spark, sf_dir, booked)
    predictions = F.struct(F.array("prediction").alias("Total price per night"))
    return calls.select(
        F.col("ts").alias("request_time"),
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("Booking_ID").alias("client_request_id"),
        F.floor(F.col("value") * 20).cast("long").alias("execution_duration_ms"),
        ingest.request_payload(ingest.record_array(inference_log.RECORD_FIELDS), F.col("Booking_ID")).alias("request"),
        F.to_json(F.struct(predictions.alias("predictions"))).alias("response"),
    )


def ground_truth(spark: SparkSession, sf_dir: str, booked: DataFrame | None = None) -> DataFrame:
    """Prices of bookings that are no longer pending."""
    booked = bookings(spark, sf_dir) if booked is None else booked
    return booked.where(F.col("order_status") != "P").select("Booking_ID", "average_price")


MONITORING_SQL = BOOKINGS_SQL + """,
monitoring AS (
  SELECT "Booking_ID", ts AS request_time, 'req-' || event_id AS request_id,
    CAST(floor(value * 20) AS BIGINT) AS execution_duration_ms,
    number_of_adults, number_of_children, number_of_weekend_nights, number_of_week_nights,
    car_parking_space, special_requests, lead_time, type_of_meal, room_type, arrival_month,
    market_segment_type, floor((average_price + value - 50) * 100) / 100 AS prediction,
    'booking-price' AS model_name,
    CASE WHEN order_status <> 'P' THEN average_price END AS average_price
  FROM events JOIN bookings ON event_id = order_key)"""


# --- traces --------------------------------------------------------------------------------


def trace_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per event, with nested spans, tags, assessments and a JSON response.

    The document and the label of the same number give response text and verdicts.
    """
    events = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    ).withColumnRenamed("doc_id", "labelled_id")
    rows = events.join(docs, events.event_id == docs.doc_id, "left").join(
        labels, events.event_id == labels.labelled_id, "left"
    )
    rows = rows.withColumn("k", nested.json_int(F.col("props"), "k")).withColumn("n_spans", F.col("k") % 7)

    def span(i: Column) -> Column:
        return F.struct(
            F.when((i + F.col("k")) % 3 == 0, traces.TOOL_SPAN).otherwise(traces.MODEL_SPAN).alias("name"),
            F.floor(F.col("value") * 20 / i).cast("long").alias("duration_ms"),
            F.create_map(
                F.lit("inputs"), F.concat(F.lit("call "), (i % 4).cast("string")),
                F.lit(traces.SPAN_OUTPUTS),
                F.concat(F.lit('{"usage": {"total_tokens": '), (i * F.col("k")).cast("string"), F.lit("}}")),
            ).alias("attributes"),
        )

    spans = F.when(F.col("n_spans") > 0, F.transform(F.sequence(F.lit(1), F.col("n_spans")), span)).otherwise(
        F.expr("array()").cast("array<struct<name:string,duration_ms:bigint,attributes:map<string,string>>>")
    )

    def item(kind: str, content: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.array(F.struct(content.alias("text"))).alias("content"))

    items = F.filter(
        F.array(
            item("reasoning", F.lit("thinking")),
            item("message", F.col("text")),
            item("message", F.when(F.col("event_type") == "error", F.lit(traces.BOUND_MESSAGE))),
        ),
        lambda x: F.get(x["content"], F.lit(0))["text"].isNotNull(),
    )

    def assessment(name: str, value: Column, source: str) -> Column:
        feedback = F.struct(value.alias("value"))
        return F.struct(F.lit(name).alias("name"), feedback.alias("feedback"), F.lit(source).alias("source"))

    def mark(column: Column, good: str, bad: str) -> Column:
        return F.when(column, F.lit(good)).otherwise(F.lit(bad))

    verdicts = F.array(
        assessment("word_count_check", mark(text.within_word_limit(F.col("text")), "true", "false"), "CODE"),
        assessment("polite_tone", mark(F.col("toxic") == 0, "Pass", "Fail"), "LLM_JUDGE"),
        assessment("hook_in_post", mark(F.col("quality") == 1, "Pass", "Fail"), "HUMAN"),
    )
    return rows.select(
        F.concat(F.lit("tr-"), F.col("event_id").cast("string")).alias("trace_id"),
        F.col("event_id").alias("trace_key"),
        F.col("ts").alias("request_time"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("session_id"),
        F.concat(F.lit("ask "), F.col("props")).alias("request_preview"),
        F.to_json(F.struct(items.alias("output"))).alias("response"),
        F.floor(F.col("value") * 20).cast("long").alias("execution_duration_ms"),
        F.create_map(F.lit(traces.ENDPOINT_TAG), F.col("event_type"), F.lit("git_sha"), F.lit("local")).alias("tags"),
        spans.alias("spans"),
        F.when(F.col("labelled_id").isNotNull(), verdicts).alias("assessments"),
    )


TRACES_SQL = f"""
label_rows AS (SELECT doc_id AS labelled_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
trace_rows AS (
  SELECT 'tr-' || event_id AS trace_id, event_id AS trace_key, ts AS request_time, 'user-' || user_id AS session_id,
    'ask ' || props AS request_preview, event_type, value,
    CAST(floor(value * 20) AS BIGINT) AS execution_duration_ms,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, d.text, labelled_id, quality, toxic,
    coalesce(d.text, CASE WHEN event_type = 'error' THEN '{traces.BOUND_MESSAGE}' END) AS response_text,
    len(regexp_extract_all(d.text, '[^{SQL_SPACE}]+')) AS words
  FROM events LEFT JOIN documents d ON event_id = d.doc_id LEFT JOIN label_rows ON event_id = labelled_id),
spans AS (
  SELECT trace_id, i, k, CASE WHEN (i + k) % 3 = 0 THEN 'execute_tool' ELSE 'call_llm' END AS name,
    CAST(floor(value * 20 / i) AS BIGINT) AS duration_ms, 'call ' || (i % 4) AS inputs
  FROM (SELECT *, unnest(range(1, k % 7 + 1)) AS i FROM trace_rows))"""


# --- papers and parsed documents -----------------------------------------------------------


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paper metadata: first line as title, second as summary, times from the number."""
    docs = table(spark, sf_dir, "documents")
    published = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(doc_id AS INT), 0, 0)")
    lines = F.split("text", "\n")
    return docs.select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("paper_id"),
        F.get(lines, F.lit(0)).alias("title"),
        F.coalesce(F.get(lines, F.lit(1)), F.lit("")).alias("summary"),
        F.array("source", "lang").alias("authors"),
        dates.pack_minute(published).alias("published"),
        dates.pack_minute(F.date_trunc("DAY", published) + F.expr("INTERVAL 1 DAY")).alias("processed"),
        "doc_id", "text", "lang",
    )


PAPERS_SQL = """
papers AS (
  SELECT 'doc' || doc_id AS paper_id, string_split(text, chr(10))[1] AS title,
    coalesce(string_split(text, chr(10))[2], '') AS summary, source || ', ' || lang AS authors,
    TIMESTAMP '2024-01-01' + to_hours(doc_id) AS published_at,
    CAST(strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%Y%m%d%H%M') AS BIGINT) AS published,
    CAST(strftime(date_trunc('day', TIMESTAMP '2024-01-01' + to_hours(doc_id)) + INTERVAL 1 DAY, '%Y%m%d%H%M') AS BIGINT) AS processed,
    doc_id, text, lang
  FROM documents)"""


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: one path per document, in the folder of its run."""
    rows = papers(spark, sf_dir)
    path = F.concat_ws("/", F.lit("/volume"), F.col("processed").cast("string"), F.concat("paper_id", F.lit(".pdf")))
    return rows.select(path.alias("path"), "text", "processed")


# --- session messages ----------------------------------------------------------------------


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message rows; two turns share each creation time, as rows of one transaction do."""
    talk = table(spark, sf_dir, "conversations")
    created = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(conv_id AS INT), CAST(turn div 2 AS INT), 0)"
    )
    return talk.select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("id"),
        F.concat(F.lit("session-"), F.col("conv_id").cast("string")).alias("session_id"),
        sessions.to_message(F.col("role"), F.col("text")).alias("message_data"),
        created.alias("created_at"),
    )


MESSAGES_SQL = """
messages AS (
  SELECT conv_id * 1000000 + turn AS id, 'session-' || conv_id AS session_id, role, text AS content,
    TIMESTAMP '2024-01-01' + to_hours(conv_id) + to_minutes(turn // 2) AS created_at
  FROM conversations)"""
