"""Booking table: cleaning, split, codes, features, routing, payload forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates, nested, routing
from tidewheel.operators import bookings as booking_ops
from tidewheel.operators import inference_log, training
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.plans.monitoring_queries import rounded
from tidewheel.session import materialize
from tidewheel.sources import changes, ingest

RAW_NAMES = {
    "number_of_adults": "number of adults", "number_of_children": "number of children",
    "number_of_weekend_nights": "number of weekend nights", "number_of_week_nights": "number of week nights",
    "car_parking_space": "car parking space", "special_requests": "special requests", "lead_time": "lead time",
    "type_of_meal": "type of meal", "room_type": "room type", "market_segment_type": "market-segment-type",
    "average_price": "average price",
}


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings as they arrive: spaces and hyphens in names, dates as month/day/year text.

    Reservations of 28 February carry the broken literal, pending ones of the first of a month
    a date in another format.
    """
    rows = inputs.bookings(spark, sf_dir)
    day = F.col("date_of_reservation")
    text = (
        F.when((F.month(day) == 2) & (F.day(day) == 28), F.lit(dates.BROKEN_DATE))
        .when((F.day(day) == 1) & (F.col("order_status") == "P"), F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.date_format(day, "M/d/yyyy"))
    )
    named = rows.withColumn("date of reservation", text).drop("arrival_date", "arrival_month", "date_of_reservation", "order_key", "order_status")
    return named.withColumnsRenamed(RAW_NAMES)


IS_BAD = "(day(date_of_reservation) = 1 AND order_status = 'P' AND NOT (month(date_of_reservation) = 2 AND day(date_of_reservation) = 28))"
CLEAN_COLUMNS = ", ".join(['"Booking_ID"', *RAW_NAMES])


@query(
    "booking_clean",
    f"""WITH {inputs.BOOKINGS_SQL},
    dated AS (SELECT {CLEAN_COLUMNS}, CASE WHEN month(date_of_reservation) = 2 AND day(date_of_reservation) = 28
        THEN TIMESTAMP '2018-03-01' ELSE date_of_reservation END AS date_of_reservation
      FROM bookings WHERE NOT {IS_BAD})
    SELECT *, date_of_reservation + to_days(lead_time) AS arrival_date,
      CAST(month(date_of_reservation + to_days(lead_time)) AS INTEGER) AS arrival_month FROM dated""",
)
def booking_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = booking_ops.clean_or_quarantine(raw_bookings(spark, sf_dir))
    return good.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("date_of_reservation", "arrival_date")})


@query(
    "ingest_quarantine",
    f"""WITH {inputs.BOOKINGS_SQL}
    SELECT "Booking_ID", strftime(date_of_reservation, '%Y/%m/%d') AS date_of_reservation, 'unreadable_date' AS failure
    FROM bookings WHERE {IS_BAD}""",
)
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a range ingest that could not be read, with the reason."""
    named = booking_ops.rename_columns(raw_bookings(spark, sf_dir))
    parsed = dates.parse_date(F.col("date_of_reservation"), strict=False)
    source = named.withColumn("submitted", F.substring("Booking_ID", 4, 20).cast("long"))
    _, bad = ingest.range_ingest(
        source, F.col("market_segment_type").isNotNull(), "submitted", 0, 2**62,
        {"missing_id": F.col("Booking_ID"), "unreadable_date": parsed},
    )
    return bad.select("Booking_ID", "date_of_reservation", "failure")


@query(
    "booking_split_counts",
    f"""WITH {inputs.BOOKINGS_SQL},
    b AS (SELECT max(date_of_reservation) AS newest, date_trunc('month', max(date_of_reservation)) AS m FROM bookings),
    parts AS (
      SELECT 'train' AS part, bookings.* FROM bookings, b
      WHERE CAST(arrival_date AS DATE) BETWEEN CAST(m - INTERVAL 12 MONTH AS DATE) AND CAST(m - INTERVAL 1 DAY AS DATE)
      UNION ALL SELECT 'test', bookings.* FROM bookings, b
      WHERE CAST(arrival_date AS DATE) BETWEEN CAST(m AS DATE) AND CAST(newest AS DATE))
    SELECT part, count(*) AS rows, min(arrival_date) AS first_arrival, max(arrival_date) AS last_arrival,
      round(sum(average_price), 2) AS price_sum FROM parts GROUP BY part""",
)
def booking_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = booking_ops.time_split(inputs.bookings(spark, sf_dir))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("arrival_date").alias("first_arrival"),
        F.max("arrival_date").alias("last_arrival"), F.round(F.sum("average_price"), 2).alias("price_sum"),
    )


@query("split_overlap", f"""WITH {inputs.BOOKINGS_SQL},
    b AS (SELECT max(date_of_reservation) AS newest, date_trunc('month', max(date_of_reservation)) AS m FROM bookings)
    SELECT count(*) AS shared_keys FROM (
      SELECT "Booking_ID" FROM bookings, b WHERE arrival_date >= m - INTERVAL 13 MONTH AND arrival_date < m - INTERVAL 1 MONTH
      INTERSECT SELECT "Booking_ID" FROM bookings, b WHERE arrival_date >= m - INTERVAL 1 MONTH AND arrival_date < newest + INTERVAL 1 DAY)""")
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys on both sides of a two-month test split: none, as the train window closes before it."""
    train, test = booking_ops.time_split(inputs.bookings(spark, sf_dir), test_months=2, train_months=12)
    return booking_ops.shared_keys(train, test, "Booking_ID").agg(F.count(F.lit(1)).alias("shared_keys"))


@query(
    "segment_projection",
    f"""WITH {inputs.BOOKINGS_SQL} SELECT {', '.join(booking_ops.NUMERIC + booking_ops.CATEGORICAL)}, average_price
    FROM bookings WHERE market_segment_type = 'BUILDING'""",
)
def segment_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return booking_ops.roles(inputs.bookings(spark, sf_dir), F.col("market_segment_type") == "BUILDING")


CODES_SQL = """codes AS (
  SELECT column_name, category, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY category) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT column_name, category FROM (
    SELECT 'type_of_meal' AS column_name, type_of_meal AS category FROM bookings
    UNION ALL SELECT 'room_type', room_type FROM bookings
    UNION ALL SELECT 'arrival_month', CAST(arrival_month AS VARCHAR) FROM bookings
    UNION ALL SELECT 'market_segment_type', market_segment_type FROM bookings) WHERE category IS NOT NULL))"""


@query("category_codes", f"WITH {inputs.BOOKINGS_SQL}, {CODES_SQL} SELECT * FROM codes")
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return booking_ops.category_codes(inputs.bookings(spark, sf_dir), booking_ops.CATEGORICAL)


@query(
    "category_encode",
    f"""WITH {inputs.BOOKINGS_SQL}, fitted AS (SELECT * FROM bookings WHERE order_status <> 'P'),
    {CODES_SQL.replace('FROM bookings', 'FROM fitted')}
    SELECT "Booking_ID", coalesce(a.code, -1) AS type_of_meal_code, coalesce(b.code, -1) AS room_type_code,
      coalesce(c.code, -1) AS arrival_month_code, coalesce(d.code, -1) AS market_segment_type_code
    FROM bookings
    LEFT JOIN codes a ON a.column_name = 'type_of_meal' AND a.category = type_of_meal
    LEFT JOIN codes b ON b.column_name = 'room_type' AND b.category = room_type
    LEFT JOIN codes c ON c.column_name = 'arrival_month' AND c.category = CAST(arrival_month AS VARCHAR)
    LEFT JOIN codes d ON d.column_name = 'market_segment_type' AND d.category = market_segment_type""",
)
def category_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes fitted on settled bookings, applied to all: the pending room type is unseen."""
    rows = inputs.bookings(spark, sf_dir)
    fitted = booking_ops.category_codes(rows.where("order_status <> 'P'"), booking_ops.CATEGORICAL)
    codes = materialize(fitted, "codes")
    coded = booking_ops.encode(rows, codes, booking_ops.CATEGORICAL)
    return coded.select("Booking_ID", *[f"{c}_code" for c in booking_ops.CATEGORICAL])


FEATURES = ["number_of_adults", "number_of_children", "special_requests", "room_type"]


@query(
    "feature_training_set",
    f"""WITH {inputs.BOOKINGS_SQL} SELECT "Booking_ID", {', '.join(FEATURES)}, CAST(lead_time AS BIGINT) AS lead_time,
      CAST(arrival_month AS BIGINT) AS arrival_month, average_price FROM bookings""",
)
def feature_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.bookings(spark, sf_dir)
    base = rows.select("Booking_ID", "arrival_date", "date_of_reservation", "average_price")
    return booking_ops.training_set(
        base, rows, "Booking_ID", FEATURES, "average_price", exclude=["arrival_date", "date_of_reservation"]
    )


@query(
    "feature_point_lookup",
    f"""WITH {inputs.BOOKINGS_SQL} SELECT 'INN' || event_id AS "Booking_ID", lead_time, average_price, type_of_meal
    FROM events LEFT JOIN bookings ON "Booking_ID" = 'INN' || event_id""",
)
def feature_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features for a list of keys."""
    keys = inputs.table(spark, sf_dir, "events").select(F.concat(F.lit("INN"), F.col("event_id").cast("string")).alias("Booking_ID"))
    return booking_ops.feature_lookup(keys, inputs.bookings(spark, sf_dir), "Booking_ID", ["lead_time", "average_price", "type_of_meal"])


SQL_VARIANT = """CASE WHEN (instr('0123456789abcdef', substr(md5("Booking_ID"), 32, 1)) - 1) % 2 = 1 THEN 'A' ELSE 'B' END"""


@query("ab_assignment", f"""WITH {inputs.BOOKINGS_SQL} SELECT "Booking_ID", {SQL_VARIANT} AS variant FROM bookings""")
def ab_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bookings(spark, sf_dir).select("Booking_ID", routing.ab_variant(F.col("Booking_ID")).alias("variant"))


@query(
    "ab_outcome",
    f"""WITH {inputs.MONITORING_SQL},
    scored AS (SELECT *, {SQL_VARIANT} AS variant FROM monitoring),
    priced AS (SELECT variant, average_price AS y,
      CAST(round(CAST(CAST(CASE variant WHEN 'A' THEN prediction ELSE prediction + 10 END * 1.05 AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS price FROM scored)
    SELECT variant, count(*) AS rows, round(avg(price), 6) AS mean_price, round(avg(abs(y - price)), 6) AS mae,
      round(sqrt(avg((y - price) * (y - price))), 6) AS rmse, round(max(abs(y - price)), 6) AS max_error
    FROM priced GROUP BY variant""",
)
def ab_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per variant; variant B adds ten to the logged prediction."""
    log = inference_log.monitoring_rows(inputs.request_log(spark, sf_dir), inputs.ground_truth(spark, sf_dir))
    models = {"A": lambda df: df, "B": lambda df: df.withColumn("prediction", F.col("prediction") + 10)}
    scored = training.ab_score(log, "Booking_ID", models)
    return rounded(training.ab_outcome(scored, "average_price"), 6, "mean_price", "mae", "rmse", "max_error")


@query(
    "weighted_route",
    """SELECT o_orderkey AS request_id, CASE
      WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 70 THEN 'v1'
      WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 90 THEN 'v2' ELSE 'v3' END AS version
    FROM orders""",
)
def weighted_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id"))
    return ids.withColumn("version", routing.weighted_route(F.col("request_id"), [("v1", 70), ("v2", 20), ("v3", 10)]))


SPLIT_COLUMNS = ["number_of_adults", "lead_time", "room_type"]


def split_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.bookings(spark, sf_dir).withColumn("records", ingest.record_array(inference_log.RECORD_FIELDS))
    return rows.select("Booking_ID", inference_log.records_to_split("records", SPLIT_COLUMNS).alias("request"))


@query("payload_split_parse", f"""WITH {inputs.BOOKINGS_SQL} SELECT "Booking_ID", number_of_adults, lead_time, room_type FROM bookings""")
def payload_split_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as column-and-rows payload, parsed back to typed rows."""
    parsed = split_requests(spark, sf_dir).select("Booking_ID", inference_log.parse_split_payload(F.col("request")).alias("rows"))
    rows = nested.one_row_each(parsed, "rows", "row")
    types = {"number_of_adults": "int", "lead_time": "int", "room_type": "string"}
    return rows.select("Booking_ID", *[F.col("row")[c].try_cast(t).alias(c) for c, t in types.items()])


@query(
    "payload_contract_check",
    """SELECT event_id, CASE WHEN value > 100 THEN 'value' END AS missing, CASE WHEN event_type = 'error' THEN 'reason' END AS extra
    FROM events""",
)
def payload_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs with a column too few or too many, per request."""
    events = inputs.table(spark, sf_dir, "events")
    given = F.filter(
        F.array(
            F.lit("event_type"), F.when(F.col("value") <= 100, F.lit("value")),
            F.when(F.col("event_type") == "error", F.lit("reason")),
        ),
        lambda c: c.isNotNull(),
    )
    gaps = inference_log.contract_gaps(given, ["event_type", "value"])
    named = {k: F.when(F.size(v) > 0, F.concat_ws(",", v)) for k, v in gaps.items()}
    return events.select("event_id", *[c.alias(k) for k, c in named.items()])


@query(
    "constraint_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, 'duplicate_key' AS violation
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.constraint_violations(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


AFTER_SQL = """
after_rows AS (
  SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE c_nationkey <> 3
  UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier)"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers before and after: one nation deleted, one segment updated, suppliers inserted."""
    customers = inputs.table(spark, sf_dir, "customer")
    before = customers.select("c_custkey", "c_name", "c_acctbal")
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    kept = customers.where("c_nationkey <> 3").select("c_custkey", "c_name", raised.alias("c_acctbal"))
    fresh = inputs.table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )
    return before, kept.unionByName(fresh)


@query(
    "change_feed",
    f"""WITH {AFTER_SQL}
    SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_name, a.c_acctbal,
      CASE WHEN b.c_custkey IS NULL THEN 'insert' WHEN a.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS _change_type
    FROM customer b FULL JOIN after_rows a ON a.c_custkey = b.c_custkey
    WHERE b.c_custkey IS NULL OR a.c_custkey IS NULL OR a.c_name <> b.c_name OR a.c_acctbal <> b.c_acctbal""",
)
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = snapshots(spark, sf_dir)
    return changes.change_feed(before, after, ["c_custkey"])


@query("index_upsert", f"WITH {AFTER_SQL} SELECT * FROM after_rows")
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed merged into the old snapshot gives the new one."""
    before, after = snapshots(spark, sf_dir)
    return changes.apply_changes(before, changes.change_feed(before, after, ["c_custkey"]), ["c_custkey"])
