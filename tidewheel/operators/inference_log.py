"""JSON inference logs to typed monitoring rows, incrementally, with ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import nested

# The payload contract.
RECORD_SCHEMA = (
    "number_of_adults:int, number_of_children:int, number_of_weekend_nights:int,"
    " number_of_week_nights:int, car_parking_space:int, special_requests:int, lead_time:int,"
    " type_of_meal:string, room_type:string, arrival_month:int, market_segment_type:string"
)
REQUEST_SCHEMA = f"struct<dataframe_records: array<struct<{RECORD_SCHEMA}>>>"
RESPONSE_SCHEMA = "struct<predictions: struct<`Total price per night`: array<double>>>"
SPLIT_SCHEMA = "struct<dataframe_split: struct<columns: array<string>, data: array<array<string>>>>"
CHAT_SCHEMA = (
    "struct<input: array<struct<role: string, content: string>>,"
    " custom_inputs: struct<session_id: string, request_id: string>>"
)
RECORD_FIELDS = [part.split(":")[0].strip() for part in RECORD_SCHEMA.split(",")]
MODEL_NAME = "booking-price"


def parse_payload(log: DataFrame, model_name: str = MODEL_NAME) -> DataFrame:
    """One row per request record, each with the prediction at its own position.

    A payload that is no JSON yields no record; count those with `unreadable_payloads`.
    """
    parsed = log.select(
        "request_time", "request_id", "execution_duration_ms",
        F.col("client_request_id").alias("Booking_ID"),
        F.from_json("request", REQUEST_SCHEMA)["dataframe_records"].alias("records"),
        F.from_json("response", RESPONSE_SCHEMA)["predictions"]["Total price per night"].alias("prices"),
    )
    rows = nested.one_row_each(parsed, "records", "record", "pos")
    return rows.select(
        "Booking_ID", "request_time", "request_id", "execution_duration_ms", "record.*",
        F.get("prices", F.col("pos")).alias("prediction"),
        F.lit(model_name).alias("model_name"),
    )


def unreadable_payloads(log: DataFrame) -> DataFrame:
    """Log rows whose request holds no record list."""
    return log.where(F.from_json("request", REQUEST_SCHEMA)["dataframe_records"].isNull())


def one_truth_per_key(truth: DataFrame, key: str, value: str) -> DataFrame:
    """Ground truth reduced to one value per id, so that the join cannot multiply rows."""
    return truth.groupBy(key).agg(F.max(value).alias(value))


def with_truth(rows: DataFrame, truth: DataFrame, key: str = "Booking_ID", value: str = "average_price") -> DataFrame:
    return rows.join(one_truth_per_key(truth, key, value), key, "left")


def high_water(table: DataFrame, column: str = "request_time"):
    """Newest time already loaded, read once as a value; None for an empty table."""
    return table.agg(F.max(column).alias("m")).first()["m"]


def new_payload(log: DataFrame, loaded: DataFrame | None, overlap_minutes: int | None = None) -> DataFrame:
    """Log rows not loaded yet.

    Rows are told from loaded ones by request id, so late rows of any age and ties at the mark are
    kept. Where a source promises a greatest delay, overlap_minutes keeps both scans to the rows
    after mark minus overlap, a literal that they push down; older rows are then not loaded.
    """
    mark = None if loaded is None else high_water(loaded)
    if mark is None:
        return log
    at = F.lit(mark).cast(log.schema["request_time"].dataType)
    if overlap_minutes is None:
        # Nothing above the mark is loaded; only the rest is compared.
        below = log.where((F.col("request_time") <= at) | F.col("request_time").isNull())
        late = below.join(loaded.select("request_id"), "request_id", "left_anti")
        return log.where(F.col("request_time") > at).unionByName(late)
    edge = at - F.expr(f"INTERVAL {overlap_minutes} MINUTES")
    recent = loaded.where(F.col("request_time") > edge).select("request_id")
    return log.where(F.col("request_time") > edge).join(recent, "request_id", "left_anti")


def monitoring_rows(log: DataFrame, truth: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """The whole increment: new payload, parsed, with truth where it has arrived."""
    return with_truth(parse_payload(new_payload(log, loaded)), truth)


def backfill_truth(monitoring: DataFrame, truth: DataFrame, key: str = "Booking_ID", value: str = "average_price") -> DataFrame:
    """Monitoring rows with late truth filled in where the label was still missing."""
    late = one_truth_per_key(truth, key, value).withColumnRenamed(value, "_late")
    filled = monitoring.join(late, key, "left")
    return filled.withColumn(value, F.coalesce(value, "_late")).drop("_late").select(*monitoring.columns)


def parse_split_payload(request: Column) -> Column:
    """Column-and-rows payload as an array of name → text maps, one per row."""
    split = F.from_json(request, SPLIT_SCHEMA)["dataframe_split"]
    return F.transform(split["data"], lambda row: F.map_from_arrays(split["columns"], row))


def records_to_split(records: str, columns: list[str]) -> Column:
    """Record array column as a column-and-rows payload, values as text."""
    names = F.array(*[F.lit(c) for c in columns])
    data = F.transform(records, lambda r: F.array(*[r[c].cast("string") for c in columns]))
    return F.to_json(F.struct(F.struct(names.alias("columns"), data.alias("data")).alias("dataframe_split")))


def contract_gaps(given: Column, expected: list[str]) -> dict[str, Column]:
    """Names missing from and foreign to the expected input columns, sorted."""
    wanted = F.array(*[F.lit(c) for c in expected])
    return {
        "missing": F.array_sort(F.array_except(wanted, given)),
        "extra": F.array_sort(F.array_except(given, wanted)),
    }


def parse_chat(log: DataFrame, column: str = "request") -> DataFrame:
    """One row per input message of a chat request, with session and request id."""
    parsed = log.withColumn("_c", F.from_json(column, CHAT_SCHEMA))
    rows = parsed.select("*", F.posexplode_outer("_c.input").alias("position", "_m"))
    return rows.select(
        *[c for c in log.columns if c != column],
        F.col("_c.custom_inputs.session_id").alias("session_id"),
        F.col("_c.custom_inputs.request_id").alias("chat_request_id"),
        "position", F.col("_m.role").alias("role"), F.col("_m.content").alias("content"),
    )
