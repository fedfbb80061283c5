"""Streaming jobs over the event file, each equal to its batch form.

The whole results are the queries named _all, held against the uncut SQL. stream_minute,
stream_truth_join and stream_sessions are their rows of windows settled hours ago, as their SQL asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import inference_log
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import oracle_sql, query
from tidewheel.plans.monitoring_queries import rounded
from tidewheel.session import work_path
from tidewheel.streaming import jobs

DELAY = "10 minutes"
SETTLED_HOURS = 3


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.file_stream(spark, sf_dir, "events.parquet", inputs.table(spark, sf_dir, "events").schema)


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def settled(spark: SparkSession, sf_dir: str, df: DataFrame, column: str) -> DataFrame:
    newest = inputs.table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return df.where(F.col(column) < F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {SETTLED_HOURS} HOURS"))


SETTLED_SQL = f"(SELECT max(ts) FROM events) - INTERVAL {SETTLED_HOURS} HOUR"


def whole_sql(name: str, cut: str) -> str:
    """The SQL of a registered query without its cut."""
    sql = oracle_sql()[name]
    if cut not in sql:
        raise ValueError(f"no {cut!r} in the SQL of {name}")
    return sql.replace(cut, "")


@query("stream_monitoring", f"WITH {inputs.MONITORING_SQL} SELECT * FROM monitoring")
def stream_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload log as a stream of JSON rows, parsed and joined with the static truth."""
    source = work_path(spark, "payload-log")
    log = inputs.request_log(spark, sf_dir)
    log.write.parquet(source)
    parsed = jobs.parsed_requests(jobs.file_stream(spark, source, "*.parquet", log.schema))
    truth = inference_log.one_truth_per_key(inputs.ground_truth(spark, sf_dir), "Booking_ID", "average_price")
    joined = parsed.join(truth, "Booking_ID", "left")
    return jobs.read_rows(spark, jobs.run_to_table(joined, "monitoring"), joined.schema)


@query(
    "stream_profile",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS row_count, count(*) - count(value) AS null_count,
      round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY 1, 2""",
)
def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute profile in update mode; the newest state of each window is the result."""
    profile = jobs.window_profile(events(spark, sf_dir), "ts", "5 minutes", ["event_type"], "value", DELAY)
    folder = jobs.run_to_table(profile, "profile", "update")
    latest = jobs.read_latest(spark, folder, profile.schema, ["window_start", "event_type"])
    return rounded(zoneless(latest, "window_start"), 6, "mean")


@query(
    "stream_minute",
    f"""WITH {inputs.TRACES_SQL},
    sums AS (SELECT trace_id, count(*) FILTER (WHERE name = 'call_llm') AS llm,
      coalesce(sum(i * k) FILTER (WHERE name = 'call_llm'), 0) AS tokens FROM spans GROUP BY 1)
    SELECT date_trunc('minute', request_time) AS minute, count(*) AS traces,
      round(avg(execution_duration_ms / 1000.0::DOUBLE), 6) AS avg_latency_seconds, CAST(sum(llm) AS BIGINT) AS llm_calls,
      CAST(sum(tokens) AS BIGINT) AS total_tokens
    FROM trace_rows JOIN sums USING (trace_id) WHERE date_trunc('minute', request_time) < {SETTLED_SQL} GROUP BY 1""",
)
def stream_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settled part of the minute series."""
    return settled(spark, sf_dir, stream_minute_all(spark, sf_dir), "minute")


@query("stream_minute_all", whole_sql("stream_minute", f" WHERE date_trunc('minute', request_time) < {SETTLED_SQL}"))
def stream_minute_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute series in update mode out of a stream of traces; the newest state of each minute is the result."""
    source = work_path(spark, "trace-log")
    log = inputs.trace_log(spark, sf_dir)
    log.write.parquet(source)
    rolled = jobs.trace_rollup(jobs.file_stream(spark, source, "*.parquet", log.schema))
    series = jobs.minute_metrics(rolled, DELAY)
    latest = jobs.read_latest(spark, jobs.run_to_table(series, "minute", "update"), series.schema, ["minute"])
    return rounded(zoneless(latest, "minute"), 6, "avg_latency_seconds")


@query("stream_dedup", "SELECT event_id, ts, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request sent twice and kept once."""
    sent = events(spark, sf_dir).select("event_id", "ts", "event_type")
    twice = sent.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = jobs.deduplicated(twice, "event_id", "ts", DELAY)
    return zoneless(jobs.read_rows(spark, jobs.run_to_table(once, "dedup"), once.schema), "ts")


@query(
    "stream_truth_join",
    f"""SELECT p.event_id AS request_key, p.ts AS request_time, p.value AS prediction, t.ts AS truth_time, t.value AS truth
    FROM events p LEFT JOIN events t ON t.event_id - 1 = p.event_id AND t.ts >= p.ts AND t.ts <= p.ts + INTERVAL 5 MINUTE
    WHERE p.ts < {SETTLED_SQL}""",
)
def stream_truth_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settled part of the truth join."""
    return settled(spark, sf_dir, stream_truth_join_all(spark, sf_dir), "request_time")


@query("stream_truth_join_all", whole_sql("stream_truth_join", f"\n    WHERE p.ts < {SETTLED_SQL}"))
def stream_truth_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with the truth the following event brings, when it comes within five minutes."""

    def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return rows.select(
            F.col("event_id").alias("request_key"), F.col("ts").alias("request_time"), F.col("value").alias("prediction")
        ), rows.select(
            (F.col("event_id") - 1).alias("request_key"), F.col("ts").alias("truth_time"), F.col("value").alias("truth")
        )

    # One stream read for each side.
    predictions, truths = sides(events(spark, sf_dir))[0], sides(events(spark, sf_dir))[1]
    joined = jobs.with_late_truth(predictions, truths, "request_key", "5 MINUTES", DELAY)
    emitted = jobs.read_rows(spark, jobs.run_to_table(joined, "truth"), joined.schema)
    batch = sides(inputs.table(spark, sf_dir, "events"))
    rows = jobs.with_open_predictions(emitted, *batch, "request_key", "5 MINUTES", DELAY)
    return zoneless(rows, "request_time", "truth_time")


@query(
    "stream_sessions",
    f"""WITH marked AS (
      SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events),
    numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
    bursts AS (SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS events FROM numbered GROUP BY user_id, s)
    SELECT * FROM bursts WHERE "end" < {SETTLED_SQL}""",
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settled part of the sessions."""
    return settled(spark, sf_dir, stream_sessions_all(spark, sf_dir), "end")


@query("stream_sessions_all", whole_sql("stream_sessions", f' WHERE "end" < {SETTLED_SQL}'))
def stream_sessions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty-minute activity sessions per user: those the stream has closed, and the open ones in a closing step."""
    bursts = jobs.session_activity(events(spark, sf_dir), "user_id", "ts", "30 minutes", DELAY)
    closed = jobs.read_rows(spark, jobs.run_to_table(bursts, "sessions"), bursts.schema)
    rows = inputs.table(spark, sf_dir, "events").select("user_id", "ts")
    whole = jobs.with_open_sessions(closed, rows, "user_id", "ts", "30 minutes", DELAY)
    return zoneless(whole, "start", "end")
