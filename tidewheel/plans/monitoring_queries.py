"""Inference-log monitoring: increments, profiles, drift, alert, usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import inference_log, quality, usage
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.session import materialize
from tidewheel.sources import ingest

LOADED_UNTIL = "2024-01-15 00:00:00"
NUMERIC = ["lead_time", "prediction", "average_price"]
CATEGORICAL = ["market_segment_type", "room_type"]
DRIFT_NUMERIC = ["lead_time", "average_price"]


def monitoring(spark: SparkSession, sf_dir: str, booked: DataFrame | None = None) -> DataFrame:
    return inference_log.monitoring_rows(inputs.request_log(spark, sf_dir, booked), inputs.ground_truth(spark, sf_dir, booked))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("monitoring_append", f"WITH {inputs.MONITORING_SQL} SELECT * FROM monitoring")
def monitoring_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run: the whole log, parsed and joined with the truth."""
    return monitoring(spark, sf_dir)


@query(
    "monitoring_increment",
    f"""WITH {inputs.MONITORING_SQL} SELECT * FROM monitoring
    WHERE request_time > (SELECT max(request_time) FROM monitoring WHERE request_time < TIMESTAMP '{LOADED_UNTIL}')""",
)
def monitoring_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later run: only what the table so far does not hold."""
    log = inputs.request_log(spark, sf_dir)
    loaded = log.where(F.col("request_time") < F.lit(LOADED_UNTIL).cast("timestamp_ntz")).select("request_id", "request_time")
    return inference_log.monitoring_rows(log, inputs.ground_truth(spark, sf_dir), loaded)


@query(
    "truth_backfill",
    f"""WITH {inputs.MONITORING_SQL}
    SELECT m.* EXCLUDE (average_price), b.average_price FROM monitoring m JOIN bookings b USING ("Booking_ID")""",
)
def truth_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth of pending bookings arrives later and fills the missing labels."""
    late = inputs.bookings(spark, sf_dir).select("Booking_ID", "average_price")
    return inference_log.backfill_truth(monitoring(spark, sf_dir), late)


@query(
    "ingest_watermark",
    f"""WITH {inputs.PAPERS_SQL} SELECT coalesce(max(processed), CAST(strftime(TIMESTAMP '2024-06-01' - INTERVAL 3 DAY, '%Y%m%d%H%M') AS BIGINT)) AS range_start FROM papers""",
)
def ingest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.range_start(inputs.papers(spark, sf_dir), F.lit("2024-06-01").cast("timestamp_ntz"))


METRICS_SQL = """count(average_price) AS n_labelled,
  round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(CASE WHEN var_pop(y) * count(y) > 0 THEN 1 - sum(e * e) / (var_pop(y) * count(y)) END, 6) AS r2,
  round(max(abs(e)), 6) AS max_error, round(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)), 9) AS mape,
  round(sum(y), 2) AS target_sum, round(avg(y), 6) AS target_mean"""
ERRORS_SQL = ", errors AS (SELECT *, average_price AS y, average_price - prediction AS e FROM monitoring)"


def rounded_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({
        **{c: F.round(c, 6) for c in ("mae", "mse", "rmse", "r2", "max_error", "target_mean")},
        "mape": F.round("mape", 9), "target_sum": F.round("target_sum", 2),
    })


@query("regression_metrics", f"WITH {inputs.MONITORING_SQL} {ERRORS_SQL} SELECT model_name, {METRICS_SQL} FROM errors GROUP BY model_name")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = monitoring(spark, sf_dir)
    return rounded_metrics(quality.regression_metrics(rows, {"model_name": F.col("model_name")}, "average_price", "prediction"))


@query(
    "monitoring_quality_5min",
    f"""WITH {inputs.MONITORING_SQL} {ERRORS_SQL}
    SELECT time_bucket(INTERVAL 5 MINUTE, request_time) AS window_start, model_name, {METRICS_SQL}
    FROM errors GROUP BY 1, 2""",
)
def monitoring_quality_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "5 minutes", "model_name")
    return rounded_metrics(quality.regression_metrics(monitoring(spark, sf_dir), keys, "average_price", "prediction"))


def profile_sql(keys: str, source: str, columns: list[str]) -> str:
    """Long statistics in SQL. `keys` is a select list of group keys, or empty."""
    lead = f"{keys}, " if keys else ""
    names = "".join(f"{part.split(' AS ')[-1].strip()}, " for part in keys.split(";")) if keys else ""
    lead = lead.replace(";", ",")
    longs = " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns
    )
    return f"""SELECT {names}count(*) AS row_count, column_name, count(*) - count(v) AS null_count,
      count(DISTINCT v) AS distinct_count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
      min(v) AS min, max(v) AS max, quantile_disc(v, 0.25) AS q25, quantile_disc(v, 0.5) AS median,
      quantile_disc(v, 0.75) AS q75
    FROM ({longs}) GROUP BY {names}column_name"""


def rounded_profile(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "mean", "std")


FIVE_MINUTES = "time_bucket(INTERVAL 5 MINUTE, request_time) AS window_start"
ONE_DAY = "time_bucket(INTERVAL 1 DAY, request_time) AS window_start"


@query(
    "monitoring_profile_5min",
    f"WITH {inputs.MONITORING_SQL} " + profile_sql(f"{FIVE_MINUTES}; model_name", "monitoring", NUMERIC),
)
def monitoring_profile_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "5 minutes", "model_name")
    return rounded_profile(quality.numeric_profile(monitoring(spark, sf_dir), keys, NUMERIC))


@query("profile_time_series", f"WITH {inputs.MONITORING_SQL} " + profile_sql(ONE_DAY, "monitoring", NUMERIC))
def profile_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "1 day")
    return rounded_profile(quality.numeric_profile(monitoring(spark, sf_dir), keys, NUMERIC))


@query("profile_snapshot", f"WITH {inputs.BOOKINGS_SQL} " + profile_sql("", "bookings", ["lead_time", "number_of_adults", "average_price"]))
def profile_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["lead_time", "number_of_adults", "average_price"]
    return rounded_profile(quality.numeric_profile(inputs.bookings(spark, sf_dir), {}, columns))


@query(
    "profile_categories_daily",
    f"""WITH {inputs.MONITORING_SQL},
    counted AS (
      SELECT window_start, column_name, value, count(*) AS n FROM (
        SELECT {ONE_DAY}, 'market_segment_type' AS column_name, market_segment_type AS value FROM monitoring
        UNION ALL SELECT {ONE_DAY}, 'room_type', room_type FROM monitoring) GROUP BY ALL),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY window_start, column_name ORDER BY value IS NULL, n DESC, value) AS place FROM counted)
    SELECT window_start, column_name, CAST(sum(n) AS BIGINT) AS row_count,
      CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS null_count,
      count(value) AS distinct_count, max(value) FILTER (WHERE place = 1) AS top_value
    FROM ranked GROUP BY 1, 2""",
)
def profile_categories_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.categorical_profile(monitoring(spark, sf_dir), quality.window_keys("request_time", "1 day"), CATEGORICAL)


@query(
    "mae_alert",
    f"""WITH {inputs.MONITORING_SQL} {ERRORS_SQL},
    windows AS (SELECT time_bucket(INTERVAL 5 MINUTE, request_time) AS w, avg(abs(e)) AS mae FROM errors GROUP BY 1)
    SELECT count(*) FILTER (WHERE mae > 30) AS high_windows, count(mae) AS finite_windows,
      round(count(*) FILTER (WHERE mae > 30) * 100.0 / nullif(count(mae), 0), 6) AS percent_high,
      coalesce(count(*) FILTER (WHERE mae > 30) * 100.0 / nullif(count(mae), 0) > 45, false) AS alert
    FROM windows""",
)
def mae_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "5 minutes", "model_name")
    profile = quality.regression_metrics(monitoring(spark, sf_dir), keys, "average_price", "prediction")
    return rounded(quality.error_alert(profile), 6, "percent_high")


def _edges_sql() -> str:
    parts = []
    for c in DRIFT_NUMERIC:
        inner = ", ".join(f"quantile_disc(CAST({c} AS DOUBLE), {i / 10}) AS e{i}" for i in range(1, 10))
        parts.append(f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS e0, {inner}, CAST(max({c}) AS DOUBLE) AS e10 FROM bookings")
    return " UNION ALL ".join(parts)


def _bins_sql(source: str, keys: str) -> str:
    below = " + ".join(f"CAST(v > e{i} AS INTEGER)" for i in range(1, 10))
    numeric = " UNION ALL ".join(f"SELECT {keys}'{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {source}" for c in DRIFT_NUMERIC)
    names = "window_start, " if keys else ""
    rows = [f"SELECT {names}column_name, CASE WHEN v IS NULL THEN 'null' ELSE CAST({below} AS VARCHAR) END AS bin FROM ({numeric}) JOIN edges USING (column_name)"]
    rows += [f"SELECT {keys}'{c}' AS column_name, coalesce({c}, 'null') AS bin FROM {source}" for c in CATEGORICAL]
    return f"SELECT {names}column_name, bin, count(*) AS n FROM ({' UNION ALL '.join(rows)}) GROUP BY ALL"


MEASURES_SQL = """
shares AS (SELECT window_start, column_name, total, bin, n / total AS p, m / base_total AS q FROM grid),
floored AS (SELECT *, greatest(p, 1e-6) AS fp, greatest(q, 1e-6) AS fq FROM shares),
running AS (
  SELECT window_start, column_name, CAST(bin AS INTEGER) AS b,
    abs(sum(p - q) OVER (PARTITION BY window_start, column_name ORDER BY CAST(bin AS INTEGER))) AS gap
  FROM shares WHERE column_name IN ('lead_time', 'average_price') AND bin <> 'null'),
ordered AS (
  SELECT window_start, column_name, max(gap) AS ks, sum(gap * CASE b
    WHEN 0 THEN e1 - e0 WHEN 1 THEN e2 - e1 WHEN 2 THEN e3 - e2 WHEN 3 THEN e4 - e3 WHEN 4 THEN e5 - e4
    WHEN 5 THEN e6 - e5 WHEN 6 THEN e7 - e6 WHEN 7 THEN e8 - e7 WHEN 8 THEN e9 - e8 ELSE e10 - e9 END) AS wasserstein
  FROM running JOIN edges USING (column_name) GROUP BY 1, 2),
summed AS (
  SELECT window_start, column_name, CAST(max(total) AS BIGINT) AS total, sum((fp - fq) * ln(fp / fq)) AS psi,
    sum(abs(p - q)) / 2 AS total_variation,
    sum(fp * ln(fp / ((fp + fq) / 2)) / 2 + fq * ln(fq / ((fp + fq) / 2)) / 2) AS js_divergence,
    sum((p * total - fq * total) * (p * total - fq * total) / (fq * total)) AS chi_square,
    coalesce(max(p) FILTER (WHERE bin = 'null'), 0) - coalesce(max(q) FILTER (WHERE bin = 'null'), 0) AS null_rate_delta
  FROM floored WHERE p > 0 OR q > 0 GROUP BY 1, 2)
SELECT window_start, column_name, total, round(psi, 8) AS psi, round(total_variation, 8) AS total_variation,
  round(js_divergence, 8) AS js_divergence, round(chi_square, 3) AS chi_square, round(ks, 8) AS ks,
  round(wasserstein, 3) AS wasserstein, round(null_rate_delta, 8) AS null_rate_delta
FROM summed LEFT JOIN ordered USING (window_start, column_name)"""

DRIFT_BASE_SQL = f"""WITH {inputs.MONITORING_SQL},
edges AS ({_edges_sql()}),
cur AS ({_bins_sql('monitoring', ONE_DAY + ', ')}),
totals AS (SELECT window_start, column_name, sum(n) AS total FROM cur GROUP BY 1, 2),
number_bins AS (SELECT column_name, CAST(b AS VARCHAR) AS bin FROM edges, range(10) r(b))"""

BASELINE_SQL = f"""{DRIFT_BASE_SQL},
base AS ({_bins_sql('bookings', '')}),
base_totals AS (SELECT column_name, sum(n) AS base_total FROM base GROUP BY 1),
keys AS (
  SELECT window_start, column_name, bin FROM cur
  UNION SELECT window_start, column_name, bin FROM totals JOIN base USING (column_name)
  UNION SELECT window_start, column_name, bin FROM totals JOIN number_bins USING (column_name)),
grid AS (
  SELECT k.*, total, base_total, coalesce(c.n, 0) AS n, coalesce(b.n, 0) AS m
  FROM keys k JOIN totals USING (window_start, column_name) JOIN base_totals USING (column_name)
  LEFT JOIN cur c ON c.window_start = k.window_start AND c.column_name = k.column_name AND c.bin = k.bin
  LEFT JOIN base b ON b.column_name = k.column_name AND b.bin = k.bin),
{MEASURES_SQL}"""

PREVIOUS_SQL = f"""{DRIFT_BASE_SQL},
chain AS (
  SELECT *, lag(window_start) OVER (PARTITION BY column_name ORDER BY window_start) AS before_start,
    lag(total) OVER (PARTITION BY column_name ORDER BY window_start) AS base_total
  FROM totals),
keys AS (
  SELECT window_start, column_name, bin FROM cur
  UNION SELECT t.window_start, t.column_name, bin FROM chain t JOIN cur c ON c.window_start = before_start AND c.column_name = t.column_name
  UNION SELECT window_start, column_name, bin FROM totals JOIN number_bins USING (column_name)),
grid AS (
  SELECT k.*, total, base_total, coalesce(c.n, 0) AS n, coalesce(b.n, 0) AS m
  FROM keys k JOIN chain t USING (window_start, column_name)
  LEFT JOIN cur c ON c.window_start = k.window_start AND c.column_name = k.column_name AND c.bin = k.bin
  LEFT JOIN cur b ON b.window_start = before_start AND b.column_name = k.column_name AND b.bin = k.bin
  WHERE before_start IS NOT NULL),
{MEASURES_SQL}"""


def rounded_drift(df: DataFrame) -> DataFrame:
    fine = rounded(df, 8, "psi", "total_variation", "js_divergence", "ks", "null_rate_delta")
    return rounded(fine, 3, "chi_square", "wasserstein")


@query("monitoring_drift_baseline", BASELINE_SQL)
def monitoring_drift_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "1 day")
    baseline = inputs.bookings(spark, sf_dir)
    return rounded_drift(quality.drift_vs_baseline(monitoring(spark, sf_dir), keys, baseline, DRIFT_NUMERIC, CATEGORICAL))


@query("monitoring_drift_prev_window", PREVIOUS_SQL)
def monitoring_drift_prev_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.window_keys("request_time", "1 day")
    edges = quality.bin_edges(inputs.bookings(spark, sf_dir), DRIFT_NUMERIC)
    return rounded_drift(quality.drift_vs_previous(monitoring(spark, sf_dir), keys, "window_start", edges, CATEGORICAL))


def _values_sql(source: str, keys: str) -> str:
    names = "window_start, " if keys else ""
    longs = " UNION ALL ".join(f"SELECT {keys}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {source}" for c in DRIFT_NUMERIC)
    return f"SELECT {names}column_name, value, count(*) AS n FROM ({longs}) WHERE value IS NOT NULL GROUP BY ALL"


EXACT_DRIFT_SQL = f"""WITH {inputs.MONITORING_SQL},
now AS ({_values_sql('monitoring', ONE_DAY + ', ')}), base AS ({_values_sql('bookings', '')}),
windows AS (SELECT window_start, column_name, sum(n) AS total FROM now GROUP BY ALL),
sizes AS (SELECT column_name, sum(n) AS m FROM base GROUP BY ALL),
both_sides AS (
  SELECT window_start, column_name, value, sum(a) AS a, sum(b) AS b FROM (
    SELECT window_start, column_name, value, n AS a, 0 AS b FROM now
    UNION ALL SELECT window_start, column_name, value, 0, n FROM windows JOIN base USING (column_name)) GROUP BY ALL),
stepped AS (
  SELECT window_start, column_name, value, total,
    abs(sum(a) OVER w / total - sum(b) OVER w / m) AS gap, lead(value) OVER w AS following
  FROM both_sides JOIN windows USING (window_start, column_name) JOIN sizes USING (column_name)
  WINDOW w AS (PARTITION BY window_start, column_name ORDER BY value))
SELECT window_start, column_name, CAST(any_value(total) AS BIGINT) AS total, round(max(gap), 8) AS ks,
  round(coalesce(sum(gap * (following - value)), 0), 3) AS wasserstein FROM stepped GROUP BY 1, 2"""


@query("monitoring_drift_exact", EXACT_DRIFT_SQL)
def monitoring_drift_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS and Wasserstein distance of each day to the bookings, on values instead of bins."""
    keys = quality.window_keys("request_time", "1 day")
    # Calls, truth and baseline read the bookings; their joins run once.
    booked = materialize(inputs.bookings(spark, sf_dir), "bookings")
    found = quality.exact_distances(monitoring(spark, sf_dir, booked), keys, booked, DRIFT_NUMERIC)
    return rounded(rounded(found, 8, "ks"), 3, "wasserstein")


SKETCH_SQL = f"""WITH {inputs.BOOKINGS_SQL},
longs AS (SELECT 'lead_time' AS column_name, CAST(lead_time AS DOUBLE) AS v FROM bookings
  UNION ALL SELECT 'average_price', CAST(average_price AS DOUBLE) FROM bookings)
SELECT column_name, count(v) AS n, true AS ranks_within_1_percent FROM longs GROUP BY 1"""


@query("profile_sketch_ranks", SKETCH_SQL)
def profile_sketch_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quantiles of the sketches lie within 1 % of the rows of their exact ranks."""
    rows = inputs.bookings(spark, sf_dir)
    found = quality.sketched_quantiles(rows, {}, DRIFT_NUMERIC, quality.QUANTILES)
    counts = quality.number_counts(rows, {}, DRIFT_NUMERIC).join(found, "column_name")
    total, inside = F.sum("n"), []
    for i, q in enumerate(quality.QUANTILES):
        sketched = F.get(F.col("q"), F.lit(i))
        below = F.sum(F.when(F.col("value") < sketched, F.col("n")).otherwise(0))
        up_to = F.sum(F.when(F.col("value") <= sketched, F.col("n")).otherwise(0))
        inside.append((below <= (q + 0.01) * total) & (up_to >= (q - 0.01) * total))
    return counts.groupBy("column_name").agg(total.alias("n"), (inside[0] & inside[1] & inside[2]).alias("ranks_within_1_percent"))


@query(
    "endpoint_usage",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type AS endpoint, CAST(user_id AS VARCHAR) AS caller,
      count(*) AS requests, round(avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END), 6) AS error_share,
      CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens
    FROM events GROUP BY 1, 2, 3""",
)
def endpoint_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls over the latency bound of 100 count as failed ones."""
    log = inputs.table(spark, sf_dir, "events").select(
        F.col("ts").alias("request_time"), F.col("event_type").alias("endpoint"),
        F.col("user_id").cast("string").alias("caller"),
        F.when(F.col("value") > 100, 504).otherwise(200).alias("status_code"),
        F.get_json_object("props", "$.k").try_cast("long").alias("tokens"),
    )
    return rounded(usage.endpoint_usage(log), 6, "error_share")
