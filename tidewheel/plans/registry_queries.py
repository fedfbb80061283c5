"""Runs, metrics, versions and billing usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import tracking, usage
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.plans.monitoring_queries import rounded


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs."""
    status = F.col("o_orderstatus")
    named = F.when(status == "F", "FINISHED").when(status == "O", "RUNNING").otherwise("FAILED")
    pending = F.when(status == "P", F.lit(None).cast("string")).otherwise(F.col("o_orderkey").cast("string"))
    return inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("parent_id"),
        F.concat(F.lit("run "), F.col("o_orderpriority")).alias("run_name"), named.alias("status"),
        F.col("o_orderdate").alias("start_time"), F.col("o_totalprice").alias("price_param"),
        tracking.provenance_tags(F.lower("o_orderpriority"), F.lit("main"), pending).alias("tags"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as step metrics of their run."""
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.concat(F.lit("metric_"), F.col("l_returnflag")).alias("key"),
        F.col("l_linenumber").alias("step"), F.col("l_extendedprice").alias("value"),
    )


LAST_SQL = """
last AS (
  SELECT l_orderkey AS run_id, 'metric_' || l_returnflag AS key, max((l_linenumber, l_extendedprice))[2] AS last_value,
    min(l_extendedprice) AS best_value, max(l_linenumber) AS max_step, count(*) AS n_points FROM lineitem GROUP BY 1, 2)"""


@query("metric_last_best", f"WITH {LAST_SQL} SELECT last.*, o_totalprice AS price_param FROM last LEFT JOIN orders ON o_orderkey = run_id")
def metric_last_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.with_params(tracking.last_metric(metrics(spark, sf_dir)), runs(spark, sf_dir), ["price_param"])


@query(
    "metric_best_child",
    f"""WITH {LAST_SQL}, joined AS (SELECT o_custkey AS parent_id, run_id, last_value FROM last JOIN orders ON o_orderkey = run_id WHERE key = 'metric_A')
    SELECT parent_id, min((last_value, run_id))[2] AS best_run, min(last_value) AS best_value, count(*) AS children FROM joined GROUP BY 1""",
)
def metric_best_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.best_child(metrics(spark, sf_dir), runs(spark, sf_dir), "metric_A")


@query(
    "run_search",
    f"""WITH {LAST_SQL}
    SELECT o_orderkey AS run_id, o_custkey AS parent_id, o_orderdate AS start_time, last_value AS "metric_A"
    FROM orders JOIN last ON run_id = o_orderkey
    WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1997-01-01' AND 'run ' || o_orderpriority LIKE 'run 1-%' AND key = 'metric_A' AND last_value < 50000""",
)
def run_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    found = tracking.search_runs(runs(spark, sf_dir), metrics(spark, sf_dir), "FINISHED", after, "run 1-%", "metric_A", 50000)
    return found.select("run_id", "parent_id", "start_time", "metric_A")


@query(
    "run_tags",
    """SELECT o_orderkey AS run_id, lower(o_orderpriority) AS git_sha, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS n_tags
    FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def run_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs found by a tag; a run without id carries no such tag."""
    found = tracking.by_tag(runs(spark, sf_dir), "git_sha", "1-urgent")
    return found.select("run_id", F.try_element_at("tags", F.lit("git_sha")).alias("git_sha"), F.size("tags").alias("n_tags"))


@query(
    "latest_alias",
    """SELECT o_orderpriority AS name, o_orderstatus AS alias, max(o_orderkey) AS version, arg_max(o_custkey, o_orderkey) AS run_id
    FROM orders GROUP BY 1, 2""",
)
def latest_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("alias"),
        F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("run_id"),
    )
    return tracking.latest_version(registry)


# --- billing usage -------------------------------------------------------------------------


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as usage records: brand as product, type and region as SKU."""
    region = F.when(F.col("l_returnflag") == "A", "US_EAST").when(F.col("l_returnflag") == "N", "EU_WEST").otherwise("US_WEST_2")
    items = inputs.table(spark, sf_dir, "lineitem")
    parts = inputs.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    return joined.select(
        F.col("p_brand").alias("billing_origin_product"), F.concat_ws("_", "p_type", region).alias("sku_name"),
        F.col("l_linestatus").alias("usage_unit"), F.col("l_quantity").alias("usage_quantity"),
    )


PRODUCTS = ["Brand#1", "Brand#2", "Brand#3", "Brand#10", "Brand#17", "Brand#25"]


@query(
    "cost_distinct_skus",
    f"""SELECT DISTINCT p_brand AS billing_origin_product, p_type AS sku_name, l_linestatus AS usage_unit
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN ({', '.join(repr(p) for p in PRODUCTS)})""",
)
def cost_distinct_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.distinct_skus(billing(spark, sf_dir), PRODUCTS)


@query(
    "cost_by_sku",
    """SELECT p_brand AS product, p_type AS sku, l_linestatus AS unit, round(sum(l_quantity), 2) AS quantity, count(*) AS records,
      grouping(p_brand, p_type, l_linestatus) AS level
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_brand, p_type, l_linestatus)""",
)
def cost_by_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(usage.cost_rollup(billing(spark, sf_dir)), 2, "quantity")
