"""Billing and endpoint usage rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import text


def distinct_skus(usage: DataFrame, products: list[str]) -> DataFrame:
    """Distinct product, region-free SKU and unit of the given products, sorted."""
    rows = usage.where(F.col("billing_origin_product").isin(products)).select(
        "billing_origin_product", text.strip_region(F.col("sku_name")).alias("sku_name"), "usage_unit"
    )
    return rows.distinct().orderBy("billing_origin_product", "sku_name", "usage_unit")


def cost_rollup(usage: DataFrame, totals: bool = True, policy: Column | None = None) -> DataFrame:
    """Quantity by product, region-free SKU and unit, with subtotals per product and overall."""
    rows = usage if policy is None else usage.where(policy)
    rows = rows.select(
        F.col("billing_origin_product").alias("product"),
        text.strip_region(F.col("sku_name")).alias("sku"), F.col("usage_unit").alias("unit"), "usage_quantity",
    )
    # Sum the leaves first: the subtotals are then built from a small table.
    leaves = rows.groupBy("product", "sku", "unit").agg(
        F.sum("usage_quantity").alias("quantity"), F.count(F.lit(1)).alias("records")
    )
    if not totals:
        return leaves
    return leaves.rollup("product", "sku", "unit").agg(
        F.sum("quantity").alias("quantity"), F.sum("records").alias("records"), F.grouping_id().alias("level")
    )


def endpoint_usage(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """Requests, error share and tokens per window, endpoint and caller."""
    failed = (F.col("status_code") >= 400).cast("int")
    return log.groupBy(F.window("request_time", width)["start"].alias("window_start"), "endpoint", "caller").agg(
        F.count(F.lit(1)).alias("requests"), F.avg(failed).alias("error_share"), F.sum("tokens").alias("tokens")
    )
