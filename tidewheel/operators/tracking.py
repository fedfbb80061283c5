"""Run, metric and version tables: search, step series, aliases, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import nested


def search_runs(
    runs: DataFrame, metrics: DataFrame, status: str, started_after, name_like: str, metric: str, below: float
) -> DataFrame:
    """Finished runs by name pattern and start time whose metric is under a bound, newest first."""
    picked = runs.where(
        (F.col("status") == status) & (F.col("start_time") > started_after) & F.col("run_name").like(name_like)
    )
    last = last_metric(metrics.where(F.col("key") == metric)).where(F.col("last_value") < below)
    found = picked.join(last.select("run_id", F.col("last_value").alias(metric)), "run_id")
    return found.orderBy(F.col("start_time").desc(), F.col("run_id"))


def by_tag(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.where(nested.tag_equals(F.col("tags"), key, value))


def provenance_tags(git_sha: Column, branch: Column, run_id: Column) -> Column:
    """Tag map of a run; entries without a value are left out."""
    full = F.create_map(F.lit("git_sha"), git_sha, F.lit("branch"), branch, F.lit("run_id"), run_id)
    return nested.drop_null_tags(full)


def last_metric(metrics: DataFrame) -> DataFrame:
    """Last, best (smallest) and highest step per run and key; ties at a step: larger value."""
    return metrics.groupBy("run_id", "key").agg(
        F.max_by("value", F.struct("step", "value")).alias("last_value"),
        F.min("value").alias("best_value"),
        F.max("step").alias("max_step"),
        F.count(F.lit(1)).alias("n_points"),
    )


def with_params(metrics: DataFrame, runs: DataFrame, params: list[str]) -> DataFrame:
    return metrics.join(runs.select("run_id", *params), "run_id", "left")


def best_child(metrics: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """Best nested run of each parent by the smallest last value; ties: smallest run id."""
    last = last_metric(metrics.where(F.col("key") == key)).select("run_id", "last_value")
    joined = runs.select("run_id", "parent_id").join(last, "run_id")
    best = F.min(F.struct("last_value", "run_id"))
    return joined.groupBy("parent_id").agg(
        best["run_id"].alias("best_run"), best["last_value"].alias("best_value"), F.count(F.lit(1)).alias("children")
    )


def latest_version(registry: DataFrame) -> DataFrame:
    """Newest version per name and alias, with its run; an aggregate, so no per-name sort."""
    newest = F.max(F.struct("version", "run_id"))
    return registry.groupBy("name", "alias").agg(
        newest["version"].alias("version"), newest["run_id"].alias("run_id")
    )


def last_k_papers(papers: DataFrame, k: int = 10) -> DataFrame:
    return papers.orderBy(F.col("published").desc(), F.col("paper_id")).limit(k)


def authors_of(papers: DataFrame) -> DataFrame:
    return nested.one_row_each(papers.select("authors"), "authors", "author").select("author").distinct()
