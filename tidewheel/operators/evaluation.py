"""Deterministic scoring of responses, write-back of scores, summaries, judge agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import text
from tidewheel.operators import sampling
from tidewheel.sources import changes


def score(responses: DataFrame, key: str, column: str, scorers: dict[str, Column] | None = None) -> DataFrame:
    """Long feedback rows (key, name, value) for every response and scorer, values as text."""
    rules = scorers or {"word_count_check": text.within_word_limit(F.col(column))}
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in rules.items()])
    return responses.select(key, F.inline(pairs))


def sampled_for_costly_scorers(responses: DataFrame, key: str, percent: int = 10) -> DataFrame:
    return sampling.sample_share(responses, F.col(key), percent)


def write_back(feedback: DataFrame, scores: DataFrame, key: str = "trace_id") -> DataFrame:
    """Feedback table with the new scores merged in, one row per key and scorer."""
    return changes.upsert(feedback, scores.select(*feedback.columns), [key, "name"])


def attach(traces: DataFrame, feedback: DataFrame, key: str = "trace_id") -> DataFrame:
    """Traces with their feedback, joined by key and not by position."""
    return traces.join(feedback, key, "left")


def summary(feedback: DataFrame) -> DataFrame:
    """Rows, passes and mean verdict per scorer; null verdicts do not count."""
    passed = F.when(F.col("value").isNotNull(), F.col("value").isin("true", "Pass").cast("int"))
    return feedback.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(passed).alias("passed"), F.avg(passed).alias("mean_verdict")
    )


def confusion(pairs: DataFrame, judge: str = "judge", human: str = "human") -> DataFrame:
    """Counts of judge × human verdicts."""
    return pairs.groupBy(judge, human).agg(F.count(F.lit(1)).alias("n"))


def agreement(pairs: DataFrame, judge: str = "judge", human: str = "human") -> DataFrame:
    """Confusion counts, agreement rate and Cohen's kappa of two 0/1 verdicts, in one pass.

    Rows lacking either verdict are left out. Kappa is null when chance agreement is 1.
    """
    both = pairs.where(F.col(judge).isNotNull() & F.col(human).isNotNull())

    def cell(j: int, h: int) -> Column:
        return F.count_if((F.col(judge) == j) & (F.col(human) == h))

    counts = both.agg(
        cell(1, 1).alias("both_pass"), cell(1, 0).alias("judge_only"),
        cell(0, 1).alias("human_only"), cell(0, 0).alias("both_fail"),
    )
    n = F.col("both_pass") + F.col("judge_only") + F.col("human_only") + F.col("both_fail")
    observed = F.try_divide(F.col("both_pass") + F.col("both_fail"), n)
    judge_pass, human_pass = F.col("both_pass") + F.col("judge_only"), F.col("both_pass") + F.col("human_only")
    chance = F.try_divide(judge_pass * human_pass + (n - judge_pass) * (n - human_pass), n * n)
    rated = counts.withColumns({"n": n, "agreement": observed, "_chance": chance})
    kappa = F.when(F.col("_chance") < 1, (F.col("agreement") - F.col("_chance")) / (1 - F.col("_chance")))
    return rated.withColumn("kappa", kappa).drop("_chance")


def judged_by_both(traces: DataFrame, name: str) -> DataFrame:
    """Traces whose assessments of that name come from a judge and from a human."""
    def from_source(kind: str) -> Column:
        return F.coalesce(
            F.exists("assessments", lambda a: (a["name"] == name) & (a["source"] == kind)), F.lit(False)
        )

    return traces.where(from_source("LLM_JUDGE") & from_source("HUMAN"))
