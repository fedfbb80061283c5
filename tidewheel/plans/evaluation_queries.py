"""Scoring of responses, score write-back, samples, judge agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import text
from tidewheel.operators import evaluation
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query
from tidewheel.plans.monitoring_queries import rounded

WORDS_SQL = f"len(regexp_extract_all(text, '[^{inputs.SQL_SPACE}]+'))"


@query("word_count_eval", f"SELECT doc_id, CAST({WORDS_SQL} AS INTEGER) AS words, {WORDS_SQL} < 350 AS within_limit FROM documents")
def word_count_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", text.word_count(F.col("text")).alias("words"), text.within_word_limit(F.col("text")).alias("within_limit")
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback so far: one human verdict per labelled document and name."""
    labels = inputs.table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    pairs = F.array(
        F.struct(F.lit("word_count_check").alias("name"), F.when(F.col("quality") == 1, "true").otherwise("false").alias("value")),
        F.struct(F.lit("polite_tone").alias("name"), F.when(F.col("toxic") == 0, "Pass").otherwise("Fail").alias("value")),
    )
    return labels.select(F.concat(F.lit("tr-"), F.col("doc_id").cast("string")).alias("trace_id"), F.inline(pairs))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents").select(F.concat(F.lit("tr-"), F.col("doc_id").cast("string")).alias("trace_id"), "text")
    return evaluation.score(docs, "trace_id", "text")


MERGED_SQL = f"""
label_rows AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
merged AS (
  SELECT 'tr-' || doc_id AS trace_id, 'word_count_check' AS name, CAST({WORDS_SQL} < 350 AS VARCHAR) AS value FROM documents
  UNION ALL SELECT 'tr-' || doc_id, 'polite_tone', CASE WHEN toxic = 0 THEN 'Pass' ELSE 'Fail' END FROM label_rows
  UNION ALL SELECT 'tr-' || doc_id, 'word_count_check', CASE WHEN quality = 1 THEN 'true' ELSE 'false' END
  FROM label_rows WHERE doc_id NOT IN (SELECT doc_id FROM documents))"""


@query("score_write_back", f"WITH {MERGED_SQL} SELECT * FROM merged")
def score_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New scores replace older feedback of the same trace and scorer."""
    return evaluation.write_back(feedback(spark, sf_dir), scores(spark, sf_dir))


@query(
    "scorer_summary",
    f"""WITH {MERGED_SQL} SELECT name, count(*) AS rows, CAST(sum((value IN ('true', 'Pass'))::INTEGER) AS BIGINT) AS passed,
      round(avg((value IN ('true', 'Pass'))::INTEGER), 6) AS mean_verdict FROM merged GROUP BY name""",
)
def scorer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.summary(evaluation.write_back(feedback(spark, sf_dir), scores(spark, sf_dir))), 6, "mean_verdict")


@query(
    "eval_sample",
    """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR))) AS p, count(*) OVER () AS n FROM documents)
    WHERE p <= greatest(1, n * 10 // 100)""",
)
def eval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.sampled_for_costly_scorers(inputs.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


PAIRS_SQL = f"""
pairs AS (
  SELECT CAST({WORDS_SQL} < 350 AS INTEGER) AS judge, quality AS human
  FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id))"""


def verdict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    human = inputs.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("human"))
    judge = inputs.table(spark, sf_dir, "documents").select("doc_id", text.within_word_limit(F.col("text")).cast("int").alias("judge"))
    return evaluation.attach(judge, human, "doc_id")


@query(
    "judge_agreement",
    f"""WITH {PAIRS_SQL},
    c AS (
      SELECT count(*) FILTER (WHERE judge = 1 AND human = 1) AS both_pass, count(*) FILTER (WHERE judge = 1 AND human = 0) AS judge_only,
        count(*) FILTER (WHERE judge = 0 AND human = 1) AS human_only, count(*) FILTER (WHERE judge = 0 AND human = 0) AS both_fail, count(*) AS n
      FROM pairs WHERE judge IS NOT NULL AND human IS NOT NULL),
    e AS (SELECT *, ((both_pass + judge_only) * (both_pass + human_only) + (both_fail + human_only) * (both_fail + judge_only)) / (n * n) AS pe,
      (both_pass + both_fail) / n AS po FROM c)
    SELECT both_pass, judge_only, human_only, both_fail, n, round(po, 6) AS agreement,
      round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 6) AS kappa FROM e""",
)
def judge_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.agreement(verdict_pairs(spark, sf_dir)), 6, "agreement", "kappa")


@query("judge_confusion", f"WITH {PAIRS_SQL} SELECT judge, human, count(*) AS n FROM pairs GROUP BY 1, 2")
def judge_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(verdict_pairs(spark, sf_dir))


@query("judged_by_both", "SELECT 'tr-' || event_id AS trace_id FROM events WHERE event_id IN (SELECT doc_id FROM labels)")
def judged_by_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces holding a judge's and a human's verdict, both under one name."""
    log = inputs.trace_log(spark, sf_dir)
    same = F.transform("assessments", lambda a: F.struct(F.lit("quality").alias("name"), a["feedback"].alias("feedback"), a["source"].alias("source")))
    return evaluation.judged_by_both(log.withColumn("assessments", same), "quality").select("trace_id")
