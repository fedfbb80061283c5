"""From raw documents to token ids: toxicity, near duplicates, shared passages, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
docs, and the mix adds mix_copy, the number of a document's copy. Rows pass in any number and with any further columns; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import jaccard_join, mixing, pieces, substring_dedup, toxicity
from tidewheel.llm.common import materialize, row_marks, table, where_marked
from tidewheel.llm.queries import tokenizer_path

COPY = "mix_copy"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3."""
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, weights)
    return scored.where("score < 0.3").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles at 0.8 or more, one with the smallest id.

    Rows are numbered first, so that repeated rows and rows without an id are told apart.
    """
    numbered = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    ids = numbered.select("__row", "doc_id")
    rows = numbered.select(F.col("__row").alias("doc_id"), "text")
    classes = jaccard_join.row_classes(rows, size=5, percent=80).withColumnRenamed("doc_id", "__row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"].alias("__row")
    kept = classes.join(ids, "__row").groupBy("component_id").agg(first).select("__row")
    return where_marked(numbered, "__row", row_marks(kept, "__row")).select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur again."""
    cut = substring_dedup.dedup_substrings(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, copy=COPY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix."""
    copy = [COPY] if COPY in docs.columns else []
    texts = docs.select("doc_id", "source", "text", *copy)
    coded = pieces.encode_documents(texts, tokenizer_path("piece_bpe_32k.model"), copy=COPY if copy else None)
    return coded.select("row.doc_id", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", one_of_each), ("substring_dedup", cut_passages),
    ("mix", mix_sources), ("encode", encode),
]
#: Training, set joins and merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
