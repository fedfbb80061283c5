"""Vector, lexical and hybrid search over whole tables, for the whole set of search items.

The vector of search item i is the given vector of number i; document i is vector i's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import lexical, vector_index, vectors
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query


def corpus_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"))
    known = inputs.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return items.join(known, "query_id")


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def nearest_sql(k: int, name: str = "knn", condition: str = "") -> str:
    return f"""
{name}_scored AS (
  SELECT item_id AS query_id, c.vec_id AS id,
    round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS score
  FROM benchmark JOIN embeddings q ON q.vec_id = item_id CROSS JOIN embeddings c {condition}),
{name} AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM {name}_scored)
  WHERE rank <= {k})"""


@query("knn_cosine", f"WITH {nearest_sql(5)} SELECT * FROM knn")
def knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k_similar(corpus_vectors(spark, sf_dir), query_vectors(spark, sf_dir), 5)


@query("knn_filtered", f"WITH {nearest_sql(5, 'knn', 'JOIN documents d ON d.doc_id = c.vec_id AND lang = ' + chr(39) + 'en' + chr(39))} SELECT * FROM knn")
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only vectors of English documents take part in the ranking."""
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    corpus = vectors.metadata_filter(corpus_vectors(spark, sf_dir).join(docs, "id"), F.col("lang") == "en")
    return vectors.top_k_similar(corpus, query_vectors(spark, sf_dir), 5)


@query("knn_cells", f"WITH {nearest_sql(5)} SELECT * FROM knn")
def knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search through balls, the way taken for more queries than fit one batch."""
    return vectors.top_k_similar(corpus_vectors(spark, sf_dir), query_vectors(spark, sf_dir), 5, query_batch=0)


def approximate(spark: SparkSession, sf_dir: str, k: int) -> tuple[DataFrame, DataFrame]:
    index = vector_index.build(corpus_vectors(spark, sf_dir), parts=vector_index.PARTS)
    return vector_index.approximate_top_k(index, query_vectors(spark, sf_dir), k)


@query("knn_lsh")
def knn_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate search: an inverted file with coded residuals."""
    return approximate(spark, sf_dir, 5)[0]


KNOWN_QUERIES = "(SELECT count(*) FROM benchmark JOIN embeddings ON vec_id = item_id)"


@query("knn_lsh_quality", f"SELECT {KNOWN_QUERIES} AS queries, true AS recall_at_least_90, true AS candidates_below_10")
def knn_lsh_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate search finds 90 % of the exact five, scoring less than 10 % of all pairs."""
    near, effort = approximate(spark, sf_dir, 5)
    exact = knn_cosine(spark, sf_dir)
    hits = exact.join(near.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    missing = F.lit(None).cast("double")
    recall = hits.agg((F.count("hit") / F.count(F.lit(1))).alias("recall")).select(
        F.lit(None).cast("long").alias("queries"), "recall", missing.alias("share")
    )
    share = effort.agg(F.count(F.lit(1)).alias("queries"), (F.sum("candidates") / F.sum("vectors")).alias("share"))
    both = recall.unionByName(share.withColumn("recall", missing)).agg(F.max("queries"), F.max("recall"), F.max("share"))
    return both.toDF("queries", "recall", "share").select(
        "queries", (F.col("recall") >= 0.9).alias("recall_at_least_90"), (F.col("share") < 0.1).alias("candidates_below_10")
    )


@query("knn_cells_visits")
def knn_cells_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many balls and vectors the exact search looked at for each query."""
    index = vector_index.build(corpus_vectors(spark, sf_dir))
    effort = vector_index.exact_top_k(index, query_vectors(spark, sf_dir), 5)[1]
    return effort.withColumn("share", F.round(F.col("compared") / F.col("vectors"), 6))


TOKEN = r"[\p{L}\p{N}]+"


def bm25_sql(k: int) -> str:
    return rf"""
doc_tokens AS MATERIALIZED (SELECT doc_id AS id, regexp_extract_all(lower(text), '{TOKEN}') AS tokens FROM documents),
sizes AS (SELECT count(*) AS docs, avg(len(tokens)) AS mean FROM doc_tokens),
wanted AS MATERIALIZED (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM benchmark),
tf AS MATERIALIZED (
  SELECT id, length, term, count(*) AS tf FROM (SELECT id, len(tokens) AS length, unnest(tokens) AS term FROM doc_tokens)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
idf AS (SELECT term, ln(1 + (any_value(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, sizes GROUP BY term),
bm25_scored AS (
  SELECT query_id, id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM tf JOIN wanted USING (term) JOIN idf USING (term), sizes GROUP BY query_id, id),
bm25 AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM bm25_scored)
  WHERE rank <= {k})"""


@query("bm25_topk", f"WITH {bm25_sql(10)} SELECT * FROM bm25")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.bm25(doc_texts(spark, sf_dir), query_texts(spark, sf_dir), 10)


@query("bm25_term_join", f"WITH {bm25_sql(10)} SELECT * FROM bm25")
def bm25_term_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by the term join, the way taken for more queries than fit one batch."""
    return lexical.bm25(doc_texts(spark, sf_dir), query_texts(spark, sf_dir), 10, scan_terms=0)


NULLED_SQL = "FROM (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text END AS text FROM documents)"


@query("bm25_null_texts", f"WITH {bm25_sql(10).replace('FROM documents', NULLED_SQL)} SELECT * FROM bm25")
def bm25_null_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan over a corpus in which every third text is null."""
    docs = doc_texts(spark, sf_dir).withColumn("text", F.when(F.col("id") % 3 != 0, F.col("text")))
    return lexical.bm25(docs, query_texts(spark, sf_dir), 10)


DEPTH = 50


def hybrid_sql(k: int) -> str:
    return f"""{bm25_sql(DEPTH)}, {nearest_sql(DEPTH)},
fused AS (
  SELECT query_id, id, round(coalesce(1.0 / (60 + a.rank), 0.0) + coalesce(1.0 / (60 + b.rank), 0.0), 9)::DOUBLE AS score,
    a.rank AS rank_a, b.rank AS rank_b
  FROM bm25 a FULL JOIN knn b USING (query_id, id)),
hybrid AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM fused)
  WHERE rank <= {k})"""


def hybrid(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    words = lexical.bm25(doc_texts(spark, sf_dir), query_texts(spark, sf_dir), DEPTH)
    near = vectors.top_k_similar(corpus_vectors(spark, sf_dir), query_vectors(spark, sf_dir), DEPTH)
    return lexical.fuse(words, near, k)


@query("hybrid_rrf", f"WITH {hybrid_sql(10)} SELECT query_id, id, rank_a, rank_b, score, rank FROM hybrid")
def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid(spark, sf_dir, 10)


def _overlap_sql(column: str) -> str:
    return f"len(list_intersect(q.terms, regexp_extract_all(lower({column}), '{TOKEN}'))) / len(q.terms)"


@query(
    "rerank_overlap",
    f"""WITH {inputs.PAPERS_SQL}, {hybrid_sql(20)},
    q AS (SELECT item_id AS query_id, list_distinct(regexp_extract_all(lower(text), '{TOKEN}')) AS terms FROM benchmark),
    scored AS (
      SELECT h.query_id, h.id, h.rank AS first_rank, round(coalesce(0.6 * {_overlap_sql('p.text')} + 0.3 * {_overlap_sql('p.title')}
        + 0.1 * {_overlap_sql('p.summary')}, 0), 6) AS score
      FROM hybrid h JOIN papers p ON p.doc_id = h.id JOIN q ON q.query_id = h.query_id)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_rank) AS INTEGER) AS rank FROM scored)
    WHERE rank <= 5""",
)
def rerank_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.papers(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "title", "summary")
    return lexical.rerank(hybrid(spark, sf_dir, 20), query_texts(spark, sf_dir), docs, 5)


@query(
    "index_refresh",
    """SELECT vec_id AS id, CASE WHEN label = 3 THEN list_transform(embedding, lambda x: CAST(-x AS FLOAT)) ELSE embedding END AS vector
    FROM embeddings WHERE label <> 7""",
)
def index_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index kept in step with its source: one label changed, one deleted, the rest untouched."""
    rows = inputs.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    flipped = F.transform("embedding", lambda x: -x)
    after = rows.where("label <> 7").select("id", F.when(F.col("label") == 3, flipped).otherwise(F.col("embedding")).alias("embedding"))
    before = rows.select("id", "embedding")

    def embed(df: DataFrame) -> DataFrame:
        return df.select("id", F.col("embedding").alias("vector"))

    return vectors.refresh_index(embed(before), before, after, "id", embed)
