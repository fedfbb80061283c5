"""Papers, parsed documents and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates
from tidewheel.operators import chunks, tracking, vectors
from tidewheel.plans import inputs
from tidewheel.plans.catalogue import query

S = inputs.SQL_SPACE
BLOCKS_SQL = """
lines AS (
  SELECT doc_id, paper_id, processed, list_filter(string_split(text, chr(10)), lambda l: len(trim(l, ' ')) > 0) AS blocks FROM papers),
elements AS (
  SELECT doc_id, paper_id, processed, unnest(range(0, len(blocks))) AS n, unnest(blocks) AS content FROM lines)"""


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.document_files(spark, sf_dir)
    return chunks.parse_documents(files, F.col("text"), F.col("processed"))


@query(
    "document_elements",
    f"""WITH {inputs.PAPERS_SQL}, {BLOCKS_SQL}
    SELECT '/volume/' || processed || '/' || paper_id || '.pdf' AS path, CAST(n AS VARCHAR) AS id,
      CASE WHEN starts_with(content, '# ') THEN 'section_header' ELSE 'text' END AS type,
      regexp_replace(content, '^# ', '') AS content FROM elements""",
)
def document_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text documents split into typed blocks, written as JSON and read back."""
    return chunks.element_rows(parsed_documents(spark, sf_dir))


@query(
    "page_elements",
    r"""WITH marked AS (
      SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '\s*\n\s*', ' ', 'g'),
        '(?i)<(title|h[1-6])(\s[^>]*)?>', chr(10) || '# ', 'g'),
        '(?i)</?(p|div|li|ul|ol|nav|section|article|header|footer|main|body|head|html|table|tr|td|th|title|h[1-6]|br|pre|blockquote|form)(\s[^>]*)?/?>', chr(10), 'g'),
        '(?s)<[^>]*>', '', 'g') AS body FROM pages),
    decoded AS (
      SELECT page_id, replace(replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS body
      FROM marked),
    blocks AS (
      SELECT page_id, list_filter(list_transform(string_split(body, chr(10)), lambda b: trim(regexp_replace(b, '[ \t]+', ' ', 'g'), ' ')),
        lambda b: len(b) > 0 AND b <> '#') AS blocks FROM decoded),
    elements AS (SELECT page_id, unnest(range(0, len(blocks))) AS n, unnest(blocks) AS content FROM blocks)
    SELECT '/pages/' || page_id || '.html' AS path, CAST(n AS VARCHAR) AS id,
      CASE WHEN starts_with(content, '# ') THEN 'section_header' ELSE 'text' END AS type,
      regexp_replace(content, '^# ', '') AS content FROM elements""",
)
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages split into typed blocks."""
    pages = inputs.table(spark, sf_dir, "pages")
    files = pages.select(F.concat(F.lit("/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), "html")
    return chunks.element_rows(chunks.parse_documents(files, F.col("html"), F.lit(0), html=True))


CHUNKS_SQL = rf"""
chunks AS (
  SELECT e.paper_id, CAST(n AS VARCHAR) AS chunk_id,
    trim(regexp_replace(regexp_replace(regexp_replace(content, '([\p{{L}}\p{{N}}_])-[{S}]*\n[{S}]*([\p{{L}}\p{{N}}_])', '\1\2', 'g'),
      '[{S}]*\n[{S}]*', ' ', 'g'), '[{S}]+', ' ', 'g'), ' ') AS text,
    e.paper_id || '_' || n AS id, title, summary, authors, CAST(year(published_at) AS INTEGER) AS year,
    CAST(month(published_at) AS INTEGER) AS month, CAST(day(published_at) AS INTEGER) AS day, e.processed
  FROM elements e JOIN papers USING (doc_id) WHERE NOT starts_with(content, '# '))"""


@query("chunk_table", f"WITH {inputs.PAPERS_SQL}, {BLOCKS_SQL}, {CHUNKS_SQL} SELECT * EXCLUDE (processed) FROM chunks")
def chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of all batches."""
    return chunks.chunk_table(parsed_documents(spark, sf_dir), inputs.papers(spark, sf_dir))


@query(
    "chunk_table_newest_batch",
    f"""WITH {inputs.PAPERS_SQL}, {BLOCKS_SQL}, {CHUNKS_SQL} SELECT * EXCLUDE (processed) FROM chunks
    WHERE processed = (SELECT max(processed) FROM papers)""",
)
def chunk_table_newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the newest batch only: the incremental run."""
    papers = inputs.papers(spark, sf_dir)
    newest = papers.agg(F.max("processed")).first()[0]
    return chunks.chunk_table(parsed_documents(spark, sf_dir), papers, newest)


@query(
    "packed_time_parts",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d%H%M') AS BIGINT) AS packed, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders""",
)
def packed_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", dates.pack_minute(F.col("o_orderdate")).alias("packed"))
    return orders.select("o_orderkey", "packed", *[c.alias(n) for n, c in dates.packed_parts(F.col("packed")).items()])


LAST_TEN_SQL = f"WITH {inputs.PAPERS_SQL}, newest AS (SELECT * FROM papers ORDER BY published DESC, paper_id LIMIT 10)"


@query("last_k_papers", f"{LAST_TEN_SQL} SELECT paper_id, title, published FROM newest")
def last_k_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.last_k_papers(inputs.papers(spark, sf_dir)).select("paper_id", "title", "published")


@query("last_k_papers_authors", f"{LAST_TEN_SQL} SELECT DISTINCT unnest(string_split(authors, ', ')) AS author FROM newest")
def last_k_papers_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.authors_of(tracking.last_k_papers(inputs.papers(spark, sf_dir)))


@query("text_embeddings")
def text_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit vectors of all documents over hashed terms (hash and IDF have no SQL twin)."""
    return vectors.embed_text(inputs.table(spark, sf_dir, "documents"), "doc_id", "text")
