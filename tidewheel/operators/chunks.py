"""Documents to elements JSON, elements to a cleaned chunk table with metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import dates, nested, text

# The parsed-document contract.
PARSED_SCHEMA = "struct<document: struct<elements: array<struct<id: string, type: string, content: string>>>>"
TEXT_TYPE = "text"

SCRIPT_OR_STYLE = r"(?is)<(script|style)[^>]*>.*?</(script|style)>"
TITLE_OR_HEADING_OPEN = r"(?i)<(title|h[1-6])(\s[^>]*)?>"
BLOCK_TAG = r"(?i)</?(p|div|li|ul|ol|nav|section|article|header|footer|main|body|head|html|table|tr|td|th|title|h[1-6]|br|pre|blockquote|form)(\s[^>]*)?/?>"
ANY_TAG = r"(?s)<[^>]*>"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def elements_json(blocks: Column) -> Column:
    """Blocks as document JSON; a block marked as heading becomes a section header element."""
    elements = F.transform(
        blocks,
        lambda block, i: F.struct(
            i.cast("string").alias("id"),
            F.when(block.startswith("# "), "section_header").otherwise(TEXT_TYPE).alias("type"),
            F.regexp_replace(block, "^# ", "").alias("content"),
        ),
    )
    return F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document")))


def text_blocks(body: Column) -> Column:
    """Non-blank lines of a plain text."""
    lines = F.split(body, "\n")
    return F.filter(lines, lambda line: F.length(F.trim(line)) > 0)


def html_blocks(html: Column) -> Column:
    """Block texts of a web page: scripts dropped, block tags end a block, headings marked."""
    body = F.regexp_replace(html, SCRIPT_OR_STYLE, " ")
    body = F.regexp_replace(body, r"\s*\n\s*", " ")
    body = F.regexp_replace(body, TITLE_OR_HEADING_OPEN, "\n# ")
    body = F.regexp_replace(body, BLOCK_TAG, "\n")
    body = F.regexp_replace(body, ANY_TAG, "")
    for entity, sign in ENTITIES.items():
        body = F.replace(body, F.lit(entity), F.lit(sign))
    blocks = F.transform(F.split(body, "\n"), lambda b: F.trim(F.regexp_replace(b, r"[ \t]+", " ")))
    return F.filter(blocks, lambda b: (F.length(b) > 0) & (b != "#"))


def parse_documents(files: DataFrame, content: Column, processed: Column, html: bool = False) -> DataFrame:
    """path, parsed_content (JSON), processed — one row per file."""
    blocks = html_blocks(content) if html else text_blocks(content)
    return files.select("path", elements_json(blocks).alias("parsed_content"), processed.cast("long").alias("processed"))


def element_rows(parsed: DataFrame) -> DataFrame:
    """path, id, type, content — one row per element of the parsed documents."""
    elements = F.from_json("parsed_content", PARSED_SCHEMA)["document"]["elements"]
    return nested.one_row_each(parsed.select("path", elements.alias("_e")), "_e", "element").select("path", "element.*")


def extract_chunks(parsed_content: Column) -> Column:
    """Text elements as array of (chunk_id, content), in order; a missing id is an empty string."""
    elements = F.from_json(parsed_content, PARSED_SCHEMA)["document"]["elements"]
    texts = F.filter(elements, lambda e: e["type"] == TEXT_TYPE)
    return F.transform(
        texts, lambda e: F.struct(F.coalesce(e["id"], F.lit("")).alias("chunk_id"), e["content"].alias("content"))
    )


def paper_metadata(papers: DataFrame) -> DataFrame:
    parts = [c.alias(name) for name, c in dates.packed_parts(F.col("published")).items()]
    return papers.select("paper_id", "title", "summary", text.join_list(F.col("authors")).alias("authors"), *parts)


def chunk_table(parsed: DataFrame, papers: DataFrame, batch: int | None = None) -> DataFrame:
    """Cleaned chunks of one batch (or all) with the metadata of their paper."""
    rows = parsed if batch is None else parsed.where(F.col("processed") == batch)
    with_id = rows.select(
        text.path_to_id(F.col("path")).alias("paper_id"),
        extract_chunks(F.col("parsed_content")).alias("chunks"),
    )
    cleaned = nested.one_row_each(with_id, "chunks", "chunk").select(
        "paper_id", F.col("chunk.chunk_id").alias("chunk_id"),
        text.clean_text(F.col("chunk.content")).alias("text"),
        text.composite_id(F.col("paper_id"), F.col("chunk.chunk_id")).alias("id"),
    )
    return cleaned.join(paper_metadata(papers), "paper_id", "left")
