"""String expressions: cleaning, counting, identifiers. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and limits that decide the result.
HYPHEN_BREAK = r"(?U)(\w)-\s*\n\s*(\w)"
LINE_BREAK = r"(?U)\s*\n\s*"
WHITESPACE_RUN = r"(?U)\s+"
WORD = r"(?U)\S+"
REGION_SUFFIX = r"_(US_EAST|EU_WEST|US_EAST_2|US_WEST|US_WEST_2)$"
WORD_LIMIT = 350


def clean_text(text: Column) -> Column:
    """Undo hyphenation at line ends, flatten line breaks, collapse whitespace, trim."""
    joined = F.regexp_replace(text, HYPHEN_BREAK, "$1$2")
    flat = F.regexp_replace(joined, LINE_BREAK, " ")
    return F.trim(F.regexp_replace(flat, WHITESPACE_RUN, " "))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; null for null text."""
    return F.array_size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


def within_word_limit(text: Column, limit: int = WORD_LIMIT) -> Column:
    """True when the text holds strictly fewer words than the limit; null for null text."""
    return word_count(text) < F.lit(limit)


def path_to_id(path: Column, suffix: str = ".pdf") -> Column:
    """Last path part with every occurrence of the suffix removed."""
    return F.element_at(F.split(F.replace(path, F.lit(suffix), F.lit("")), "/"), -1)


def composite_id(*parts: Column) -> Column:
    """Join id parts with underscores; a null part is left out."""
    return F.concat_ws("_", *parts)


def join_list(values: Column) -> Column:
    """Array of strings as one comma-separated string."""
    return F.concat_ws(", ", values)


def strip_region(sku: Column) -> Column:
    """SKU name without its trailing region."""
    return F.regexp_replace(sku, REGION_SUFFIX, "")


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def column_name(name: str) -> str:
    """Column name with spaces and hyphens turned into underscores."""
    return name.replace(" ", "_").replace("-", "_")
