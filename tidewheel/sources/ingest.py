"""Range ingest of a source table, its next window, and the request-log producer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import dates

# Fixed value: a first or forced run looks back this many days.
LOOKBACK_DAYS = 3


def parse_flag(text: str | bool) -> bool:
    """Job flags arrive as text; only a true word is true."""
    if isinstance(text, bool):
        return text
    return text.strip().lower() in {"true", "1", "yes"}


def range_start(processed: DataFrame, now: Column, forced: bool | str = False) -> DataFrame:
    """One row: newest processed mark, or `now` less the lookback when there is none or forced."""
    fallback = dates.pack_minute(now - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS"))
    newest = processed.agg(F.max("processed").alias("_newest"))
    mark = fallback if parse_flag(forced) else F.coalesce("_newest", fallback)
    return newest.select(mark.alias("range_start"))


def range_ingest(
    source: DataFrame, category: Column, submitted: str, start: int, end: int, checks: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows of a category submitted in [start, end], split into good rows and failures.

    `checks` maps a reason to an expression that is null when the item cannot be read; the
    first failing check names the reason. A bad item never stops the run.
    """
    picked = source.where(category & F.col(submitted).between(start, end))
    reason = F.lit(None).cast("string")
    for name, value in reversed(list(checks.items())):
        reason = F.when(value.isNull(), F.lit(name)).otherwise(reason)
    judged = picked.withColumn("failure", reason)
    return judged.where("failure IS NULL").drop("failure"), judged.where("failure IS NOT NULL")


def request_payload(records: Column, request_id: Column, params: Column | None = None) -> Column:
    """Serving request as JSON: client id, records, and parameters when given."""
    parts = [request_id.alias("client_request_id"), records.alias("dataframe_records")]
    if params is not None:
        parts.append(params.alias("params"))
    return F.to_json(F.struct(*parts))


def record_array(columns: list[str]) -> Column:
    """The row's own columns as a one-record array."""
    return F.array(F.struct(*columns))
