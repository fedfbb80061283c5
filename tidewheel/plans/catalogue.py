"""Registry of named queries, each with its independent SQL form where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = build
        if sql is not None:
            _sql[name] = sql
        return build

    return register


def _load_all() -> None:
    from tidewheel.plans import (  # noqa: F401
        booking_queries, document_queries, evaluation_queries, monitoring_queries, registry_queries,
        search_queries, session_queries, source_queries, stream_queries, trace_queries, training_queries,
    )


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_sql)
