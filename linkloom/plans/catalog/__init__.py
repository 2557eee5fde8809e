"""Every operator as a named query over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL_TEXT: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is left out where SQL cannot state it or is too slow on whole tables."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL_TEXT[name] = sql
        return build

    return add


def load() -> None:
    from linkloom.plans.catalog import (  # noqa: F401
        checks,
        figures,
        ingest,
        ordered,
        results,
        shapes,
        sound,
        streams,
    )
