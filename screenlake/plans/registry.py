"""Query key -> (query, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` is what another engine runs for the same result."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
