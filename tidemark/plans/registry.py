"""Named queries over the given tables, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, under its own name unless the operator it shows has that name already."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return register
