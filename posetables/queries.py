"""Registered queries and their DuckDB oracles, gathered from the operator modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .fixtures import read, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None, *tables: str):
    """Register f(table, ...) as a query over the named tables."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(*(read(spark, sf_dir, t) for t in tables))
        if sql is not None:
            ORACLE_SQL[name] = with_tables(sql)
        return f

    return register


def r6(c: Column, digits: int = 6) -> Column:
    """Six digits, and no negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def load() -> None:
    from .operators import aggregates, filters, joins, payload, projections, windows  # noqa: F401
    from .functions import queries as functions_queries  # noqa: F401
    from .plans import sampling  # noqa: F401
    from .sources import queries as sources_queries  # noqa: F401
