"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return register


def r6(column: Column | str, name: str | None = None) -> Column:
    """Six digits, negative zero cleared, as the oracle does."""
    label = name or (column if isinstance(column, str) else None)
    column = F.col(column) if isinstance(column, str) else column
    out = F.round(column.cast("double"), 6) + F.lit(0.0)
    return out.alias(label) if label else out


def big(column: Column | str, name: str | None = None) -> Column:
    label = name or (column if isinstance(column, str) else None)
    column = F.col(column) if isinstance(column, str) else column
    out = column.cast("bigint")
    return out.alias(label) if label else out


def us_of(column: str, name: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")).alias(name)
