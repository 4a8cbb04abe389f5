"""Name, query and SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; without `sql` its rows are only counted."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def settle(c: Column | str) -> Column:
    """A computed number without the last digits, which depend on the order of summation.

    Both engines cut it the same way: through a 4-byte float.
    """
    return (F.col(c) if isinstance(c, str) else c).cast("float").cast("double")
