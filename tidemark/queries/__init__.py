"""Queries on the given tables, each with its SQL where SQL can say it."""

from tidemark.queries import changes, cleaning, news, series, sources, streams  # noqa: F401
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
