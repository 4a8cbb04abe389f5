"""Incremental news: headlines of fetched pages and the growing list of articles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import dedup_keep_last
from tidemark.sources.pages import top_headlines
from tidemark.streaming.prices import distinct_rows, read_landing, start, store_new, stream_distinct
from tidemark.streaming.tiers import WIDTH

HEADLINE_POLL = "100 seconds"


def _append(rows: DataFrame, table: str):
    return rows.writeStream.format("parquet").option("path", f"{table}/rows").option("checkpointLocation", f"{table}/_progress")


def stream_headlines(spark: SparkSession, landing: str, table: str, schema, n: int = 10, container: str = "nav", once: bool = True, interval: str = HEADLINE_POLL, max_files: int | None = None) -> StreamingQuery:
    """Appends the first n headlines of every page that arrives."""
    pages = read_landing(spark, landing, schema, max_files)
    return start(_append(top_headlines(pages, n, container), table), once, interval)


def stream_articles(
    spark: SparkSession,
    landing: str,
    table: str,
    schema,
    keys: Sequence[str] = ("company", "link"),
    order: Sequence[str] = ("seq",),
    once: bool = True,
    interval: str = "60 seconds",
    max_files: int | None = None,
    width: int = WIDTH,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Appends every delivered article to a log, and the first copy of each to `unseen`.

    Only unseen articles go on to text extraction and scoring.
    """
    source = read_landing(spark, landing, schema, max_files)
    log = source.writeStream.option("checkpointLocation", f"{table}/log/_progress")
    log = start(log.foreachBatch(partial(store_new, table=f"{table}/log", width=width)), once, interval)
    first = stream_distinct(spark, landing, f"{table}/unseen", schema, keys, order, once, interval, max_files, width)
    return log, first


def accumulated_articles(spark: SparkSession, table: str, keys: Sequence[str] = ("company", "link"), order: Sequence[str] = ("seq",)) -> DataFrame:
    """All articles, the last delivered copy of each."""
    return dedup_keep_last(distinct_rows(spark, f"{table}/log"), keys, order)


def unseen_articles(spark: SparkSession, table: str) -> DataFrame:
    return distinct_rows(spark, f"{table}/unseen")
