"""Incremental price ingest.

A batch writes its own folder, and folders are merged in tiers (see tiers). The last stored times are kept apart in the
same way: each batch adds those of the series it holds, merging takes the latest of each series; history is never
read again.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import reconcile
from tidemark.operators.dedup import dedup_keep_last
from tidemark.operators.series import join_group
from tidemark.sources.tables import read_layout, write_layout
from tidemark.streaming.distinct import first_rows, new_rows, state_settings
from tidemark.streaming.tiers import WIDTH, Tiers

POLL = "60 seconds"


def start(writer, once: bool, interval: str = POLL) -> StreamingQuery:
    """Runs all waiting files and returns, or starts to poll."""
    if not once:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_landing(spark: SparkSession, landing: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing)


def _latest(key: str):
    return lambda rows: rows.groupBy(key).agg(F.max("_last").alias("_last"))


def store_batch(batch: DataFrame, batch_id: int, table: str, key: str, ts: str, stored: DataFrame | None = None, width: int = WIDTH) -> None:
    """Stores one batch: rows after the last stored time of their series, and the late ones marked as such."""
    spark = batch.sparkSession
    rows, times = Tiers(spark, f"{table}/rows", width=width), Tiers(spark, f"{table}/last", _latest(key), width)
    held = T.StructType([*batch.schema, T.StructField("late", T.BooleanType()), T.StructField("batch_id", T.LongType())])
    known = T.StructType([batch.schema[key], T.StructField("_last", batch.schema[ts].dataType)])
    if batch_id == 0:
        write_layout(spark.createDataFrame([], held), table, [])
    rows.settle(held, batch_id)
    times.settle(known, batch_id)
    last = times.read(known, before=batch_id)
    if batch_id == 0 and stored is not None:
        last = stored.select(key, F.col(ts).alias("_last"))
    last = _latest(key)(last)
    late = F.coalesce(F.col(ts) <= F.col("_last"), F.lit(False))
    sizes = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(last, key)
    marked = join_group(batch, sizes, [key], "_n").withColumn("late", late)
    written = rows.write(marked.select(*batch.columns, "late", F.lit(batch_id).cast("bigint").alias("batch_id")), batch_id)
    newest = written.select(key, F.col(ts).alias("_last"))
    if batch_id == 0:
        newest = newest.unionByName(last)
    times.write(_latest(key)(newest), batch_id)


def compact(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Joins the folders of all batches but the newest `keep` (one at least: it may be run again) into one.

    Run it while the stream is stopped; merging in tiers goes on from there.
    """
    rows = Tiers(spark, f"{table}/rows")
    old = [f for f in rows.finished() if f[1] < max(f[1] for f in rows.finished()) - max(1, keep) + 1]
    if old:
        rows.merge(_held(spark, table), 0, max(f[1] for f in old))
        rows.clean()


def _held(spark: SparkSession, table: str) -> T.StructType:
    return read_layout(spark, table)[0]


def stream_prices(
    spark: SparkSession,
    landing: str,
    table: str,
    schema,
    key: str = "symbol",
    ts: str = "ts",
    once: bool = True,
    interval: str = POLL,
    max_files: int | None = None,
    stored: DataFrame | None = None,
) -> StreamingQuery:
    """Appends the new tail of every series from the files below `landing`."""
    source = read_landing(spark, landing, schema, max_files)
    writer = source.writeStream.option("checkpointLocation", f"{table}/_progress").foreachBatch(
        partial(store_batch, table=table, key=key, ts=ts, stored=stored)
    )
    return start(writer, once, interval)


def catch_up(spark: SparkSession, landing: str, table: str, schema, step_files: int = 1, **options) -> StreamingQuery:
    """Loads everything that has not been loaded, `step_files` files at a time; resumes where it stopped."""
    return stream_prices(spark, landing, table, schema, once=True, max_files=step_files, **options)


def _rows(spark: SparkSession, table: str) -> DataFrame:
    return Tiers(spark, f"{table}/rows").read(_held(spark, table))


def stored_prices(spark: SparkSession, table: str) -> DataFrame:
    return _rows(spark, table).where(~F.col("late")).drop("late", "batch_id")


def late_prices(spark: SparkSession, table: str) -> DataFrame:
    return _rows(spark, table).where(F.col("late")).drop("late")


def current_prices(spark: SparkSession, table: str, keys=("symbol", "ts"), cols=("open", "high", "low", "close"), tol: float = 1e-4, *, order) -> DataFrame:
    """Stored rows with the corrections that came late: of several for one key the last batch counts, within a
    batch the last in `order`, columns of the feed that tell which row is later."""
    corrections = dedup_keep_last(late_prices(spark, table), list(keys), ["batch_id", *order])
    return reconcile(corrections, stored_prices(spark, table), keys, cols, tol)


def store_new(batch: DataFrame, batch_id: int, table: str, width: int = WIDTH) -> None:
    """Stores the new rows of a batch of `first_rows`."""
    rows, tiers = new_rows(batch), Tiers(batch.sparkSession, f"{table}/rows", width=width)
    if batch_id == 0:
        write_layout(rows, table, [])
    tiers.settle(rows.schema, batch_id)
    tiers.write(rows, batch_id)


def stream_distinct(
    spark: SparkSession,
    landing: str,
    table: str,
    schema,
    keys=("event_id",),
    order=(),
    once: bool = True,
    interval: str = POLL,
    max_files: int | None = None,
    width: int = WIDTH,
) -> StreamingQuery:
    """Appends every row once, however late it comes or is delivered again.

    Of rows with one key in one batch the first in `order` counts, any of them without it.
    """
    rows, mode = first_rows(read_landing(spark, landing, schema, max_files), list(keys), list(order))
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", f"{table}/_progress")
    with state_settings(spark):
        return start(writer.foreachBatch(partial(store_new, table=table, width=width)), once, interval)


def distinct_rows(spark: SparkSession, table: str) -> DataFrame:
    return Tiers(spark, f"{table}/rows").read(_held(spark, table))
