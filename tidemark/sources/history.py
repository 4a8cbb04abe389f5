"""Price history in buckets, so that a day's batch meets it without moving it.

A history is a Parquet table in month folders, and in each month in a fixed number of buckets by (series, time), sorted by
them. What is joined with it on those two columns is sent to its buckets; the history itself is never shuffled,
and a series that holds a third of all rows is spread over all buckets. A batch reads the months it has rows for. The last
times of the series lie beside the rows, one row per series, so that new rows are told from old ones without
reading history at all.

The session knows a history as a table; `open_history` makes it known to another session.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import OHLC, reconcile, reconcile_changes
from tidemark.operators.dedup import dedup_keep_first
from tidemark.operators.filters import newer_than
from tidemark.sources.tables import read_text, write_text

#: Beside the rows: how the history is laid out, and the last times of its series.
ABOUT, LAST = "_history", "_last"


@dataclass(frozen=True)
class History:
    """A history of `spark`: the table `name` below `path`."""

    spark: SparkSession
    name: str
    path: str
    key: str
    ts: str
    buckets: int

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("month")

    def months(self, months: Sequence) -> DataFrame:
        """The rows of some months, in their buckets."""
        return self.spark.table(self.name).where(F.col("month").isin(list(months)))

    @property
    def last_times(self) -> DataFrame:
        """key, _last: the last time of every series."""
        return self.spark.read.parquet(f"{self.path}/{LAST}/{self._versions()[-1]}")

    def _versions(self) -> list[int]:
        """Finished versions of the last times, oldest first."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{LAST}/*/_SUCCESS")
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(at)
        return sorted(int(f.getPath().getParent().getName()) for f in found)

    def _write_last(self, last: DataFrame) -> None:
        before = self._versions()
        version = before[-1] + 1 if before else 0
        last.groupBy(self.key).agg(F.max("_last").alias("_last")).write.mode("overwrite").parquet(f"{self.path}/{LAST}/{version}")
        for old in before[:-1]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{LAST}/{old}")
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def _in_buckets(self, rows: DataFrame) -> DataFrame:
        """A batch dealt as the buckets are: a task writes one bucket."""
        return rows.repartition(self.buckets, self.key, self.ts)

    def _write(self, rows: DataFrame, mode: str) -> None:
        out = rows.write.mode(mode).format("parquet").partitionBy("month").bucketBy(self.buckets, self.key, self.ts)
        out.sortBy(self.key, self.ts).option("path", self.path).option("partitionOverwriteMode", "dynamic").saveAsTable(self.name)


def _with_month(rows: DataFrame, ts: str) -> DataFrame:
    return rows.withColumn("month", F.trunc(F.to_date(ts), "MM"))


def create_history(rows: DataFrame, name: str, path: str, key: str = "symbol", ts: str = "ts", buckets: int = 64) -> History:
    """A new history of `rows`, which hold each (series, time) once."""
    history = History(rows.sparkSession, name, path, key, ts, buckets)
    rows = _with_month(rows, ts)
    history._write(history._in_buckets(rows), "errorifexists")
    about = {"key": key, "ts": ts, "buckets": buckets, "columns": [[f.name, f.dataType.simpleString()] for f in rows.schema]}
    write_text(history.spark, f"{path}/{ABOUT}", json.dumps(about))
    history._write_last(history.spark.table(name).select(key, F.col(ts).alias("_last")))
    return history


def open_history(spark: SparkSession, name: str, path: str) -> History:
    """Makes a history known to a session that hasn't made it."""
    about = json.loads(read_text(spark, f"{path}/{ABOUT}"))
    key, ts, buckets = about["key"], about["ts"], about["buckets"]
    columns = ", ".join(f"`{c}` {t}" for c, t in about["columns"])
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (month) "
        f"CLUSTERED BY (`{key}`, `{ts}`) SORTED BY (`{key}`, `{ts}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return History(spark, name, path, key, ts, buckets)


def _months_of(rows: DataFrame) -> list:
    """As many values as the batch has months."""
    return [r["month"] for r in rows.select("month").distinct().collect()]


def newer_rows(history: History, batch: DataFrame) -> DataFrame:
    """Rows of a batch later than the last stored row of their series; all rows of new series."""
    return newer_than(batch, history.last_times, history.key, history.ts)


def absent_rows(history: History, batch: DataFrame) -> DataFrame:
    """Rows of a batch whose (series, time) is not stored."""
    batch = _with_month(batch, history.ts)
    on = [history.key, history.ts]
    return batch.join(history.months(_months_of(batch)).select(*on), on, "left_anti").select(*batch.columns)


def append_new(history: History, batch: DataFrame, order: Sequence[str]) -> None:
    """Adds the new tail of every series. Of several rows of one time the first by `order` counts.

    May be run again after a failure: rows that were added are found in their buckets and not added twice.
    """
    fresh = absent_rows(history, newer_rows(history, batch))
    fresh = dedup_keep_first(fresh, [history.key, history.ts], order)
    history._write(history._in_buckets(fresh), "append")
    ends = batch.select(history.key, F.col(history.ts).alias("_last"))
    history._write_last(history.last_times.unionByName(ends))


def changes(history: History, batch: DataFrame, cols: Sequence[str] = OHLC, tol: float = 1e-4) -> DataFrame:
    """Stored rows whose values in the batch differ, with old and new values. The batch holds each (series, time) once."""
    months = _months_of(_with_month(batch, history.ts))
    return reconcile_changes(batch, history.months(months), [history.key, history.ts], cols, tol)


def reconcile_history(history: History, batch: DataFrame, cols: Sequence[str] = OHLC, tol: float = 1e-4) -> None:
    """Takes changed values over; the months with a change are written anew, bucket by bucket."""
    months = _months_of(_with_month(changes(history, batch, cols, tol), history.ts))
    if months:
        table = history.spark.table(history.name)
        rows = reconcile(batch, history.months(months), [history.key, history.ts], cols, tol)
        rows.select(*table.columns).write.mode("overwrite").insertInto(history.name)


def compact(history: History, months: Sequence) -> None:
    """Writes months anew with one file per bucket, after many batches were appended; nothing is shuffled."""
    rows = history.months(months)
    # A grouping by the bucket columns makes Spark read bucket by bucket; it finds no row twice.
    once = dedup_keep_first(rows, [history.key, history.ts], rows.columns)
    once.select(*rows.columns).write.mode("overwrite").insertInto(history.name)
