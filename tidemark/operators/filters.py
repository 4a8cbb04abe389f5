"""Row selections. Date bounds and equalities are pushed to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import ROWS_PER_TASK, join_group


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def between_dates(df: DataFrame, start: str | None = None, end: str | None = None, ts: str = "ts") -> DataFrame:
    """start <= ts <= end; a missing bound is open."""
    if start is not None:
        df = df.where(F.col(ts) >= _time(start))
    if end is not None:
        df = df.where(F.col(ts) <= _time(end))
    return df


def last_n_days(df: DataFrame, n: int, as_of: str, ts: str = "ts") -> DataFrame:
    """Rows of the n days up to `as_of`."""
    start = _time(as_of) - F.expr(f"INTERVAL {int(n)} DAYS")
    return df.where((F.col(ts) >= start) & (F.col(ts) <= _time(as_of)))


def retain(df: DataFrame, days: int, as_of: str, day: str = "day") -> DataFrame:
    """Drops days strictly before `as_of` - `days`. On a partition column whole folders are skipped."""
    return df.where(F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def lookup(df: DataFrame, **keys) -> DataFrame:
    """Rows that match every given column value."""
    for col, value in keys.items():
        df = df.where(F.col(col) == F.lit(value))
    return df


def missing_content(df: DataFrame, col: str = "content") -> DataFrame:
    return df.where(F.col(col).isNull() | (F.col(col) == ""))


def present_content(df: DataFrame, col: str = "content") -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def only_newer(new: DataFrame, stored: DataFrame, key: str = "symbol", ts: str = "ts", max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Rows later than the last stored row of their series; all rows of a series not stored yet."""
    last = stored.groupBy(key).agg(F.max(ts).alias("_last"))
    return newer_than(new, last, key, ts, max_rows)


def newer_than(new: DataFrame, last: DataFrame, key: str = "symbol", ts: str = "ts", max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """The same against a table (key, `_last`) of last times."""
    sizes = new.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(last, key)
    return (
        join_group(new, sizes, [key], "_n", max_rows)
        .where(F.col("_last").isNull() | (F.col(ts) > F.col("_last")))
        .select(*new.columns)
    )
