"""Groupings per series; all of them combine in the map tasks first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import ROWS_PER_TASK, join_group, last_n


def latest(df: DataFrame, key: str = "symbol", ts: str = "ts", order: Sequence[str] | None = None) -> DataFrame:
    """The last row of every series."""
    return last_n(df, 1, [key], list(order or [ts]))


def latest_time(df: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """The last time of every series."""
    return df.groupBy(key).agg(F.max(ts).alias("last_ts"))


def resample_daily(df: DataFrame, key: str = "symbol", ts: str = "ts", value: str = "close", market_tz: str | None = None) -> DataFrame:
    """Last known value per series and day (UTC, or the market's own day)."""
    when = F.convert_timezone(F.lit("UTC"), F.lit(market_tz), F.col(ts)) if market_tz else F.col(ts)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(key, F.to_date(when).alias("day"))
        .agg(F.max_by(value, ts).alias(value))
    )


def profile(df: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """Row count, first and last time of every series."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def segment_volatility(df: DataFrame, keys: Sequence[str] = ("symbol", "seg"), ret: str = "close_change", volume_change: str = "volume_change") -> DataFrame:
    """Volatility per segment: root of the summed squares of both population deviations."""
    a, b = F.stddev_pop(ret), F.stddev_pop(volume_change)
    return df.groupBy(*keys).agg(F.sqrt(a * a + b * b).alias("volatility"), F.count(F.lit(1)).alias("n_rows"))


def scale_between(c, lo, hi):
    """(c - lo) / (hi - lo), or 0.5 where the range is below 1e-9."""
    return F.when(hi - lo < F.lit(1e-9), F.lit(0.5)).otherwise((c - lo) / (hi - lo))


def minmax(df: DataFrame, col: str, keys: Sequence[str] = ("symbol",), out: str = "scaled", max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Min-max scaling per series of any length: one small aggregate joined back."""
    bounds = df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    scaled = scale_between(F.col(col), F.col("_lo"), F.col("_hi"))
    return join_group(df, bounds, keys, "_n", max_rows, "inner").withColumn(out, scaled).drop("_lo", "_hi", "_n")
