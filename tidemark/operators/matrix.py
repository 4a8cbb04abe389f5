"""Gap-filled daily price matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_keep_first
from tidemark.operators.joins import calendar_grid
from tidemark.operators.series import bfill, ffill


def price_matrix_long(
    df: DataFrame, key: str = "symbol", ts: str = "ts", value: str = "close", order: Sequence[str] = (), method: str = "bfill", market_tz: str | None = None
) -> DataFrame:
    """One row per series and calendar day, from the first to the last day of any row.

    The first of rows with equal time counts (give `order` when times may repeat). Days are
    UTC days, or the market's own with `market_tz`. Days without a price take the next known
    price, the tail takes the last known one; `method="ffill"` never looks ahead. A series
    without any price stays empty. Prices are grouped by day once; series and calendar come
    from that small result.
    """
    prices = dedup_keep_first(df, [key, ts], list(order)) if order else df
    when = F.convert_timezone(F.lit("UTC"), F.lit(market_tz), F.col(ts)) if market_tz else F.col(ts)
    known = F.when(F.col(value).isNotNull(), F.col(ts))
    days = prices.groupBy(key, F.to_date(when).alias("day")).agg(F.max_by(value, known).alias(value))
    daily = days.where(F.col("day").isNotNull()).select(F.col(key).alias("_key"), F.col("day").alias("_day"), value)
    full = calendar_grid(days, key, "day")
    full = full.join(daily, full[key].eqNullSafe(daily["_key"]) & (full["day"] == daily["_day"]), "left").drop("_key", "_day")
    if method == "ffill":
        return ffill(full, value, [key], "day")
    return ffill(bfill(full, value, [key], "day"), value, [key], "day")


def price_matrix(
    df: DataFrame, symbols: Sequence[str], key: str = "symbol", ts: str = "ts", value: str = "close", order: Sequence[str] = (), method: str = "bfill", market_tz: str | None = None
) -> DataFrame:
    """One row per calendar day, one column per symbol."""
    wanted = df.where(F.col(key).isin(list(symbols)))
    long = price_matrix_long(wanted, key, ts, value, order, method, market_tz)
    return long.groupBy("day").pivot(key, list(symbols)).agg(F.first(value))
