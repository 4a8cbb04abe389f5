"""Projections over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import map_role, parse_time, risk_fields, sentiment_date


def normalize_columns(df: DataFrame, case: str = "lower") -> DataFrame:
    """Blanks in column names become underscores; names in lower or upper case."""
    change = str.upper if case == "upper" else str.lower
    return df.toDF(*[change(c.replace(" ", "_")) for c in df.columns])


def clean_dates(df: DataFrame, col: str) -> DataFrame:
    """Text dates to times; rows whose date cannot be read are dropped."""
    return df.withColumn(col, parse_time(col)).where(F.col(col).isNotNull())


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to numbers; text that is no number becomes null."""
    return df.withColumns({c: F.trim(F.col(c)).try_cast("double") for c in cols})


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames the listed columns, keeps the others."""
    return df.withColumnsRenamed(dict(names))


def rename_keys(c: Column, names: Mapping[str, str]) -> Column:
    """Renames the listed keys of a map column, keeps the others."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform_keys(c, lambda k, _: F.coalesce(lookup[k], k))


def stamp_risk(df: DataFrame, as_of: str, ts: str = "ts", market_tz: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Risk rows as they are stored: dates as text, model constants, score = value.

    With `market_tz` the dates are those of the market's own clock.
    """
    when = F.convert_timezone(F.lit("UTC"), F.lit(market_tz), F.col(ts)) if market_tz else F.col(ts)
    day = F.date_format(when, "yyyy-MM-dd")
    fields = risk_fields(as_of)
    return df.select(
        *keep,
        day.alias("date"),
        "risk_value",
        *[c.alias(name) for name, c in fields.items()],
        day.alias("predict_date"),
        F.col("risk_value").alias("risk_score"),
    )


def map_roles(df: DataFrame, speaker: str = "speaker") -> DataFrame:
    """Chat roles for known speakers; rows of unknown speakers are dropped."""
    return df.withColumn("role", map_role(speaker)).where(F.col("role").isNotNull())


def with_sentiment_date(df: DataFrame, report_date: str, article_date: str, out: str = "sentiment_date") -> DataFrame:
    return df.withColumn(out, sentiment_date(report_date, article_date))
