"""Scalar cleaning rules. Every function maps columns to a column; none needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_nan(c: ColumnOrName) -> Column:
    """NaN becomes null (Spark orders NaN above every number, so max and compare need this first)."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def parse_time(c: ColumnOrName) -> Column:
    """Text to UTC wall time; text that is no time becomes null.

    Text with an offset is moved to UTC, text without one is taken as UTC
    (the session runs in UTC). A number is no time: four digits and a month are needed.
    """
    dated = F.when(_col(c).cast("string").rlike(r"^\s*\d{4}-\d"), _col(c))
    return F.try_to_timestamp(dated).cast("timestamp_ntz")


def parse_news_date(c: ColumnOrName) -> Column:
    """RFC 822 text ("Mon, 26 Sep 2016 07:50:00 +0900") to UTC wall time, else null."""
    without_day = F.regexp_replace(_col(c), r"^[A-Za-z]{3}, *", "")
    return F.try_to_timestamp(without_day, F.lit("d MMM yyyy HH:mm:ss Z")).cast("timestamp_ntz")


def to_utc(c: ColumnOrName, zone: str) -> Column:
    """Wall time of a market zone to UTC wall time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(c).cast("timestamp_ntz"))


def sanitize_volume(c: ColumnOrName) -> Column:
    """Missing and negative volume count as 0; fractions are cut off."""
    return F.greatest(F.coalesce(drop_nan(c), F.lit(0.0)), F.lit(0.0)).cast("bigint")


def round_score(c: ColumnOrName) -> Column:
    """Missing score counts as 0; four places, half to even."""
    return F.bround(F.coalesce(drop_nan(c), F.lit(0.0)), 4)


def news_key(originallink: ColumnOrName, link: ColumnOrName) -> Column:
    """The original link, or the feed's own link when the original is empty."""
    return F.coalesce(F.nullif(_col(originallink), F.lit("")), _col(link))


def parse_sentiment(c: ColumnOrName) -> Column:
    """Sentiment text to a number; missing or unreadable counts as 0."""
    number = F.trim(_col(c).cast("string")).try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)
    return F.coalesce(finite, F.lit(0.0))


def join_keywords(c: ColumnOrName) -> Column:
    """Keyword list to text, parts joined by a comma and a space; no list gives empty text."""
    return F.coalesce(F.array_join(_col(c), ", "), F.lit(""))


def sentiment_date(report_date: ColumnOrName, article_date: ColumnOrName) -> Column:
    """The report's own date when it can be read, else the article's date."""
    return F.coalesce(parse_time(report_date), _col(article_date))


def map_role(speaker: ColumnOrName) -> Column:
    """Speaker to chat role; an unknown speaker gives null."""
    s = _col(speaker)
    return F.when(s == "user", F.lit("user")).when(s.isin("llama", "gpt"), F.lit("assistant"))


def risk_fields(as_of: str) -> dict[str, Column]:
    """The constant columns of a risk row for the run date `as_of` (YYYY-MM-DD)."""
    return {
        "model_name": F.lit("Binseg"),
        "analysis_result": F.lit("Completed"),
        "test_date": F.lit(as_of),
    }
