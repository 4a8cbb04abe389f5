"""Normalisers: raw feed rows to price or news rows, and their registry."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import news_key, parse_news_date, parse_time, to_utc
from tidemark.operators.cleaning import coerce_numeric, normalize_columns
from tidemark.operators.dedup import dedup_keep_last
from tidemark.operators.sets import union_all
from tidemark.schemas import NEWS_PAYLOAD, PRICE_PAYLOAD

log = logging.getLogger(__name__)

Normaliser = Callable[..., DataFrame]
FEEDS: dict[str, Normaliser] = {}


def feed(name: str):
    """Registers a normaliser under the name a configuration uses."""

    def add(fn: Normaliser) -> Normaliser:
        FEEDS[name] = fn
        return fn

    return add


def normalize(name: str, raw: DataFrame, **options) -> DataFrame:
    if name not in FEEDS:
        raise ValueError(f"unknown feed {name!r}; known: {sorted(FEEDS)}")
    return FEEDS[name](raw, **options)


@feed("us_prices")
def normalize_us_prices(df: DataFrame, zone: str = "UTC", keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Last row per time in arrival order, times in UTC, lower-case names without blanks."""
    named = normalize_columns(df.withColumnRenamed("Date", "ts"))
    return dedup_keep_last(named, [*keys, "ts"], order).withColumn("ts", to_utc("ts", zone))


@feed("kr_prices")
def normalize_kr_prices(df: DataFrame, zone: str = "Asia/Seoul") -> DataFrame:
    """Lower-case names, Seoul times in UTC."""
    named = normalize_columns(df.withColumnRenamed("Date", "ts"))
    return named.withColumn("ts", to_utc("ts", zone))


@feed("json_prices")
def normalize_json_prices(df: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("seq",), payload: str = "payload") -> DataFrame:
    """Rows of JSON answers; unreadable numbers are null, answers without values give no rows."""
    values = F.from_json(payload, PRICE_PAYLOAD)["values"]
    rows = df.select(*keys, *order, F.posexplode(values).alias("_at", "_v")).select(*keys, *order, "_at", "_v.*")
    timed = rows.withColumn("ts", parse_time("datetime")).drop("datetime")
    last = dedup_keep_last(timed, [*keys, "ts"], [*order, "_at"]).drop("_at")
    return coerce_numeric(last, ["open", "high", "low", "close", "volume"])


@feed("news")
def normalize_news(df: DataFrame, keys: Sequence[str] = ("company",), order: Sequence[str] = ("seq",), payload: str = "payload") -> DataFrame:
    """Items of news answers: last copy per link within `keys` (the company asked for), then only those with a date.

    The link is the original one, or the feed's own where the original is empty.
    """
    items = F.from_json(payload, NEWS_PAYLOAD)["items"]
    rows = df.select(*keys, *order, F.posexplode(items).alias("_at", "_v")).select(*keys, *order, "_at", "_v.*")
    keyed = rows.withColumn("_key", news_key("originallink", "link"))
    last = dedup_keep_last(keyed, [*keys, "_key"], [*order, "_at"]).drop("_at", "_key")
    return last.withColumn("pub_date", parse_news_date("pubDate")).drop("pubDate").where(F.col("pub_date").isNotNull())


def load_feeds(raws: Sequence[tuple[str, DataFrame, dict]], columns: Sequence[str]) -> DataFrame:
    """The normalised rows of several feeds (name, raw rows, options); unknown feeds are logged and skipped."""
    usable = []
    for name, raw, options in raws:
        if name in FEEDS:
            usable.append(normalize(name, raw, **options).select(*columns))
        else:
            log.error("feed %r skipped, known are %s", name, known_feeds())
    if not usable:
        raise ValueError("no usable feed")
    return union_all(*usable)


def known_feeds() -> Iterable[str]:
    return sorted(FEEDS)
