"""Streams over files derived from the tables; each runs until all files are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries import views as v
from tidemark.queries.news import HEADLINES
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.streaming import news, prices


def _two_deliveries(spark, sf):
    """Bars before the cutoff arrive first; then all bars arrive again, some corrected."""
    home = scratch_path(spark, "price-stream")
    landing, table = f"{home}/landing", f"{home}/table"
    first = v.stored_bars(spark, sf)
    for delivery in (first, v.incoming_bars(spark, sf)):
        delivery.write.mode("append").parquet(landing)
        prices.stream_prices(spark, landing, table, first.schema)
    prices.compact(spark, table, keep=1)
    return table


@query(
    "t1_stream_prices",
    f"""SELECT symbol, ts, open, high, low, close, volume FROM {v.STORED_BARS} UNION ALL
       SELECT symbol, ts, open, high, low, close, volume FROM {v.INCOMING_BARS} WHERE ts >= TIMESTAMP '{v.BARS_CUTOFF}'""",
)
def _(spark, sf):
    return prices.stored_prices(spark, _two_deliveries(spark, sf))


@query("t1_current_prices", f"SELECT symbol, ts, open, high, low, close, volume FROM {v.INCOMING_BARS}")
def _(spark, sf):
    return prices.current_prices(spark, _two_deliveries(spark, sf), order=["close"])


@query(
    "t1_corrected_twice",
    f"""SELECT symbol, ts, open, high, low, close + 2 AS close, volume FROM {v.STORED_BARS}""",
)
def _(spark, sf):
    """Two corrections for each stored bar in one delivery: the later one counts."""
    home = scratch_path(spark, "corrections")
    first = v.stored_bars(spark, sf).withColumn("seq", F.lit(0))
    later = F.explode(F.array(F.lit(2), F.lit(1)))
    again = first.drop("seq").withColumn("seq", later).withColumn("close", F.col("close") + F.col("seq"))
    for delivery in (first, again.select(*first.columns)):
        delivery.write.mode("append").parquet(f"{home}/landing")
        prices.stream_prices(spark, f"{home}/landing", f"{home}/table", first.schema)
    return prices.current_prices(spark, f"{home}/table", order=["seq"]).drop("seq")


@query(
    "t2_late_rows",
    f"""SELECT symbol, ts, close, CAST(1 AS BIGINT) AS batch_id FROM {v.INCOMING_BARS} WHERE ts < TIMESTAMP '{v.BARS_CUTOFF}'""",
)
def _(spark, sf):
    late = prices.late_prices(spark, _two_deliveries(spark, sf))
    return late.select("symbol", "ts", "close", F.col("batch_id").cast("bigint").alias("batch_id"))


@query("t3_exactly_once", "SELECT event_id, ts, user_id, value FROM events")
def _(spark, sf):
    """Purchases come last, weeks after all others, with everything delivered again."""
    home = scratch_path(spark, "redelivery")
    events = v.table(spark, sf, "events").select("event_id", "ts", "user_id", "value", "event_type")
    for delivery in (events.where("event_type <> 'purchase'"), events):
        delivery.drop("event_type").write.mode("append").parquet(f"{home}/landing")
        prices.stream_distinct(spark, f"{home}/landing", f"{home}/table", events.drop("event_type").schema)
    return prices.distinct_rows(spark, f"{home}/table")


@query("t4_catch_up", f"SELECT symbol, ts, close, event_id FROM {v.PRICES}")
def _(spark, sf):
    """History of the first days, then catch up week by week."""
    home = scratch_path(spark, "catch-up")
    landing, table = f"{home}/landing", f"{home}/table"
    rows = v.prices(spark, sf).select("symbol", "ts", "close", "event_id")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    first, last = rows.agg(F.min(F.floor(day / 7)), F.max(F.floor(day / 7))).first()
    for week in range(first, last + 1):
        rows.where(F.floor(day / 7) == week).write.mode("append").parquet(landing)
        prices.catch_up(spark, landing, table, rows.schema, step_files=64)
    return prices.stored_prices(spark, table)


@query("t5_stream_headlines", HEADLINES % 10)
def _(spark, sf):
    home = scratch_path(spark, "headlines")
    pages = v.table(spark, sf, "pages")
    pages.write.parquet(f"{home}/landing")
    news.stream_headlines(spark, f"{home}/landing", f"{home}/table", pages.schema)
    return spark.read.parquet(f"{home}/table/rows")


def _article_stream(spark, sf):
    home = scratch_path(spark, "articles")
    rows = v.articles(spark, sf).select(F.col("id").alias("seq"), "company", "link", "title", "lang")
    for delivery in (rows.where("lang = 'en'"), rows.where("lang <> 'en'")):
        delivery.write.mode("append").parquet(f"{home}/landing")
        news.stream_articles(spark, f"{home}/landing", f"{home}/table", rows.schema)
    return f"{home}/table"


@query(
    "t6_accumulated_articles",
    f"""SELECT id AS seq, company, link, title, lang FROM {v.ARTICLES}
       QUALIFY row_number() OVER (PARTITION BY company, link ORDER BY id DESC) = 1""",
)
def _(spark, sf):
    return news.accumulated_articles(spark, _article_stream(spark, sf))


@query(
    "t6_unseen_articles",
    f"""SELECT id AS seq, company, link, title, lang FROM {v.ARTICLES}
       QUALIFY row_number() OVER (PARTITION BY company, link ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, id) = 1""",
)
def _(spark, sf):
    return news.unseen_articles(spark, _article_stream(spark, sf))
