"""The given tables as prices, bars, articles, reports, companies and chats.

Every view exists twice: as DataFrame and as SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
CUTOFF = "2024-01-21 00:00:00"
BARS_CUTOFF = "2000-01-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """A price series per user."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        "ts",
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        "event_id",
        "event_type",
    )


PRICES = """(SELECT CAST(user_id AS VARCHAR) AS symbol, ts, value AS close,
  CAST(json_extract(props, '$.k') AS BIGINT) AS volume, event_id, event_type FROM events)"""


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """All prices as delivered again: those of purchases have been corrected by 1."""
    close = F.when(F.col("event_type") == "purchase", F.col("close") + 1).otherwise(F.col("close"))
    return prices(spark, sf).withColumn("close", close)


INCOMING = f"""(SELECT symbol, ts, CASE WHEN event_type = 'purchase' THEN close + 1 ELSE close END AS close,
  volume, event_id, event_type FROM {PRICES})"""


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """What is stored: prices of the first 20 days; signups are not stored at all."""
    return prices(spark, sf).where((F.col("ts") < ntz(CUTOFF)) & (F.col("event_type") != "signup"))


STORED = f"(SELECT * FROM {PRICES} WHERE ts < TIMESTAMP '{CUTOFF}' AND event_type <> 'signup')"

TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Single trades: unit price and quantity per brand and day, many per day."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("symbol"))
    return lines.join(brands, "l_partkey")


TRADES = """(SELECT p_brand AS symbol, l_shipdate AS ts, l_extendedprice / l_quantity AS price, l_quantity AS quantity,
  l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """Daily open, high, low, close and volume per brand."""
    order = F.struct(*TRADE_ORDER)
    return (
        trades(spark, sf)
        .groupBy("symbol", "ts")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").cast("bigint").alias("volume"),
        )
    )


_ORDER = ", ".join(TRADE_ORDER)
_REVERSE = ", ".join(f"{c} DESC" for c in TRADE_ORDER)
BARS = f"""(SELECT symbol, ts, first(price ORDER BY {_ORDER}) AS open, max(price) AS high, min(price) AS low,
  first(price ORDER BY {_REVERSE}) AS close, CAST(sum(quantity) AS BIGINT) AS volume FROM {TRADES} GROUP BY symbol, ts)"""


def incoming_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as delivered again: on days of heavy trade the close has been corrected by 1."""
    close = F.when(F.col("volume") > 50, F.col("close") + 1).otherwise(F.col("close"))
    return bars(spark, sf).withColumn("close", close)


INCOMING_BARS = f"""(SELECT symbol, ts, open, high, low, CASE WHEN volume > 50 THEN close + 1 ELSE close END AS close,
  volume FROM {BARS})"""


def stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).where(F.col("ts") < ntz(BARS_CUTOFF))


STORED_BARS = f"(SELECT * FROM {BARS} WHERE ts < TIMESTAMP '{BARS_CUTOFF}')"

# The 25 brands of the part table: SQL must name its columns.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def brands(spark: SparkSession, sf: str) -> list[str]:
    """The symbols of the universe: every brand is a column of the matrix."""
    return [r[0] for r in table(spark, sf, "part").select("p_brand").distinct().sort("p_brand").collect()]


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles of the company `source`; equal texts share a link. Documents in
    Spanish have no original link, those of the company src0 no date."""
    link = F.md5("text")
    date = F.timestamp_add("HOUR", F.col("doc_id"), ntz("2024-01-01 00:00:00"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("company"),
        F.concat_ws(" ", "lang", "source", F.col("doc_id").cast("string")).alias("title"),
        F.when(F.col("lang") == "es", F.lit("")).otherwise(link).alias("originallink"),
        link.alias("link"),
        F.when(F.col("source") != "src0", date).alias("pub_date"),
        F.col("text").alias("content"),
        "lang",
    )


ARTICLES = """(SELECT doc_id AS id, source AS company, lang || ' ' || source || ' ' || doc_id AS title,
  CASE WHEN lang = 'es' THEN '' ELSE md5(text) END AS originallink, md5(text) AS link,
  CASE WHEN source <> 'src0' THEN TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 HOUR END AS pub_date,
  text AS content, lang FROM documents)"""


def long_words(text: str = "text"):
    """The long words of a text, as keywords."""
    return F.filter(F.split(F.col(text), "[ \n]"), lambda w: F.length(w) >= 16)


LONG_WORDS = "list_filter(regexp_split_to_array(text, '[ \\n]'), lambda w: length(w) >= 16)"


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as reports: the score is text and unreadable for toxic documents; good ones have a date."""
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", long_words().alias("words"))
    good = F.col("quality") == 1
    return labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, F.lit("n/a")).otherwise(F.col("quality").cast("string")).alias("sentiment"),
        F.when(good, F.col("words")).alias("positiveKeywords"),
        F.when(~good, F.col("words")).alias("negativeKeywords"),
        F.when(good, F.lit("2024-06-01 12:00:00")).otherwise(F.lit("soon")).alias("pubDate"),
    )


REPORTS = f"""(SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'n/a' ELSE CAST(quality AS VARCHAR) END AS sentiment,
  CASE WHEN quality = 1 THEN {LONG_WORDS} END AS positiveKeywords,
  CASE WHEN quality <> 1 THEN {LONG_WORDS} END AS negativeKeywords,
  CASE WHEN quality = 1 THEN '2024-06-01 12:00:00' ELSE 'soon' END AS pubDate
  FROM labels JOIN documents USING (doc_id))"""


def universe(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as companies: country = nation, sector = region (unknown for debtors)."""
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("symbol"),
            F.col("s_name").alias("full_name"),
            F.col("n_name").alias("exchange"),
            F.when(F.col("s_acctbal") >= 0, F.col("r_name")).alias("sector"),
        )
    )


UNIVERSE = """(SELECT CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS full_name, n_name AS exchange,
  CASE WHEN s_acctbal >= 0 THEN r_name END AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def chat(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as chat history; the system plays the unknown speaker."""
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", F.lit("gpt")).otherwise(F.col("role")).alias("speaker"),
        F.col("text").alias("message"),
    )


CHAT = """(SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'gpt' ELSE role END AS speaker, text AS message
  FROM conversations)"""
