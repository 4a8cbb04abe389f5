"""Projections, filters, deduplication and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import (
    join_keywords,
    news_key,
    parse_sentiment,
    round_score,
    sanitize_volume,
    sentiment_date,
    to_utc,
)
from tidemark.operators import cleaning, dedup, filters, sets
from tidemark.queries import views as v
from tidemark.queries.registry import query
from tidemark.schemas import ANALYSIS_FIELDS


@query(
    "p1_normalize_columns",
    "SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderstatus AS order_status FROM orders",
)
def _(spark, sf):
    raw = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_totalprice").alias("Total Price"), F.col("o_orderstatus").alias("ORDER status")
    )
    return cleaning.normalize_columns(raw)


@query("p2_clean_dates", "SELECT event_id, ts FROM events WHERE event_type <> 'error'")
def _(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("no date")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00"))
    return cleaning.clean_dates(v.table(spark, sf, "events").select("event_id", text.alias("ts")), "ts")


@query(
    "p3_coerce_numeric",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS close,
       CASE WHEN event_type <> 'click' THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS volume FROM events""",
)
def _(spark, sf):
    raw = v.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("close"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.get_json_object("props", "$.k")).alias("volume"),
    )
    return cleaning.coerce_numeric(raw, ["close", "volume"])


@query(
    "p4_sanitize_volume",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 0
       ELSE CAST(trunc(greatest(value - 50, 0)) AS BIGINT) END AS volume FROM events""",
)
def _(spark, sf):
    raw = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .when(F.col("event_type") == "signup", F.lit(float("nan")))
        .otherwise(F.col("value") - 50)
    )
    return v.table(spark, sf, "events").select("event_id", sanitize_volume(raw).alias("volume"))


@query(
    "p5_round_score",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE round_even(value / 7, 4) END AS risk_score FROM events",
)
def _(spark, sf):
    raw = F.when(F.col("event_type") != "error", F.col("value") / 7)
    return v.table(spark, sf, "events").select("event_id", round_score(raw).alias("risk_score"))


@query("p6_to_utc", "SELECT event_id, ts - INTERVAL 9 HOUR AS ts_utc FROM events")
def _(spark, sf):
    return v.table(spark, sf, "events").select("event_id", to_utc("ts", "Asia/Seoul").alias("ts_utc"))


@query(
    "p7_rename_fields",
    """SELECT doc_id, source AS companyName, lang AS companySector, n_chars AS other FROM documents""",
)
def _(spark, sf):
    raw = v.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("CompanyName"), F.col("lang").alias("CompanySector"), F.col("n_chars").alias("other")
    )
    return cleaning.rename_fields(raw, ANALYSIS_FIELDS)


@query(
    "p7_rename_keys",
    """SELECT doc_id, k AS key, x AS value FROM (SELECT doc_id, unnest(['sentiment', 'companyName', 'extra']) AS k,
       unnest([CAST(n_chars AS VARCHAR), source, lang]) AS x FROM documents)""",
)
def _(spark, sf):
    raw = F.create_map(
        F.lit("Sentiment"), F.col("n_chars").cast("string"), F.lit("CompanyName"), F.col("source"), F.lit("extra"), F.col("lang")
    )
    renamed = cleaning.rename_keys(raw, ANALYSIS_FIELDS)
    return v.table(spark, sf, "documents").select("doc_id", F.explode(renamed))


@query(
    "p8_stamp_risk",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, value AS risk_value, 'Binseg' AS model_name,
       'Completed' AS analysis_result, '{v.AS_OF}' AS test_date, strftime(ts, '%Y-%m-%d') AS predict_date,
       value AS risk_score FROM events""",
)
def _(spark, sf):
    scores = v.table(spark, sf, "events").withColumn("risk_value", F.col("value"))
    return cleaning.stamp_risk(scores, v.AS_OF, keep=["event_id"])


@query(
    "p9_news_key",
    f"SELECT id, CASE WHEN originallink <> '' THEN originallink ELSE link END AS news_api FROM {v.ARTICLES}",
)
def _(spark, sf):
    return v.articles(spark, sf).select("id", news_key("originallink", "link").alias("news_api"))


@query(
    "p10_parse_sentiment",
    """SELECT doc_id, coalesce(CASE WHEN toxic = 0 THEN CAST(quality AS DOUBLE) END, 0.0) AS sentiment,
       quality IS NOT NULL AS has_report FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    joined = docs.join(v.reports(spark, sf).select("id", "sentiment"), "id", "left")
    return joined.select(
        F.col("id").alias("doc_id"), parse_sentiment("sentiment").alias("sentiment"), F.col("sentiment").isNotNull().alias("has_report")
    )


@query(
    "p11_join_keywords",
    f"""SELECT doc_id, md5(coalesce(array_to_string({v.LONG_WORDS}, ', '), '')) AS keywords_md5 FROM documents""",
)
def _(spark, sf):
    words = F.when(F.size(v.long_words()) > 0, v.long_words())
    return v.table(spark, sf, "documents").select("doc_id", F.md5(join_keywords(words)).alias("keywords_md5"))


@query(
    "p12_sentiment_date",
    f"""SELECT a.id, coalesce(try_cast(r.pubDate AS TIMESTAMP), a.pub_date) AS sentiment_date
       FROM {v.ARTICLES} a LEFT JOIN {v.REPORTS} r ON a.id = r.id""",
)
def _(spark, sf):
    joined = v.articles(spark, sf).select("id", "pub_date").join(v.reports(spark, sf).select("id", "pubDate"), "id", "left")
    return joined.select("id", sentiment_date("pubDate", "pub_date").alias("sentiment_date"))


@query(
    "p13_map_roles",
    """SELECT conv_id, turn, role, text AS message FROM conversations WHERE role IN ('user', 'assistant')""",
)
def _(spark, sf):
    return cleaning.map_roles(v.chat(spark, sf)).select("conv_id", "turn", "role", "message")


# --- filters ---------------------------------------------------------------------------


@query(
    "f1_between_dates",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-10 12:00:00'",
)
def _(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", "ts")
    return filters.between_dates(events, "2024-01-05 00:00:00", "2024-01-10 12:00:00")


@query(
    "f2_last_n_days",
    f"""SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{v.AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{v.AS_OF}'""",
)
def _(spark, sf):
    return filters.last_n_days(v.table(spark, sf, "events").select("event_id", "ts"), 7, v.AS_OF)


@query("f3_retain", f"SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '{v.AS_OF}' - INTERVAL 10 DAY")
def _(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"))
    return filters.retain(events, 10, v.AS_OF).drop("day")


@query(
    "f4_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 3""",
)
def _(spark, sf):
    rows = filters.lookup(v.table(spark, sf, "lineitem"), l_returnflag="R", l_linestatus="F", l_linenumber=3)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _with_gaps(spark, sf):
    return v.articles(spark, sf).select("id", F.col("originallink").alias("content"))


@query("f5_missing_content", f"SELECT id FROM {v.ARTICLES} WHERE originallink IS NULL OR originallink = ''")
def _(spark, sf):
    return filters.missing_content(_with_gaps(spark, sf)).select("id")


@query("f5_present_content", f"SELECT id FROM {v.ARTICLES} WHERE originallink <> ''")
def _(spark, sf):
    return filters.present_content(_with_gaps(spark, sf)).select("id")


@query(
    "f6_only_newer",
    f"""SELECT i.symbol, i.ts, i.close FROM {v.INCOMING} i
       LEFT JOIN (SELECT symbol, max(ts) AS last FROM {v.STORED} GROUP BY symbol) s ON i.symbol = s.symbol
       WHERE s.last IS NULL OR i.ts > s.last""",
)
def _(spark, sf):
    new = v.incoming(spark, sf).select("symbol", "ts", "close")
    return filters.only_newer(new, v.stored(spark, sf))


# --- deduplication ---------------------------------------------------------------------


@query(
    "d1_keep_last",
    f"""SELECT id, company, link FROM {v.ARTICLES} QUALIFY row_number() OVER (PARTITION BY link ORDER BY id DESC) = 1""",
)
def _(spark, sf):
    return dedup.dedup_keep_last(v.articles(spark, sf).select("id", "company", "link"), ["link"], ["id"])


@query(
    "d2_keep_first",
    f"""SELECT id, company, link FROM {v.ARTICLES} QUALIFY row_number() OVER (PARTITION BY link ORDER BY id) = 1""",
)
def _(spark, sf):
    return dedup.dedup_keep_first(v.articles(spark, sf).select("id", "company", "link"), ["link"], ["id"])


@query("d3_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    lines = v.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return dedup.distinct_rows(lines)


@query(
    "d4_dedup_values",
    f"""SELECT symbol, ts, close, volume FROM {v.PRICES}
       QUALIFY row_number() OVER (PARTITION BY close, volume ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "close", "volume", "event_id")
    return dedup.dedup_values(rows, ["close", "volume"], ["ts", "event_id"]).drop("event_id")


# --- unions and sorts ------------------------------------------------------------------


@query(
    "u1_union_all",
    f"""SELECT symbol, ts, close, volume, event_type FROM {v.STORED}
       UNION ALL SELECT symbol, ts, close, NULL AS volume, event_type FROM {v.INCOMING}""",
)
def _(spark, sf):
    columns = ["symbol", "ts", "close", "volume", "event_type"]
    return sets.union_all(v.stored(spark, sf).select(*columns), v.incoming(spark, sf).select("symbol", "ts", "close", "event_type"))


@query(
    "u2_accumulate",
    f"""SELECT id, company, link, is_labelled FROM
       (SELECT a.*, l.doc_id IS NOT NULL AS is_labelled FROM {v.ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id)
       QUALIFY row_number() OVER (PARTITION BY link ORDER BY is_labelled, id DESC) = 1""",
)
def _(spark, sf):
    rows = v.articles(spark, sf).select("id", "company", "link")
    labelled = v.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    old = rows.join(labelled, "id", "left_semi").withColumn("is_labelled", F.lit(True))
    new = rows.join(labelled, "id", "left_anti").withColumn("is_labelled", F.lit(False))
    return sets.accumulate(old, new, ["link"], ["id"])


@query("o1_sort_by_time", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id")
def _(spark, sf):
    return sets.sort_by_time(v.table(spark, sf, "events").select("event_id", "ts", "value"), "ts", ["event_id"])


@query("o2_sort_by_id", "SELECT CAST(doc_id AS VARCHAR) AS id, source FROM documents ORDER BY doc_id")
def _(spark, sf):
    return sets.sort_by_id(v.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "source"))


