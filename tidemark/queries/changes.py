"""Joins and table changes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import round_score
from tidemark.operators import changes as ops
from tidemark.operators import joins, quality
from tidemark.plans import risk
from tidemark.queries import views as v
from tidemark.queries.registry import query
from tidemark.queries.series import _RISK
from tidemark.schemas import Field, Table
from tidemark.session import scratch_path
from tidemark.sources import history, tables

# --- joins -----------------------------------------------------------------------------


@query(
    "j1_pair_on_key",
    f"""SELECT n.symbol, n.ts, n.close AS close_new, o.close AS close_old, n.volume AS volume_new, o.volume AS volume_old
       FROM {v.INCOMING_BARS} n JOIN {v.STORED_BARS} o ON n.symbol = o.symbol AND n.ts = o.ts""",
)
def _(spark, sf):
    columns = ["symbol", "ts", "close", "volume"]
    return joins.pair_on_key(v.incoming_bars(spark, sf).select(*columns), v.stored_bars(spark, sf).select(*columns), ["symbol", "ts"])


@query(
    "j2_anti_existing",
    f"""SELECT id, link FROM {v.ARTICLES} WHERE link NOT IN
       (SELECT md5(text) FROM documents JOIN labels USING (doc_id))
       QUALIFY row_number() OVER (PARTITION BY link ORDER BY id) = 1""",
)
def _(spark, sf):
    new = v.articles(spark, sf).select("id", "link")
    known = new.join(v.table(spark, sf, "labels").select(F.col("doc_id").alias("id")), "id", "left_semi")
    return joins.anti_existing(new, known, ["link"], ["id"])


@query(
    "j3_assemble_news",
    f"""SELECT a.id, a.title, CASE WHEN a.lang = 'de' THEN '' ELSE md5(a.content) END AS content_md5, r.sentiment,
       coalesce(array_to_string(r.positiveKeywords, ', '), '') AS positive, r.id IS NOT NULL AS has_report
       FROM {v.ARTICLES} a LEFT JOIN {v.REPORTS} r ON a.id = r.id""",
)
def _(spark, sf):
    articles = v.articles(spark, sf)
    contents = articles.where("lang <> 'de'").select("id", "content")
    rows = joins.assemble_news(articles.select("id", "title"), contents, v.reports(spark, sf))
    text = F.when(F.col("content") != "", F.md5("content")).otherwise("")
    positive = F.coalesce(F.array_join("positiveKeywords", ", "), F.lit(""))
    return rows.select("id", "title", text.alias("content_md5"), "sentiment", positive.alias("positive"), "has_report")


@query(
    "j5_map_names",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_suppkey AS VARCHAR) AS symbol,
       CASE WHEN s_acctbal >= 0 THEN s_name || ' ' || n_name ELSE s_name END AS full_name
       FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def _(spark, sf):
    lines = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_suppkey").cast("string").alias("symbol")
    )
    first = v.universe(spark, sf)
    later = first.where(F.col("sector").isNotNull()).withColumn("full_name", F.concat_ws(" ", "full_name", "exchange"))
    return joins.map_names(lines, [first, later])


@query("j7_orphans", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    return joins.orphans(v.table(spark, sf, "documents").select("doc_id", "lang"), v.table(spark, sf, "labels"), "doc_id")


@query(
    "j7_orphan_suppliers",
    "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)",
)
def _(spark, sf):
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.orphans(lines, v.table(spark, sf, "supplier").where("s_acctbal >= 0"), "l_suppkey", "s_suppkey")


@query(
    "j7_cascade_delete",
    """SELECT l.doc_id, quality, toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE d.lang <> 'en'""",
)
def _(spark, sf):
    docs, labels = v.table(spark, sf, "documents"), v.table(spark, sf, "labels")
    _, kept_labels = joins.cascade_delete(docs, [labels], "doc_id", "lang = 'en'")
    return kept_labels


_STAR = {
    "region": Table((), ("r_regionkey",), {}),
    "nation": Table((), ("n_nationkey",), {"n_regionkey": "region"}),
    "supplier": Table((), ("s_suppkey",), {"s_nationkey": "nation"}),
    "customer": Table((), ("c_custkey",), {"c_nationkey": "nation"}),
    "part": Table((), ("p_partkey",), {}),
    "orders": Table((), ("o_orderkey",), {"o_custkey": "customer"}),
    "lineitem": Table((), ("l_orderkey", "l_linenumber"), {"l_orderkey": "orders", "l_suppkey": "supplier", "l_partkey": "part"}),
}


@query(
    "j7_delete_graph",
    """WITH RECURSIVE links(child, parent) AS (
         SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
         UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders),
       gone(k) AS (SELECT 'r' || r_regionkey FROM region WHERE r_name = 'ASIA' UNION SELECT child FROM links JOIN gone ON parent = k)
       SELECT 'lineitem' AS kept, l_orderkey AS key, CAST(l_linenumber AS BIGINT) AS number FROM lineitem
       WHERE 'o' || l_orderkey NOT IN (SELECT k FROM gone) AND 's' || l_suppkey NOT IN (SELECT k FROM gone)
       UNION ALL SELECT 'orders', o_orderkey, 0 FROM orders WHERE 'o' || o_orderkey NOT IN (SELECT k FROM gone)
       UNION ALL SELECT 'part', p_partkey, 0 FROM part""",
)
def _(spark, sf):
    """A region goes, and with it nations, suppliers, customers, their orders and all lines of either."""
    kept = joins.delete_graph({n: v.table(spark, sf, n) for n in _STAR}, _STAR, "region", "r_name = 'ASIA'")
    rows = [("lineitem", "l_orderkey", F.col("l_linenumber")), ("orders", "o_orderkey", F.lit(0)), ("part", "p_partkey", F.lit(0))]
    return reduce(
        DataFrame.unionByName,
        [kept[n].select(F.lit(n).alias("kept"), F.col(k).alias("key"), c.cast("bigint").alias("number")) for n, k, c in rows],
    )


# --- table changes ---------------------------------------------------------------------


@query(
    "k1_append_new",
    f"""WITH last AS (SELECT symbol, max(ts) AS last FROM {v.STORED_BARS} GROUP BY symbol)
       SELECT symbol, ts, open, high, low, close, volume FROM {v.STORED_BARS} UNION ALL
       SELECT i.symbol, ts, open, high, low, close, volume FROM {v.INCOMING_BARS} i LEFT JOIN last ON i.symbol = last.symbol
       WHERE last IS NULL OR ts > last.last""",
)
def _(spark, sf):
    return ops.append_new(v.incoming_bars(spark, sf), v.stored_bars(spark, sf))


@query(
    "k1_append_new_prices",
    f"""WITH last AS (SELECT symbol, max(ts) AS last_ts FROM {v.STORED} GROUP BY symbol)
       SELECT symbol, ts, close, volume, event_id FROM {v.STORED} UNION ALL
       SELECT i.symbol, ts, close, volume, event_id FROM {v.INCOMING} i LEFT JOIN last ON i.symbol = last.symbol
       WHERE last_ts IS NULL OR ts > last_ts""",
)
def _(spark, sf):
    columns = ["symbol", "ts", "close", "volume", "event_id"]
    return ops.append_new(v.incoming(spark, sf).select(*columns), v.stored(spark, sf).select(*columns))


@query(
    "k2_reconcile_changes",
    f"""SELECT n.symbol, n.ts, o.open AS open_old, o.high AS high_old, o.low AS low_old, o.close AS close_old,
       n.open AS open_new, n.high AS high_new, n.low AS low_new, n.close AS close_new
       FROM {v.INCOMING_BARS} n JOIN {v.STORED_BARS} o ON n.symbol = o.symbol AND n.ts = o.ts
       WHERE abs(n.close - o.close) > 1e-4""",
)
def _(spark, sf):
    return ops.reconcile_changes(v.incoming_bars(spark, sf), v.stored_bars(spark, sf))


@query(
    "k2_reconcile",
    f"""SELECT symbol, ts, open, high, low, close, volume FROM {v.INCOMING_BARS} WHERE ts < TIMESTAMP '{v.BARS_CUTOFF}'""",
)
def _(spark, sf):
    return ops.reconcile(v.incoming_bars(spark, sf), v.stored_bars(spark, sf))


def _daily_scores(spark, sf):
    """Risk rows of the table: the mean price per user and day as score."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return v.prices(spark, sf).select(
        F.col("symbol").alias("company_code"),
        F.lit("Binseg").alias("model_name"),
        F.lit("Completed").alias("analysis_result"),
        F.lit(v.AS_OF).alias("test_date"),
        day.alias("predict_date"),
        round_score("close").alias("risk_score"),
        "event_id",
        "event_type",
    )


_SCORES = f"""(SELECT symbol AS company_code, 'Binseg' AS model_name, 'Completed' AS analysis_result, '{v.AS_OF}' AS test_date,
  strftime(ts, '%Y-%m-%d') AS predict_date, round_even(close, 4) AS risk_score, event_id, event_type FROM {v.PRICES})"""
_LAST_SCORE = "QUALIFY row_number() OVER (PARTITION BY company_code, predict_date ORDER BY event_id DESC) = 1"


@query(
    "k3_upsert",
    f"""WITH target AS (SELECT * FROM {_SCORES} WHERE event_type <> 'view' {_LAST_SCORE}),
       batch AS (SELECT * REPLACE ('Updated' AS analysis_result) FROM {_SCORES} WHERE event_type IN ('view', 'click') {_LAST_SCORE})
       SELECT company_code, model_name, coalesce(b.analysis_result, t.analysis_result) AS analysis_result, test_date, predict_date,
       coalesce(b.risk_score, t.risk_score) AS risk_score
       FROM target t FULL JOIN batch b USING (company_code, model_name, test_date, predict_date)""",
)
def _(spark, sf):
    scores = _daily_scores(spark, sf)
    target = ops.dedup_keep_last(scores.where("event_type <> 'view'"), ops.RISK_KEYS, ["event_id"]).drop("event_id", "event_type")
    batch = scores.where("event_type IN ('view', 'click')").withColumn("analysis_result", F.lit("Updated"))
    return ops.upsert(target, batch, order=["event_id"])


@query(
    "k3_upsert_table",
    f"""WITH target AS (SELECT * FROM {_SCORES} WHERE event_type <> 'view' {_LAST_SCORE}),
       batch AS (SELECT * REPLACE ('Updated' AS analysis_result) FROM {_SCORES} WHERE event_type IN ('view', 'click')
         AND predict_date < '2024-01-11' {_LAST_SCORE})
       SELECT company_code, model_name, coalesce(b.analysis_result, t.analysis_result) AS analysis_result, test_date, predict_date,
       coalesce(b.risk_score, t.risk_score) AS risk_score
       FROM target t FULL JOIN batch b USING (company_code, model_name, test_date, predict_date)""",
)
def _(spark, sf):
    """A stored table in folders of its days: the batch's days are written anew, the others stay as they are."""
    path = scratch_path(spark, "risk-table")
    scores = _daily_scores(spark, sf)
    target = ops.dedup_keep_last(scores.where("event_type <> 'view'"), ops.RISK_KEYS, ["event_id"]).drop("event_id", "event_type")
    target.write.partitionBy("predict_date").parquet(path)
    batch = scores.where("event_type IN ('view', 'click') AND predict_date < '2024-01-11'").withColumn("analysis_result", F.lit("Updated"))
    tables.upsert_table(batch, path, ops.RISK_KEYS, ops.RISK_VALUES, ["event_id"], ["predict_date"])
    back = spark.read.parquet(path)
    return back.withColumn("predict_date", F.date_format("predict_date", "yyyy-MM-dd"))


_CODES = "CASE WHEN company_code LIKE '%7' THEN NULL ELSE lpad(company_code, 6, '0') END AS company_code"


@query(
    "k3_upsert_odd_folders",
    f"""WITH scores AS (SELECT * REPLACE ({_CODES}) FROM {_SCORES}),
       target AS (SELECT * FROM scores WHERE event_type <> 'view' {_LAST_SCORE}),
       batch AS (SELECT * REPLACE ('Updated' AS analysis_result) FROM scores WHERE event_type IN ('view', 'click') {_LAST_SCORE})
       SELECT company_code, model_name, coalesce(b.analysis_result, t.analysis_result) AS analysis_result, test_date, predict_date,
       coalesce(b.risk_score, t.risk_score) AS risk_score
       FROM target t FULL JOIN batch b USING (company_code, model_name, test_date, predict_date)""",
)
def _(spark, sf):
    """Folders of codes such as 000042, which stay text, and one of no code, whose rows stay beside the new ones."""
    path = scratch_path(spark, "codes")
    scores = _daily_scores(spark, sf).withColumn("company_code", F.expr(_CODES))
    target = ops.dedup_keep_last(scores.where("event_type <> 'view'"), ops.RISK_KEYS, ["event_id"]).drop("event_id", "event_type")
    tables.write_folders(target, path, ["company_code"])
    batch = scores.where("event_type IN ('view', 'click')").withColumn("analysis_result", F.lit("Updated"))
    tables.upsert_table(batch, path, ops.RISK_KEYS, ops.RISK_VALUES, ["event_id"], ["company_code"])
    return tables.read_stored(spark, path)


_GROUPS = "'00590' || substr(symbol, 7, 1) AS symbol"


@query("f3_drop_old_days", f"SELECT {_GROUPS}, ts, close FROM {v.BARS} WHERE CAST(ts AS DATE) >= DATE '1998-06-15'")
def _(spark, sf):
    """In folders of symbol and month."""
    path = scratch_path(spark, "retained")
    tables.append_prices(v.bars(spark, sf).select(F.expr(_GROUPS), "ts", "close"), path)
    tables.drop_old_days(spark, path, 10, "1998-06-25")
    return tables.read_stored(spark, path).drop("month")


def _bar_table(spark, sf):
    path = scratch_path(spark, "bar-table")
    tables.append_prices(v.stored_bars(spark, sf), path, by=[])
    return path


@query(
    "k2_reconcile_table",
    f"""SELECT symbol, ts, coalesce(i.open, s.open) AS open, coalesce(i.high, s.high) AS high, coalesce(i.low, s.low) AS low,
       coalesce(i.close, s.close) AS close, s.volume FROM {v.STORED_BARS} s LEFT JOIN {v.INCOMING_BARS} i USING (symbol, ts)""",
)
def _(spark, sf):
    """Only the months with a corrected bar are written anew; the batch's new bars aren't added."""
    path = _bar_table(spark, sf)
    tables.reconcile_table(v.incoming_bars(spark, sf).withColumn("month", F.trunc("ts", "MM")), path)
    return tables.read_stored(spark, path).drop("month")


def _bar_history(spark, sf):
    name = f"bars_{uuid.uuid4().hex}"
    return history.create_history(v.stored_bars(spark, sf), name, scratch_path(spark, "history"), buckets=8)


@query(
    "k1_history",
    f"""SELECT symbol, ts, close, volume FROM {v.STORED_BARS}
       UNION ALL SELECT symbol, ts, close, volume FROM {v.INCOMING_BARS} WHERE ts >= TIMESTAMP '{v.BARS_CUTOFF}'""",
)
def _(spark, sf):
    """All bars arrive again in two batches; the history holds each once, in its buckets."""
    bars = _bar_history(spark, sf)
    for where in (f"ts < TIMESTAMP_NTZ '{v.BARS_CUTOFF}'", f"ts >= TIMESTAMP_NTZ '{v.BARS_CUTOFF}'"):
        history.append_new(bars, v.incoming_bars(spark, sf).where(where), ["close"])
    return bars.rows.select("symbol", "ts", "close", "volume")


@query(
    "k2_history",
    f"""SELECT symbol, ts, coalesce(i.close, s.close) AS close, s.volume
       FROM {v.STORED_BARS} s LEFT JOIN {v.INCOMING_BARS} i USING (symbol, ts)""",
)
def _(spark, sf):
    """A session that hasn't made the history opens it and takes corrected bars over."""
    made = _bar_history(spark, sf)
    bars = history.open_history(spark, f"{made.name}_again", made.path)
    history.reconcile_history(bars, v.incoming_bars(spark, sf))
    return bars.rows.select("symbol", "ts", "close", "volume")


@query(
    "f6_history",
    f"SELECT symbol, ts, close, volume FROM {v.INCOMING_BARS} WHERE ts >= TIMESTAMP '{v.BARS_CUTOFF}'",
)
def _(spark, sf):
    """New rows are told by the last times beside the history; no row of it is read."""
    return history.newer_rows(_bar_history(spark, sf), v.incoming_bars(spark, sf)).select("symbol", "ts", "close", "volume")


@query(
    "k4_update_table",
    f"""SELECT symbol, ts, CASE WHEN close > 1500 AND ts >= TIMESTAMP '1996-01-01' THEN close * 2 ELSE close END AS close, volume
       FROM {v.STORED_BARS}""",
)
def _(spark, sf):
    path = _bar_table(spark, sf)
    tables.update_table(spark, path, {"close": F.col("close") * 2}, "close > 1500 AND ts >= TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    return tables.read_stored(spark, path).select("symbol", "ts", "close", "volume")


@query(
    "k5_delete_rows",
    f"""SELECT symbol, ts, close FROM {v.STORED_BARS}
       WHERE NOT (ts < TIMESTAMP '1993-01-01' OR (symbol = 'Brand#11' AND ts < TIMESTAMP '1996-07-10'))""",
)
def _(spark, sf):
    """Folders that lose all their rows go, folders without a hit stay as they are."""
    path = _bar_table(spark, sf)
    where = "ts < TIMESTAMP_NTZ '1993-01-01 00:00:00' OR (symbol = 'Brand#11' AND ts < TIMESTAMP_NTZ '1996-07-10 00:00:00')"
    tables.delete_rows(spark, path, where)
    return tables.read_stored(spark, path).select("symbol", "ts", "close")


@query(
    "k3_load_risk",
    f"""WITH {_RISK}, days AS (SELECT DISTINCT symbol, strftime(ts, '%Y-%m-%d') AS day FROM {v.PRICES}),
       runs AS (SELECT symbol, day, unnest(['2024-01-30', '{v.AS_OF}']) AS test_date FROM days),
       fresh AS (SELECT symbol, strftime(ts, '%Y-%m-%d') AS day, round_even(risk_value, 4) AS score FROM risk
         QUALIFY row_number() OVER (PARTITION BY symbol, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) = 1)
       SELECT r.symbol AS company_code, 'Binseg' AS model_name, CASE WHEN test_date = '{v.AS_OF}' AND score IS NOT NULL THEN 'Completed'
         ELSE 'Stale' END AS analysis_result, test_date, r.day AS predict_date,
         CASE WHEN test_date = '{v.AS_OF}' AND score IS NOT NULL THEN score ELSE 0.0 END AS risk_score
       FROM runs r LEFT JOIN fresh f ON r.symbol = f.symbol AND r.day = f.day""",
)
def _(spark, sf):
    """Scores of one run go into a table that has stale rows of that run date and of the day before."""
    prices = v.prices(spark, sf)
    runs = F.explode(F.array(F.lit("2024-01-30"), F.lit(v.AS_OF)))
    days = prices.select(F.col("symbol").alias("company_code"), F.date_format("ts", "yyyy-MM-dd").alias("predict_date")).distinct()
    target = days.select(
        "company_code",
        F.lit("Binseg").alias("model_name"),
        F.lit("Stale").alias("analysis_result"),
        runs.alias("test_date"),
        "predict_date",
        F.lit(0.0).alias("risk_score"),
    )
    return risk.load_risk(target, risk.risk_scores(prices, tie=["event_id"], chunk_rows=risk.CHUNK_ROWS), v.AS_OF, tie=["event_id"])


@query(
    "k4_update_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'CLOSED' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def _(spark, sf):
    sets = {"o_orderpriority": "CLOSED", "o_totalprice": F.col("o_totalprice") * 2}
    out = ops.update_where(v.table(spark, sf, "orders"), sets, "o_orderstatus = 'F' AND o_totalprice > 100000")
    return out.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("k5_delete_where", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' OR o_totalprice < 5000)")
def _(spark, sf):
    return ops.delete_where(v.table(spark, sf, "orders"), "o_orderstatus = 'F' OR o_totalprice < 5000").select("o_orderkey", "o_totalprice")


@query(
    "k7_load_companies",
    f"""SELECT symbol AS company_code, upper(full_name) AS company_name, 'OLD' AS country, sector FROM {v.UNIVERSE} WHERE sector = 'ASIA'
       UNION ALL SELECT symbol, full_name, 'USA', coalesce(sector, '') FROM {v.UNIVERSE} WHERE sector IS NULL OR sector <> 'ASIA'""",
)
def _(spark, sf):
    companies = v.universe(spark, sf)
    existing = companies.where("sector = 'ASIA'").select(
        F.col("symbol").alias("company_code"), F.upper("full_name").alias("company_name"), F.lit("OLD").alias("country"), "sector"
    )
    return ops.load_companies(companies, existing, "USA")


# --- checks ----------------------------------------------------------------------------

_ORDERS = Table(
    (
        Field("o_orderkey", "bigint"),
        Field("o_orderstatus", "string", 1),
        Field("o_orderpriority", "string", 8),
        Field("o_clerk", "string", 20),
    ),
    ("o_orderkey",),
    {},
)


@query(
    "x5_check_contract",
    """SELECT 'missing_column' AS rule, unnest(['o_orderkey', 'o_orderstatus', 'o_orderpriority', 'o_clerk']) AS "column",
         unnest([0, 0, 0, 1])::BIGINT AS violations
       UNION ALL SELECT 'null', 'o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM orders
       UNION ALL SELECT 'null', 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM orders
       UNION ALL SELECT 'null', 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM orders
       UNION ALL SELECT 'too_long', 'o_orderstatus', count(*) FILTER (length(o_orderstatus) > 1) FROM orders
       UNION ALL SELECT 'too_long', 'o_orderpriority', count(*) FILTER (length(o_orderpriority) > 8) FROM orders
       UNION ALL SELECT 'negative', 'o_orderkey', count(*) FILTER (o_orderkey < 0) FROM orders
       UNION ALL SELECT 'repeated_key', 'o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders""",
)
def _(spark, sf):
    return quality.check_contract(v.table(spark, sf, "orders"), _ORDERS)


_LINES = Table((Field("l_orderkey", "bigint"), Field("l_linenumber", "int"), Field("l_quantity", "double")), ("l_orderkey", "l_linenumber"), {})


@query(
    "x5_check_repeated_keys",
    """SELECT 'missing_column' AS rule, unnest(['l_orderkey', 'l_linenumber', 'l_quantity']) AS "column", unnest([0, 0, 0])::BIGINT AS violations
       UNION ALL SELECT 'null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
       UNION ALL SELECT 'null', 'l_linenumber', count(*) FILTER (l_linenumber IS NULL) FROM lineitem
       UNION ALL SELECT 'null', 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem
       UNION ALL SELECT 'negative', 'l_orderkey', count(*) FILTER (l_orderkey < 0) FROM lineitem
       UNION ALL SELECT 'repeated_key', 'l_orderkey, l_linenumber', (SELECT count(*) FROM lineitem) - count(*)
         FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
)
def _(spark, sf):
    return quality.check_contract(v.table(spark, sf, "lineitem"), _LINES)
