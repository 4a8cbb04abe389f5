"""Scans, sinks, feeds, the universe and user functions per series."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cleaning, perseries
from tidemark.plans import risk
from tidemark.queries import views as v
from tidemark.queries.registry import query
from tidemark.queries.series import _RISK
from tidemark.session import scratch_path
from tidemark.sources import feeds, files, tables, universe
from tidemark.sources.feedsource import FileFeed, register_feed

_ALL_BARS = f"SELECT symbol, ts, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM {v.BARS}"


@query("s1_read_prices", _ALL_BARS)
def _(spark, sf):
    path = scratch_path(spark, "price-files")
    files.write_price_files(v.bars(spark, sf), path)
    return files.read_prices(spark, path)


@query(
    "s1_read_prices_by_name",
    f"""SELECT symbol, ts, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM {v.BARS} WHERE symbol < 'Brand#2'""",
)
def _(spark, sf):
    """Files with other orders of columns and further columns; files without a date give nothing."""
    path = scratch_path(spark, "mixed-files")
    bars = v.bars(spark, sf).withColumn("date", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS+00:00"))
    bars = bars.withColumn("note", F.lit("x,y"))
    layouts = [
        ("symbol < 'Brand#12'", ["date", "close", "open", "high", "low", "volume"]),
        ("symbol >= 'Brand#12' AND symbol < 'Brand#2'", ["date", "note", "Volume", "high", "open", "low", "close"]),
        ("symbol >= 'Brand#2'", ["open", "high", "low", "close", "volume"]),
    ]
    for where, columns in layouts:
        rows = bars.where(where).select("symbol", *columns)
        rows.write.mode("append").option("header", True).partitionBy("symbol").csv(path)
    return files.read_prices(spark, path)


@query(
    "s1_read_wide_prices",
    f"""SELECT symbol, ts, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM {v.BARS} WHERE symbol >= 'Brand#2'""",
)
def _(spark, sf):
    """Files of 75 columns whose date is the last; in the others the header isn't the first line."""
    path = scratch_path(spark, "wide-files")
    bars = v.bars(spark, sf).withColumn("date", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS+00:00"))
    names = ["open", "high", "low", "close", "volume"]
    notes = {f"note{i}": F.lit(f"{i}, x") for i in range(69)}
    wide = bars.where("symbol >= 'Brand#2'").withColumns(notes).select("symbol", *names, *notes, "date")
    wide.write.option("header", True).partitionBy("symbol").csv(path)
    lines = bars.where("symbol < 'Brand#2'").select("symbol", F.concat_ws(",", "date", *names).alias("line"))
    head = F.lit("exported by hand\n" + ",".join(["date", *names]) + "\n")
    texts = lines.groupBy("symbol").agg(F.concat(head, F.array_join(F.collect_list("line"), "\n")).alias("value"))
    texts.write.partitionBy("symbol").text(f"{path}/late")
    return files.read_prices(spark, path)


_DIGITS = "'00590' || substr(symbol, 7, 1) AS symbol"


@query(
    "s2_read_prices_range",
    f"""SELECT {_DIGITS}, ts, close, volume FROM {v.BARS}
       WHERE ts >= TIMESTAMP '1998-03-15 00:00:00' AND ts <= TIMESTAMP '1999-07-10 00:00:00'""",
)
def _(spark, sf):
    """In folders of symbols such as 005901, which stay text."""
    path = scratch_path(spark, "price-months")
    tables.append_prices(v.bars(spark, sf).withColumn("symbol", F.expr(_DIGITS)), path)
    return tables.read_prices_range(spark, path, "1998-03-15", "1999-07-10").select("symbol", "ts", "close", "volume")


@query("s3_append_prices", f"SELECT symbol, ts, open, high, low, close, volume FROM {v.BARS}")
def _(spark, sf):
    path = scratch_path(spark, "price-table")
    stored = v.stored_bars(spark, sf)
    tables.append_prices(stored, path, by=[])
    tables.append_prices(v.bars(spark, sf).where(F.col("ts") >= v.ntz(v.BARS_CUTOFF)), path, by=[])
    return spark.read.parquet(path).drop("month")


def _feed(spark, sf):
    """Trades as a raw feed: capital names with blanks, many rows per day."""
    names = {"ts": "Date", "price": "Close", "quantity": "Trade Volume"}
    return v.trades(spark, sf).withColumnsRenamed(names)


@query(
    "s4_normalize_us_prices",
    f"""SELECT symbol, ts + INTERVAL 5 HOUR AS ts, price AS close, quantity AS trade_volume FROM {v.TRADES}
       QUALIFY row_number() OVER (PARTITION BY symbol, ts
         ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, price DESC, quantity DESC) = 1""",
)
def _(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "close", "trade_volume"]
    rows = feeds.normalize("us_prices", _feed(spark, sf), zone="-05:00", order=order)
    return rows.select("symbol", "ts", "close", "trade_volume")


@query(
    "s5_normalize_kr_prices",
    f"SELECT symbol, ts - INTERVAL 9 HOUR AS ts, price AS close, quantity AS trade_volume FROM {v.TRADES}",
)
def _(spark, sf):
    return feeds.normalize("kr_prices", _feed(spark, sf)).select("symbol", "ts", "close", "trade_volume")


@query(
    "s6_normalize_json_prices",
    f"""SELECT symbol, date_trunc('minute', ts) AS ts, event_id AS seq, CASE WHEN event_type <> 'error' THEN close END AS close,
       CAST(volume AS DOUBLE) AS volume FROM {v.PRICES} WHERE event_type <> 'signup'
       QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts) ORDER BY event_id DESC) = 1""",
)
def _(spark, sf):
    value = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:00").alias("datetime"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("close").cast("string")).alias("close"),
        F.col("volume").cast("string").alias("volume"),
    )
    answer = F.when(F.col("event_type") == "signup", F.lit('{"status": "error"}')).otherwise(F.to_json(F.struct(F.array(value).alias("values"))))
    raw = v.prices(spark, sf).select("symbol", F.col("event_id").alias("seq"), answer.alias("payload"))
    return feeds.normalize("json_prices", raw).select("symbol", "ts", "seq", "close", "volume")


@query(
    "s11_universe",
    f"""SELECT symbol, full_name, exchange, sector, '1d' AS "interval", '1970-01-01' AS start_date,
       CASE WHEN sector = 'ASIA' THEN '2023-12-31' ELSE '{v.AS_OF}' END AS end_date FROM {v.UNIVERSE}""",
)
def _(spark, sf):
    items = v.universe(spark, sf).withColumn("end_date", F.when(F.col("sector") == "ASIA", F.lit("2023-12-31")))
    defaults = {"interval": "1d", "start_date": "1970-01-01", "end_date": "TODAY"}
    return universe.inherit_defaults(items, defaults, v.AS_OF)


@query(
    "x1_load_feeds",
    f"""SELECT symbol, ts, price AS close, quantity AS trade_volume FROM {v.TRADES}
       QUALIFY row_number() OVER (PARTITION BY symbol, ts
         ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, price DESC, quantity DESC) = 1
       UNION ALL SELECT symbol, ts - INTERVAL 9 HOUR, price, quantity FROM {v.TRADES}""",
)
def _(spark, sf):
    raw = _feed(spark, sf)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "close", "trade_volume"]
    raws = [("us_prices", raw, {"order": order}), ("kr_prices", raw, {}), ("unknown", raw, {})]
    return feeds.load_feeds(raws, ["symbol", "ts", "close", "trade_volume"])


@query("s12_read_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def _(spark, sf):
    rows = tables.read_table(spark, f"{sf}/orders.parquet", "o_orderstatus = 'F' AND o_totalprice > 100000")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "s13_insert_rows",
    f"""SELECT symbol, ts, close, volume FROM {v.STORED_BARS}
       UNION ALL SELECT symbol, ts, close, volume FROM {v.INCOMING_BARS} WHERE ts >= TIMESTAMP '{v.BARS_CUTOFF}'""",
)
def _(spark, sf):
    path = scratch_path(spark, "stored-bars")
    columns = ["symbol", "ts", "close", "volume"]
    v.stored_bars(spark, sf).select(*columns).write.parquet(path)
    tables.insert_rows(v.incoming_bars(spark, sf).select(*columns), path, ["symbol", "ts"], ["close"])
    return spark.read.parquet(path)


@query(
    "s13_insert_groups",
    f"""WITH batch AS (SELECT symbol, ts, close, volume FROM {v.INCOMING_BARS} WHERE ts >= TIMESTAMP '{v.BARS_CUTOFF}' OR symbol < 'Brand#2')
       SELECT symbol, ts, close, volume FROM {v.STORED_BARS}
       UNION ALL SELECT symbol, ts, close, volume FROM batch WHERE symbol >= 'Brand#2' AND symbol <> 'Brand#55'""",
)
def _(spark, sf):
    """Series that bring a stored day, or one of their days twice, add nothing; the others add all they have."""
    path = scratch_path(spark, "stored-groups")
    columns = ["symbol", "ts", "close", "volume"]
    tables.append_prices(v.stored_bars(spark, sf).select(*columns), path, by=[])
    batch = v.incoming_bars(spark, sf).where(f"ts >= TIMESTAMP_NTZ '{v.BARS_CUTOFF}' OR symbol < 'Brand#2'").select(*columns)
    batch = batch.unionByName(batch.where("symbol = 'Brand#55'")).withColumn("month", F.trunc("ts", "MM"))
    tables.insert_groups(batch, path, ["symbol", "ts"])
    return tables.read_stored(spark, path).drop("month")


@query(
    "s14_write_risk",
    f"""WITH {_RISK} SELECT symbol, strftime(ts, '%Y-%m-%d') AS predict_date, count(*) AS n_rows,
       CAST(sum(risk_value) AS FLOAT)::DOUBLE AS total, 'Completed' AS analysis_result FROM risk GROUP BY ALL""",
)
def _(spark, sf):
    path = scratch_path(spark, "risk-files")
    scores = risk.risk_scores(v.prices(spark, sf), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)
    stamped = cleaning.stamp_risk(scores, v.AS_OF, keep=["symbol"]).withColumn("country", F.lit("USA"))
    files.write_risk(stamped, path)
    back = files.read_risk(spark, path)
    totals = back.groupBy("symbol", "predict_date", "analysis_result").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("risk_score").cast("float").cast("double").alias("total")
    )
    return totals


# --- user functions --------------------------------------------------------------------

_RANGE = T.StructType([T.StructField("lowest", T.DoubleType()), T.StructField("highest", T.DoubleType())])


def _price_range(pdf):
    lowest, highest = pdf["close"].min(), pdf["close"].max()
    if highest > 300:
        raise ValueError("price above 300")
    return pd.DataFrame({"lowest": [lowest], "highest": [highest]})


@query(
    "x3_apply_per_series",
    f"""SELECT symbol, CAST(0 AS BIGINT) AS chunk, CASE WHEN max(close) <= 300 THEN min(close) END AS lowest,
       CASE WHEN max(close) <= 300 THEN max(close) END AS highest,
       CASE WHEN max(close) > 300 THEN 'ValueError: price above 300' END AS error FROM {v.PRICES} GROUP BY symbol""",
)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "close")
    return perseries.apply_per_series(rows, _price_range, _RANGE)


@query(
    "x3_long_series",
    f"""SELECT event_type AS symbol, CAST(0 AS BIGINT) AS chunk, min(close) AS lowest, max(close) AS highest, CAST(NULL AS VARCHAR) AS error
       FROM {v.PRICES} GROUP BY event_type""",
)
def _(spark, sf):
    """A few series that hold all rows: one call each."""

    def both_ends(pdf):
        return pd.DataFrame({"lowest": [pdf["close"].min()], "highest": [pdf["close"].max()]})

    rows = v.prices(spark, sf).select(F.col("event_type").alias("symbol"), "ts", "close")
    return perseries.apply_per_series(rows, both_ends, _RANGE)


@query(
    "x3_fold_series",
    f"""SELECT event_type AS symbol, count(*) AS n, arg_min(close, (ts, event_id)) AS first, arg_max(close, (ts, event_id)) AS last,
       min(close) AS lowest, max(close) AS highest, CAST(NULL AS VARCHAR) AS error FROM {v.PRICES} GROUP BY event_type""",
)
def _(spark, sf):
    """A few series that hold all rows, in parts of some hundred rows."""

    def step(state, pdf):
        close = pdf["close"]
        return merge(state, [len(close), close.iloc[0], close.iloc[-1], close.min(), close.max()])

    def merge(a, b):
        if a is None or b is None:
            return a or b
        return [a[0] + b[0], a[1], b[2], min(a[3], b[3]), max(a[4], b[4])]

    def finish(state):
        return pd.DataFrame([state], columns=["n", "first", "last", "lowest", "highest"])

    schema = T.StructType.fromDDL("n BIGINT, first DOUBLE, last DOUBLE, lowest DOUBLE, highest DOUBLE")
    rows = v.prices(spark, sf).select(F.col("event_type").alias("symbol"), "ts", "event_id", "close")
    return perseries.fold_per_series(rows, lambda: None, step, merge, finish, schema, order=["ts", "event_id"], max_rows=500)


@query(
    "x1_feed_source",
    f"""SELECT symbol, ts, close, volume FROM {v.BARS} WHERE symbol < 'Brand#2'
       UNION ALL SELECT symbol, ts, close, volume FROM {v.BARS} WHERE symbol < 'Brand#2'""",
)
def _(spark, sf):
    """Answers of a feed, one per series and year, read as a batch and as a stream and normalised."""
    home = scratch_path(spark, "feed")
    bars = v.bars(spark, sf).where("symbol < 'Brand#2'")
    value = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("datetime"), *[F.col(c).cast("string").alias(c) for c in ("close", "volume")])
    answers = bars.groupBy("symbol", F.year("ts").alias("year")).agg(F.to_json(F.struct(F.collect_list(value).alias("values"))).alias("payload"))
    answers.write.partitionBy("symbol", "year").text(f"{home}/answers")
    name = f"bars_{uuid.uuid4().hex}"
    register_feed(spark, name, FileFeed(f"{home}/answers"))
    source = spark.readStream.format(name).load()
    query_ = source.writeStream.format("parquet").option("path", f"{home}/rows").option("checkpointLocation", f"{home}/progress")
    query_.trigger(availableNow=True).start().awaitTermination()
    rows = [spark.read.format(name).load(), spark.read.schema(source.schema).parquet(f"{home}/rows")]
    normal = [feeds.normalize("json_prices", r.drop("error")).select("symbol", "ts", "close", F.col("volume").cast("bigint").alias("volume")) for r in rows]
    return normal[0].unionByName(normal[1])


@query(
    "x4_load_series",
    f"""SELECT symbol, ts, close FROM {v.PRICES} WHERE ts >= TIMESTAMP '{v.AS_OF}' - INTERVAL 3 DAY AND ts <= TIMESTAMP '{v.AS_OF}'""",
)
def _(spark, sf):
    return perseries.load_series(v.prices(spark, sf), 3, v.AS_OF).select("symbol", "ts", "close")
