"""Aggregates, windows, change points, risk and the price matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates, changepoint, joins, matrix, sets, tiles
from tidemark.operators import series as ops
from tidemark.plans import risk
from tidemark.queries import views as v
from tidemark.queries.registry import query, settle
from tidemark.session import scratch_path

# --- aggregates ------------------------------------------------------------------------

_LATEST = f"""SELECT symbol, ts, close, volume FROM {v.PRICES}
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) = 1"""


@query("a1_latest", _LATEST)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "close", "volume", "event_id")
    return aggregates.latest(rows, order=["ts", "event_id"]).drop("event_id")


@query("a1_latest_time", f"SELECT symbol, max(ts) AS last_ts FROM {v.PRICES} GROUP BY symbol")
def _(spark, sf):
    return aggregates.latest_time(v.prices(spark, sf))


@query(
    "a2_resample_daily",
    f"""SELECT symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, arg_max(close, ts) AS close
       FROM (SELECT * FROM {v.PRICES} WHERE event_type <> 'error') GROUP BY symbol, CAST(ts AS DATE)""",
)
def _(spark, sf):
    known = F.when(F.col("event_type") != "error", F.col("close"))
    daily = aggregates.resample_daily(v.prices(spark, sf).withColumn("close", known))
    return daily.withColumn("day", F.col("day").cast("string"))


@query(
    "a2_resample_daily_seoul",
    f"""SELECT symbol, CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS day, arg_max(close, ts) AS close
       FROM {v.PRICES} GROUP BY symbol, CAST(ts + INTERVAL 9 HOUR AS DATE)""",
)
def _(spark, sf):
    daily = aggregates.resample_daily(v.prices(spark, sf), market_tz="Asia/Seoul")
    return daily.withColumn("day", F.col("day").cast("string"))


def changes_sql(prices: str = v.PRICES) -> str:
    return f"""(SELECT * FROM (SELECT symbol, ts, event_id,
    (close - lag(close) OVER w) / (lag(close) OVER w + 1e-9) AS close_change,
    (volume - lag(volume) OVER w) / (lag(volume) OVER w + 1e-9) AS volume_change,
    row_number() OVER w - 2 AS i
  FROM {prices} WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id)) WHERE i >= 0)"""


_CHANGES = changes_sql()


@query(
    "a3_segment_volatility",
    f"""SELECT symbol, week AS seg, CAST(sqrt(pow(stddev_pop(close_change), 2) + pow(stddev_pop(volume_change), 2)) AS FLOAT)::DOUBLE
       AS volatility, count(*) AS n_rows
       FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS week FROM {_CHANGES}) GROUP BY symbol, week""",
)
def _(spark, sf):
    changes = ops.relative_change(v.prices(spark, sf), order=["ts", "event_id"])
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).cast("bigint")
    out = aggregates.segment_volatility(changes.withColumn("seg", week))
    return out.withColumn("volatility", settle("volatility"))


@query(
    "a4_minmax",
    f"""SELECT symbol, ts, event_id, CASE WHEN hi - lo < 1e-9 THEN 0.5 ELSE (close - lo) / (hi - lo) END AS scaled
       FROM (SELECT *, min(close) OVER (PARTITION BY symbol) AS lo, max(close) OVER (PARTITION BY symbol) AS hi FROM {v.PRICES})""",
)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "event_id", "close")
    return aggregates.minmax(rows, "close").drop("close")


@query(
    "a4_minmax_of_long_series",
    f"""SELECT symbol, ts, event_id, CASE WHEN hi - lo < 1e-9 THEN 0.5 ELSE (close - lo) / (hi - lo) END AS scaled
       FROM (SELECT *, min(close) OVER (PARTITION BY symbol) AS lo, max(close) OVER (PARTITION BY symbol) AS hi FROM {v.PRICES})""",
)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "event_id", "close")
    return aggregates.minmax(rows, "close", max_rows=60).drop("close")


@query(
    "a5_profile",
    f"SELECT symbol, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM {v.PRICES} GROUP BY symbol",
)
def _(spark, sf):
    return aggregates.profile(v.prices(spark, sf))


_PAIRS = f"""(SELECT a.symbol, a.i, b.i AS j,
    (a.close_change - b.close_change) * (a.close_change - b.close_change)
    + (a.volume_change - b.volume_change) * (a.volume_change - b.volume_change) AS d
  FROM changes a JOIN changes b ON a.symbol = b.symbol)"""


@query(
    "a7_pair_median",
    f"""WITH changes AS {_CHANGES}, pairs AS {_PAIRS}
       SELECT symbol, CAST(0 AS BIGINT) AS chunk, CAST(median(d) AS FLOAT)::DOUBLE AS pair_median
       FROM pairs WHERE i < j GROUP BY symbol""",
)
def _(spark, sf):
    changes = risk.chunk_changes(v.prices(spark, sf), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)
    out = changepoint.pair_medians(changes, ["symbol", "chunk"], ["ts", "event_id"], ["close_change", "volume_change"])
    return out.withColumn("pair_median", settle("pair_median"))


@query(
    "a7_whole_series",
    f"""WITH changes AS {_CHANGES}, pairs AS {_PAIRS}
       SELECT symbol, CAST(median(d) AS FLOAT)::DOUBLE AS pair_median FROM pairs WHERE i < j GROUP BY symbol""",
)
def _(spark, sf):
    """Whole series as tiles of 40 points."""
    changes = risk.whole_changes(v.prices(spark, sf), tie=["event_id"])
    out = tiles.pair_medians(changes, ["symbol"], ["close_change", "volume_change"], tile=40)
    return out.withColumn("pair_median", settle("pair_median"))


# --- windows ---------------------------------------------------------------------------


@query("w1_relative_change", f"SELECT symbol, ts, event_id, close_change, volume_change FROM {_CHANGES}")
def _(spark, sf):
    changes = ops.relative_change(v.prices(spark, sf), order=["ts", "event_id"])
    return changes.select("symbol", "ts", "event_id", "close_change", "volume_change")


@query("w1_relative_change_in_parts", f"SELECT symbol, ts, event_id, close_change, volume_change FROM {_CHANGES}")
def _(spark, sf):
    changes = ops.relative_change(v.prices(spark, sf), order=["ts", "event_id"], max_rows=20)
    return changes.select("symbol", "ts", "event_id", "close_change", "volume_change")


@query(
    "w2_ema",
    f"""WITH p AS (SELECT symbol, ts, event_id, close, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1 AS pos FROM {v.PRICES})
       SELECT a.symbol, a.ts, a.event_id, CAST(sum(CASE WHEN b.pos = 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END * b.close
         * pow(0.7::DOUBLE, a.pos - b.pos)) AS FLOAT)::DOUBLE AS ema
       FROM p a JOIN p b ON a.symbol = b.symbol AND b.pos <= a.pos GROUP BY a.symbol, a.ts, a.event_id""",
)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "event_id", "close")
    placed = ops.with_position(rows, ["symbol"], "ts", ["ts", "event_id"])
    return ops.ema(placed, "close", 0.3).select("symbol", "ts", "event_id", settle("ema").alias("ema"))


# Few long series: their first value is large, all others are 0.
_DOMINANT = f"""(SELECT event_type || '/' || (CAST(symbol AS BIGINT) % 5) AS symbol, ts, event_id,
  row_number() OVER (PARTITION BY event_type, CAST(symbol AS BIGINT) % 5 ORDER BY ts, event_id) - 1 AS pos FROM {v.PRICES})"""


@query(
    "w2_ema_long",
    f"""WITH p AS (SELECT symbol, ts, event_id, pos, CASE WHEN pos = 0 THEN 1000000.0::DOUBLE ELSE 0.0 END AS close FROM {_DOMINANT})
       SELECT a.symbol, a.ts, a.event_id, CAST(ln(sum(CASE WHEN b.pos = 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END * b.close
         * pow(0.7::DOUBLE, a.pos - b.pos))) AS FLOAT)::DOUBLE AS log_ema
       FROM p a JOIN p b ON a.symbol = b.symbol AND b.pos <= a.pos GROUP BY a.symbol, a.ts, a.event_id""",
)
def _(spark, sf):
    """Smoothing over several blocks, whatever is left of the first value; series numbered in parts of a few rows."""
    group = F.concat_ws("/", "event_type", (F.col("symbol").cast("bigint") % 5).cast("string"))
    rows = v.prices(spark, sf).select(group.alias("symbol"), "ts", "event_id")
    placed = ops.with_position(rows, ["symbol"], "ts", ["ts", "event_id"], max_rows=20)
    placed = placed.withColumn("close", F.when(F.col("pos") == 0, 1e6).otherwise(0.0))
    smooth = ops.ema(placed, "close", 0.3)
    return smooth.select("symbol", "ts", "event_id", settle(F.log("ema")).alias("log_ema"))


_DAILY = f"""daily AS (SELECT symbol, CAST(ts AS DATE) AS day, arg_max(close, ts) AS close FROM {v.PRICES} GROUP BY symbol, CAST(ts AS DATE)),
  grid AS (SELECT symbol, CAST(d AS DATE) AS day FROM (SELECT DISTINCT symbol FROM daily),
    (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM daily)),
  gaps AS (SELECT symbol, day, close FROM grid LEFT JOIN daily USING (symbol, day))"""
_AHEAD = "first_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_BEHIND = "last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _gaps(spark, sf):
    rows = v.prices(spark, sf)
    return joins.calendar_grid(rows).join(aggregates.resample_daily(rows), ["symbol", "day"], "left")


def _day_text(df):
    return df.withColumn("day", F.col("day").cast("string"))


@query("w3_bfill", f"WITH {_DAILY} SELECT symbol, CAST(day AS VARCHAR) AS day, {_AHEAD} AS close FROM gaps")
def _(spark, sf):
    return _day_text(ops.bfill(_gaps(spark, sf), "close"))


@query("w4_ffill", f"WITH {_DAILY} SELECT symbol, CAST(day AS VARCHAR) AS day, {_BEHIND} AS close FROM gaps")
def _(spark, sf):
    return _day_text(ops.ffill(_gaps(spark, sf), "close"))


@query("j6_calendar_grid", f"WITH {_DAILY} SELECT symbol, CAST(day AS VARCHAR) AS day FROM grid")
def _(spark, sf):
    return _day_text(joins.calendar_grid(v.prices(spark, sf)))


@query(
    "w5_last_n",
    """SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations
       QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 5""",
)
def _(spark, sf):
    rows = ops.last_n(v.table(spark, sf, "conversations"), 5)
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "w7_assign_ids",
    """SELECT 1000 + row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS id, o_orderkey, o_custkey
       FROM orders""",
)
def _(spark, sf):
    return ops.assign_ids(v.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000)


# --- change points and risk ------------------------------------------------------------


def segmentation_sql(n_bkps: int = 5, prices: str = v.PRICES) -> str:
    """Greedy segmentation in SQL: one round of CTEs per change point, whole kernel matrix."""
    parts = [
        f"changes AS {changes_sql(prices)}",
        f"pairs AS {_PAIRS}",
        "sizes AS (SELECT symbol, count(*) AS n FROM changes GROUP BY symbol HAVING count(*) >= 27)",
        "scale AS (SELECT symbol, CASE WHEN median(d) = 0 THEN 1.0 ELSE 1.0 / median(d) END AS g FROM pairs WHERE i < j GROUP BY symbol)",
        """kernel AS (SELECT symbol, i // 5 AS bi, j // 5 AS bj,
             sum(CASE WHEN i = j THEN 1.0::DOUBLE ELSE exp(-greatest(least(d * g, 100.0::DOUBLE), 0.01::DOUBLE)) END) AS k
             FROM pairs JOIN scale USING (symbol) JOIN sizes USING (symbol) GROUP BY symbol, i // 5, j // 5)""",
        "blocks AS (SELECT symbol, n, unnest(range(0, CAST(ceil(n / 5) AS BIGINT) + 1)) AS b FROM sizes)",
        """spans AS (SELECT x.symbol, x.b AS s, y.b AS e, least(y.b * 5, x.n) - x.b * 5 AS len
             FROM blocks x JOIN blocks y ON x.symbol = y.symbol AND x.b < y.b)""",
        """costs AS (SELECT symbol, s, e, len, len - sum(k) / len AS cost FROM spans JOIN kernel USING (symbol)
             WHERE bi >= s AND bi < e AND bj >= s AND bj < e GROUP BY symbol, s, e, len)""",
        """splits AS (SELECT p.symbol, p.s, p.e, l.e AS m, round(p.cost - l.cost - r.cost, 9) AS gain
             FROM costs p JOIN costs l ON l.symbol = p.symbol AND l.s = p.s AND l.e < p.e
             JOIN costs r ON r.symbol = p.symbol AND r.s = l.e AND r.e = p.e WHERE l.len >= 2 AND r.len >= 2)""",
        "cuts0 AS (SELECT symbol, 0 AS s, CAST(ceil(n / 5) AS BIGINT) AS e FROM sizes)",
    ]
    for k in range(n_bkps):
        parts.append(
            f"""best{k} AS (SELECT symbol, s, e, m FROM cuts{k} JOIN splits USING (symbol, s, e)
                QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY gain DESC, s, m DESC) = 1)"""
        )
        parts.append(
            f"""cuts{k + 1} AS (SELECT symbol, s, e FROM cuts{k} ANTI JOIN best{k} USING (symbol, s, e)
                UNION ALL SELECT symbol, s, m FROM best{k} UNION ALL SELECT symbol, m, e FROM best{k})"""
        )
    parts.append(
        f"""segments AS (SELECT symbol, s * 5 AS start_i, least(e * 5, n) AS end_i,
              row_number() OVER (PARTITION BY symbol ORDER BY s) - 1 AS seg FROM cuts{n_bkps} JOIN sizes USING (symbol))"""
    )
    return ",\n".join(parts)


_SEGMENTS = segmentation_sql()


@query(
    "w8_change_points",
    f"WITH {_SEGMENTS} SELECT symbol, CAST(0 AS BIGINT) AS chunk, CAST(seg AS INTEGER) AS seg, CAST(end_i AS INTEGER) AS end_i FROM segments",
)
def _(spark, sf):
    cuts = risk.segments(v.prices(spark, sf), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)
    return cuts.select("symbol", "chunk", F.posexplode(F.col("segments")["end_i"]).alias("seg", "end_i"))


@query(
    "w8_whole_series",
    f"WITH {_SEGMENTS} SELECT symbol, CAST(seg AS INTEGER) AS seg, CAST(end_i AS INTEGER) AS end_i FROM segments",
)
def _(spark, sf):
    """Whole series as tiles of 40 points."""
    changes = risk.whole_changes(v.prices(spark, sf), tie=["event_id"])
    cuts = tiles.change_points(changes, ["symbol"], tile=40)
    return cuts.select("symbol", F.posexplode(F.col("segments")["end_i"]).alias("seg", "end_i"))


_RISK_STEPS = """,
  marked AS (SELECT c.*, seg FROM changes c JOIN segments g ON c.symbol = g.symbol AND c.i >= start_i AND c.i < end_i),
  raw AS (SELECT symbol, i, ts, event_id, seg,
    sqrt(pow(stddev_pop(close_change) OVER s, 2) + pow(stddev_pop(volume_change) OVER s, 2)) AS raw
    FROM marked WINDOW s AS (PARTITION BY symbol, seg)),
  bounds AS (SELECT symbol, min(raw) AS lo, max(raw) AS hi FROM raw GROUP BY symbol),
  scaled AS (SELECT raw.*, CASE WHEN hi - lo < 1e-9 THEN 0.5 ELSE (raw - lo) / (hi - lo) END AS x FROM raw JOIN bounds USING (symbol)),
  smooth AS (SELECT a.symbol, a.ts, a.event_id, a.seg,
    sum(CASE WHEN b.i = 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END * b.x * pow(0.7::DOUBLE, a.i - b.i)) AS e
    FROM scaled a JOIN scaled b ON a.symbol = b.symbol AND b.i <= a.i GROUP BY a.symbol, a.ts, a.event_id, a.seg),
  risk AS (SELECT symbol, ts, event_id, seg, CASE WHEN e < 1e-5 THEN 0.0 ELSE e END * 100.0 AS risk_value FROM smooth)"""
_RISK = _SEGMENTS + _RISK_STEPS
# Chunks of 40 points; fewer than 28 at the end of a series belong to the chunk before them.
_IN_CHUNKS = f"""(SELECT symbol || '#' || least((row_number() OVER w - 1) // 40, greatest((count(*) OVER (PARTITION BY symbol) - 28) // 40, 0)) AS symbol,
  ts, event_id, close, volume FROM {v.PRICES} WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id))"""
_CHUNKED_RISK = segmentation_sql(prices=_IN_CHUNKS) + _RISK_STEPS


@query(
    "w9_risk_scores",
    f"WITH {_RISK} SELECT symbol, ts, CAST(seg AS INTEGER) AS seg, CAST(risk_value AS FLOAT)::DOUBLE AS risk_value FROM risk",
)
def _(spark, sf):
    scores = risk.risk_scores(v.prices(spark, sf), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)
    return scores.select("symbol", "ts", "seg", settle("risk_value").alias("risk_value"))


@query(
    "w9_whole_series",
    f"WITH {_RISK} SELECT symbol, ts, CAST(seg AS INTEGER) AS seg, CAST(risk_value AS FLOAT)::DOUBLE AS risk_value FROM risk",
)
def _(spark, sf):
    """Whole series; those above 100 points are spread as tiles."""
    scores = risk.risk_scores(v.prices(spark, sf), tie=["event_id"], chunk_rows=None, one_task=100)
    return scores.select("symbol", "ts", "seg", settle("risk_value").alias("risk_value"))


@query(
    "w9_chunked",
    f"""WITH {_CHUNKED_RISK} SELECT split_part(symbol, '#', 1) AS symbol, CAST(split_part(symbol, '#', 2) AS BIGINT) AS chunk, ts, event_id,
       CAST(seg AS INTEGER) AS seg, CAST(risk_value AS FLOAT)::DOUBLE AS risk_value FROM risk""",
)
def _(spark, sf):
    """Series of two and more chunks, numbered in parts of a few rows: no point but the first of a chunk is left out."""
    scores = risk.risk_scores(v.prices(spark, sf), tie=["event_id"], chunk_rows=40, max_rows=20)
    return scores.withColumn("risk_value", settle("risk_value"))


@query(
    "w9_score_changed",
    f"""WITH {_CHUNKED_RISK} SELECT split_part(symbol, '#', 1) AS symbol, CAST(split_part(symbol, '#', 2) AS BIGINT) AS chunk, ts, event_id,
       CAST(seg AS INTEGER) AS seg, CAST(risk_value AS FLOAT)::DOUBLE AS risk_value FROM risk""",
)
def _(spark, sf):
    """Prices of the first weeks are scored, then all: the second run scores the chunks that have changed."""
    path = scratch_path(spark, "changed")
    prices = v.prices(spark, sf)
    for some in (prices.where(F.col("ts") < v.ntz(v.CUTOFF)), prices):
        scores = risk.score_changed(some, path, tie=["event_id"], chunk_rows=40)
    return scores.withColumn("risk_value", settle("risk_value"))


@query(
    "w9_current_risk",
    f"""WITH {_RISK} SELECT symbol, ts, round_even(risk_value, 4) AS risk_score FROM risk
       QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) = 1""",
)
def current_risk(spark, sf):
    return risk.current_risk(v.prices(spark, sf), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)


@query(
    "w9_unscored_chunks",
    f"""SELECT symbol, CAST(0 AS BIGINT) AS chunk, count(*) AS n_points, 'too few points' AS reason
       FROM {v.PRICES} WHERE event_type IN ('view', 'click') GROUP BY symbol HAVING count(*) <= 27
       UNION ALL SELECT symbol, NULL, count(*), 'no close or volume' FROM {v.PRICES}
       WHERE event_type NOT IN ('view', 'click') GROUP BY symbol""",
)
def _(spark, sf):
    known = F.when(F.col("event_type").isin("view", "click"), F.col("close"))
    return risk.unscored_chunks(v.prices(spark, sf).withColumn("close", known), tie=["event_id"], chunk_rows=risk.CHUNK_ROWS)


# --- matrix ----------------------------------------------------------------------------


@query(
    "w10_price_matrix_long",
    f"WITH {_DAILY} SELECT symbol, CAST(day AS VARCHAR) AS day, coalesce({_AHEAD}, {_BEHIND}) AS close FROM gaps",
)
def _(spark, sf):
    return _day_text(matrix.price_matrix_long(v.prices(spark, sf)))


def _wide(value: str) -> str:
    return ", ".join(f"max(CASE WHEN symbol = '{b}' THEN {value} END) AS \"{b}\"" for b in v.BRANDS)


_DAILY_TRADES = f"""first_trade AS (SELECT symbol, ts, first(price ORDER BY {v._ORDER}) AS close FROM {v.TRADES} GROUP BY symbol, ts),
  daily AS (SELECT symbol, CAST(ts AS DATE) AS day, arg_max(close, ts) AS close FROM first_trade GROUP BY symbol, CAST(ts AS DATE)),
  grid AS (SELECT symbol, CAST(d AS DATE) AS day FROM (SELECT DISTINCT symbol FROM daily),
    (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM daily)),
  gaps AS (SELECT symbol, day, close FROM grid LEFT JOIN daily USING (symbol, day)),
  full_days AS (SELECT symbol, day, coalesce({_AHEAD}, {_BEHIND}) AS close FROM gaps)"""


@query(
    "w10_price_matrix",
    f"WITH {_DAILY_TRADES} SELECT CAST(day AS VARCHAR) AS day, {_wide('close')} FROM full_days GROUP BY day",
)
def _(spark, sf):
    rows = v.trades(spark, sf).withColumn("close", F.col("price"))
    return _day_text(matrix.price_matrix(rows, v.brands(spark, sf), order=list(v.TRADE_ORDER)))


@query("j4_align", f"SELECT ts, {_wide('close')} FROM {v.BARS} GROUP BY ts")
def _(spark, sf):
    return joins.align(v.bars(spark, sf), v.brands(spark, sf), ["open", "high", "low", "close"])


@query("o3_top1_by_date", _LATEST)
def _(spark, sf):
    rows = v.prices(spark, sf).select("symbol", "ts", "close", "volume", "event_id")
    return aggregates.latest(rows, order=["ts", "event_id"]).drop("event_id")


@query(
    "o5_tail_n",
    f"SELECT symbol, ts, close FROM {v.PRICES} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) <= 5",
)
def _(spark, sf):
    rows = ops.last_n(v.prices(spark, sf).select("symbol", "ts", "close", "event_id"), 5, ["symbol"], ["ts", "event_id"])
    return sets.sort_by_time(rows, "ts", ["event_id"]).drop("event_id")
