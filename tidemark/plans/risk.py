"""Risk of price series: changes, change points, volatility, scaling and smoothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import drop_nan, round_score
from tidemark.operators import tiles
from tidemark.operators.aggregates import latest, scale_between
from tidemark.operators.changes import RISK_VALUES, upsert
from tidemark.operators.changepoint import change_points, shortest_series
from tidemark.operators.cleaning import stamp_risk
from tidemark.operators.dedup import dedup_keep_last
from tidemark.operators.series import ROWS_PER_TASK, change_of, ema_levels, join_group, relative_change, with_chunk, with_position
from tidemark.session import shuffle_tasks, stored

CHUNK_ROWS = 10_000
#: Points of a whole series up to which its kernel is left to one task.
WHOLE_POINTS = 10_000


def _known(prices: DataFrame) -> DataFrame:
    """The points with a close and a volume."""
    return prices.withColumns({"close": drop_nan("close"), "volume": drop_nan("volume")}).dropna(subset=["close", "volume"])


def chunk_changes(
    prices: DataFrame,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    tie: Sequence[str] = (),
    n_bkps: int = 5,
    *,
    chunk_rows: int,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Relative changes of close and volume inside every chunk; the first row of a chunk has none.

    Points without a close or volume are left out first. A series is cut into chunks of
    `chunk_rows` points; what is too short at its end for `n_bkps` splits
    belongs to the chunk before it.
    """
    chunked = _chunked(prices, keys, ts, tie, n_bkps, chunk_rows, max_rows)
    return _changes_inside(chunked, keys, ts, tie)


def _chunked(prices: DataFrame, keys, ts: str, tie, n_bkps: int, chunk_rows: int, max_rows: int) -> DataFrame:
    """The known points with the number of their chunk."""
    least = shortest_series(n_bkps) + 1
    return with_chunk(_known(prices).select(*keys, ts, *tie, "close", "volume"), keys, ts, [ts, *tie], chunk_rows, least, max_rows, prices)


def _changes_inside(chunked: DataFrame, keys, ts: str, tie) -> DataFrame:
    by = [*keys, "chunk"]
    previous = Window.partitionBy(*by).orderBy(ts, *tie)
    return (
        chunked.repartition(shuffle_tasks(chunked.sparkSession), *by)
        .withColumn("_prev", F.lag(F.struct("close", "volume")).over(previous))
        .where(F.col("_prev").isNotNull())
        .select(
            *by,
            ts,
            *tie,
            change_of("close", F.col("_prev.close")).alias("close_change"),
            change_of("volume", F.col("_prev.volume")).alias("volume_change"),
        )
    )


def whole_changes(
    prices: DataFrame,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    tie: Sequence[str] = (),
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Relative changes of close and volume along whole series of any length, numbered by `pos`."""
    known = _known(prices).select(*keys, ts, *tie, "close", "volume")
    changes = relative_change(known, ["close", "volume"], keys, ts, [ts, *tie], max_rows)
    return with_position(changes.drop("close", "volume"), keys, ts, [ts, *tie], max_rows=max_rows)


def segments(prices: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "ts", tie: Sequence[str] = (), n_bkps: int = 5, *, chunk_rows: int, max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """One row per chunk with its changes in order and its segments."""
    changes = chunk_changes(prices, keys, ts, tie, n_bkps, chunk_rows=chunk_rows, max_rows=max_rows)
    return change_points(changes, [*keys, "chunk"], [ts, *tie], n_bkps=n_bkps)


def whole_segments(
    changes: DataFrame,
    keys: Sequence[str] = ("symbol",),
    n_bkps: int = 5,
    *,
    one_task: int = WHOLE_POINTS,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per series with its segments, whatever its length (see whole_changes).

    Series up to `one_task` points are taken whole by a task; the kernel of longer ones is spread as tiles.
    """
    sizes = stored(changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    long_series = F.coalesce(F.col("_n") > one_task, F.lit(False))
    rows = join_group(changes, sizes, keys, "_n", max_rows)
    features = ["close_change", "volume_change"]
    found = change_points(rows.where(~long_series), keys, ["pos"], features, n_bkps).select(*keys, "segments")
    if sizes.where(long_series).isEmpty():
        return found
    return found.unionByName(tiles.change_points(rows.where(long_series), keys, features, n_bkps=n_bkps, max_rows=max_rows))


def _with_levels(cuts: DataFrame, alpha: float) -> DataFrame:
    """`segments` scaled between the lowest and the highest volatility and smoothed up to their begin, as `levels`."""
    volatility = F.col("segments")["volatility"]
    lo, hi = F.array_min(volatility), F.array_max(volatility)
    levels = F.transform(
        "segments",
        lambda s: F.struct(s["start_i"].alias("start_i"), s["end_i"].alias("end_i"), scale_between(s["volatility"], lo, hi).alias("level")),
    )
    return cuts.withColumn("levels", ema_levels(levels, alpha))


def _smoothed(s: Column, k: Column, alpha: float) -> Column:
    """The score of the point `k` of a segment, 0 to 100."""
    smooth = s["level"] + (s["before"] - s["level"]) * F.pow(F.lit(1.0 - alpha), k + 1)
    return F.when(smooth < 1e-5, F.lit(0.0)).otherwise(smooth) * 100.0


def risk_scores(
    prices: DataFrame,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    tie: Sequence[str] = (),
    n_bkps: int = 5,
    alpha: float = 0.3,
    *,
    chunk_rows: int | None = CHUNK_ROWS,
    max_rows: int = ROWS_PER_TASK,
    one_task: int = WHOLE_POINTS,
) -> DataFrame:
    """Risk 0..100 per price point: (keys, chunk, ts, tie, seg, risk_value).

    A series is scored in chunks of `chunk_rows` points, as many as its files have (CHUNK_ROWS), or whole (None, chunk 0);
    scores depend on the choice. The work grows with the square of what is scored at once: a chunk is one task, a whole
    series above `one_task` points is spread over tasks as tiles. Rows are shuffled once to number them
    and once by (series, chunk). Volatility is constant on a segment, so scaling and
    smoothing work on a handful of segments per chunk and the rows are unfolded last.
    Chunks too short for the splits give no rows (see unscored_chunks).
    """
    if chunk_rows is None:
        changes = stored(whole_changes(prices, keys, ts, tie, max_rows), "changes")
        cuts = _with_levels(whole_segments(changes, keys, n_bkps, one_task=one_task, max_rows=max_rows), alpha)
        cuts = stored(cuts.withColumn("_n", F.element_at("levels", -1)["end_i"].cast("bigint")).drop("segments"), "levels")
        rows = join_group(changes, cuts, keys, "_n", max_rows, "inner")
        seg = F.size(F.filter("levels", lambda s: s["end_i"] <= F.col("pos")))
        rows = rows.withColumn("seg", seg).withColumn("_s", F.get("levels", F.col("seg")))
        value = _smoothed(F.col("_s"), F.col("pos") - F.col("_s.start_i"), alpha)
        return rows.select(*keys, F.lit(0).cast("bigint").alias("chunk"), ts, *tie, "seg", value.alias("risk_value"))
    changes = chunk_changes(prices, keys, ts, tie, n_bkps, chunk_rows=chunk_rows, max_rows=max_rows)
    return _chunk_scores(changes, keys, ts, tie, n_bkps, alpha)


def _chunk_scores(changes: DataFrame, keys, ts: str, tie, n_bkps: int, alpha: float) -> DataFrame:
    by = [*keys, "chunk"]
    cuts = _with_levels(change_points(changes, by, [ts, *tie], n_bkps=n_bkps), alpha)
    per_segment = cuts.select(*by, "points", F.posexplode("levels").alias("seg", "_s"))
    inside = F.slice("points", F.col("_s.start_i") + 1, F.col("_s.end_i") - F.col("_s.start_i"))
    rows = per_segment.select(*by, "seg", "_s", F.posexplode(inside).alias("_k", "_p"))
    value = _smoothed(F.col("_s"), F.col("_k"), alpha)
    return rows.select(*by, *[F.col(f"_p.{c}").alias(c) for c in (ts, *tie)], "seg", value.alias("risk_value"))


#: Runs of score_changed are numbered; what a run found is below these folders.
SNAPSHOTS, SCORES = "chunks", "scores"


def _runs(spark, path: str) -> list[int]:
    """The finished runs below `path`."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SNAPSHOTS}/run=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def score_changed(
    prices: DataFrame,
    path: str,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    tie: Sequence[str] = (),
    n_bkps: int = 5,
    alpha: float = 0.3,
    *,
    chunk_rows: int = CHUNK_ROWS,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """`risk_scores` in chunks, of which only those whose points changed since the last run are scored; returns all scores.

    A run keeps below `path` a digest of every chunk with the number of the run that scored it, and the scores of the chunks
    that it scored itself. A run that was stopped leaves no digests and is done again by the next one. Use a path for one
    choice of options only.
    """
    spark = prices.sparkSession
    by, runs = [*keys, "chunk"], _runs(spark, path)
    chunked = _chunked(prices, keys, ts, tie, n_bkps, chunk_rows, max_rows)
    point = F.xxhash64(ts, *tie, "close", "volume")
    digests = chunked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("points"), F.bit_xor(point).alias("digest"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    name = F.md5(F.to_json(F.struct(*by)))
    seen = digests.withColumns({"_name": name, "run": F.lit(None).cast("int")}).limit(0)
    if runs:
        seen = spark.read.schema(seen.schema).parquet(f"{path}/{SNAPSHOTS}/run={runs[-1]}")
    mark = ["points", "digest", "first", "last"]
    before = seen.select("_name", F.struct(*mark).alias("_before"), "run")
    run = runs[-1] + 1 if runs else 0
    same = F.coalesce(F.struct(*mark) == F.col("_before"), F.lit(False))
    now = digests.withColumn("_name", name).join(before, "_name", "left")
    now = now.select(*digests.columns, "_name", F.when(same, F.col("run")).otherwise(run).cast("int").alias("run"))
    now = stored(now, "chunks")
    fresh = now.where(F.col("run") == run).select("_name")
    todo = chunked.withColumn("_name", name).join(fresh, "_name", "left_semi").drop("_name")
    scores = _chunk_scores(_changes_inside(todo, keys, ts, tie), keys, ts, tie, n_bkps, alpha)
    scores.write.mode("overwrite").parquet(f"{path}/{SCORES}/run={run}")
    # The digests come last: with them the run is done.
    now.write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/run={run}")
    return changed_scores(spark, path)


def changed_scores(spark, path: str) -> DataFrame:
    """The scores of the last finished run of score_changed, each from the run that scored its chunk."""
    last = spark.read.parquet(f"{path}/{SNAPSHOTS}/run={_runs(spark, path)[-1]}")
    used = [r["run"] for r in last.select("run").distinct().collect()]
    if not used:
        return spark.read.parquet(f"{path}/{SCORES}/run={_runs(spark, path)[-1]}").limit(0)
    parts = spark.read.option("basePath", f"{path}/{SCORES}").parquet(*[f"{path}/{SCORES}/run={r}" for r in used])
    by = last.columns[: last.columns.index("points")]
    names = last.select("_name", "run")
    return parts.withColumn("_name", F.md5(F.to_json(F.struct(*by)))).join(names, ["_name", "run"], "left_semi").drop("_name", "run")


def unscored_chunks(prices: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "ts", tie: Sequence[str] = (), n_bkps: int = 5, *, chunk_rows: int | None, max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Chunks without scores: how many points they have, how many were left out as unknown."""
    known = drop_nan("close").isNotNull() & drop_nan("volume").isNotNull()
    positions = with_chunk(prices.where(known), keys, ts, [ts, *tie], chunk_rows, shortest_series(n_bkps) + 1, max_rows, prices)
    short = (
        positions.groupBy(*keys, "chunk")
        .agg(F.count(F.lit(1)).alias("n_points"))
        .where(F.col("n_points") <= shortest_series(n_bkps))
    )
    unknown = (
        prices.where(~known)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_points"))
        .select(*keys, F.lit(None).cast("bigint").alias("chunk"), "n_points", F.lit("no close or volume").alias("reason"))
    )
    return short.withColumn("reason", F.lit("too few points")).unionByName(unknown)


def current_risk(prices: DataFrame, key: str = "symbol", ts: str = "ts", tie: Sequence[str] = (), *, chunk_rows: int | None = CHUNK_ROWS, **options) -> DataFrame:
    """The latest rounded score of every series: that of its last point."""
    scores = risk_scores(prices, [key], ts, tie, chunk_rows=chunk_rows, **options)
    last = latest(scores, key, ts, [ts, *tie])
    return last.select(key, ts, round_score("risk_value").alias("risk_score"))


def risk_rows(scores: DataFrame, as_of: str, key: str = "symbol", ts: str = "ts", tie: Sequence[str] = (), market_tz: str | None = None) -> DataFrame:
    """Scores as rows of the risk table: one per company and day, the last score of the day, rounded."""
    stamped = stamp_risk(scores, as_of, ts, market_tz, keep=[key, ts, *tie])
    rows = stamped.withColumn("risk_score", round_score("risk_score")).withColumnRenamed(key, "company_code")
    last = dedup_keep_last(rows, ["company_code", "predict_date"], [ts, *tie])
    return last.select("company_code", "model_name", "analysis_result", "test_date", "predict_date", "risk_score")


def load_risk(target: DataFrame, scores: DataFrame, as_of: str, **options) -> DataFrame:
    """The risk table with the scores of one run: rows of the same run date and day are updated."""
    return upsert(target, risk_rows(scores, as_of, **options), order=RISK_VALUES)
