"""Change points of series of any length: the kernel matrix as tiles over many tasks.

`changepoint` holds a whole series in one task. Here a series is cut into strips of TILE points, and every pair of strips is
a row of its own, a tile of the kernel matrix, that any task can take. Nothing larger than a tile is ever in one place:

- The median of all pair distances is found by counting. A pass over the tiles counts distances by 16 bits of their
  binary form (distances aren't negative, so their bits sort as they do), the counts say in which bucket the median lies,
  and the next pass counts the next 16 bits of the distances in that bucket, or all bits if the bucket has few distances. Four
  passes at most give the value to the last bit, two that of a short series.
- A pass over the tiles of some spans gives, for each block of `jump` points, its kernel sums with the blocks before it and
  with all blocks of the span. Running sums of those, one row per block, are the costs of all splits of the span.
- Each round splits the best span of every series; only the two new spans are looked at again.

The work is quadratic in the length of a series, as the method demands, but spread evenly. Steps are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.changepoint import shortest_series
from tidemark.operators.series import ROWS_PER_TASK, join_group
from tidemark.session import shuffle_tasks, stored

TILE = 500
#: Bits of a distance that one pass looks at.
DIGIT = 16
INFINITE = 0x7FF0


def _strips(points: DataFrame, keys: Sequence[str], features: Sequence[str], pos: str, tile: int) -> DataFrame:
    """sid (digest of the keys), strip, and one array per feature with the strip's points in order."""
    name = F.md5(F.to_json(F.struct(*keys)))
    rows = points.select(name.alias("sid"), F.floor(F.col(pos) / tile).cast("int").alias("strip"), pos, *features)
    packed = rows.groupBy("sid", "strip").agg(F.sort_array(F.collect_list(F.struct(pos, *features))).alias("p"))
    return packed.select("sid", "strip", *[F.col("p")[f].cast("array<double>").alias(f"x{k}") for k, f in enumerate(features)])


def _pairs(strips: DataFrame, spans: DataFrame, tile: int) -> DataFrame:
    """The tiles of the upper half of each span's kernel matrix: the columns of `spans`, i, j, strip i as x0.. and j as y0.."""
    values = [c for c in strips.columns if c.startswith("x")]
    first, last = F.floor(F.col("begin") / tile).cast("int"), F.floor((F.col("end") - 1) / tile).cast("int")
    inside = strips.join(spans, "sid").where(F.col("strip").between(first, last))
    left = inside.select(*spans.columns, F.col("strip").alias("i"), F.explode(F.sequence("strip", last)).alias("j"), *values)
    right = inside.select(
        "sid", "begin", F.explode(F.sequence(first, F.col("strip"))).alias("i"), F.col("strip").alias("j"),
        *[F.col(c).alias(c.replace("x", "y")) for c in values],
    )
    # Named tasks: adaptive execution would merge these by their size, but they are small and cost much computing.
    tasks = shuffle_tasks(strips.sparkSession)
    on = ["sid", "begin", "i", "j"]
    return left.repartition(tasks, *on).join(right.repartition(tasks, *on), on)


def _distances(row: object, width: int) -> np.ndarray:
    out = np.zeros((len(row.x0), len(row.y0)))
    for k in range(width):
        diff = np.asarray(getattr(row, f"x{k}"))[:, None] - np.asarray(getattr(row, f"y{k}"))[None, :]
        out += diff * diff
    return out


def _width(strips: DataFrame) -> int:
    return sum(c.startswith("x") for c in strips.columns)


def _number(bits: pd.Series) -> pd.Series:
    return pd.Series(bits.to_numpy(dtype=np.int64).view(np.float64))


def median_distances(strips: DataFrame, spans: DataFrame, tile: int) -> DataFrame:
    """sid and scale: the median of the squared distances of all pairs of points; NaN if one is no number."""
    width = _width(strips)
    n = F.col("end").cast("long")
    pairs = F.shiftright(n * (n - 1), 1)
    ranks = F.array(F.shiftright(pairs - 1, 1), F.shiftright(pairs, 1))
    state = spans.select("sid", "begin", "end", F.array(F.lit(0), F.lit(0)).cast("array<bigint>").alias("found"), ranks.alias("ranks"))
    # Bits that are not known yet, and how many of them the next pass looks at.
    state = state.withColumns({"unknown": F.lit(False), "open": F.lit(64), "bits": F.lit(DIGIT)})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sid, which, digits, counts = [], [], [], []
            for row in frame.itertuples():
                d = _distances(row, width)
                d = (d[np.triu_indices(len(d), 1)] if row.i == row.j else d.ravel()).view(np.int64)
                for k in range(1 if row.found[0] == row.found[1] else 2):
                    here = d[(d >> row.open) == row.found[k]] if row.open < 64 else d
                    here = (here >> (row.open - row.bits)) & ((1 << row.bits) - 1)
                    if row.bits <= DIGIT < here.size.bit_length():
                        n = np.bincount(here)
                        at = np.flatnonzero(n)
                        n = n[at]
                    else:
                        at, n = np.unique(here, return_counts=True)
                    sid.append(row.sid)
                    which.append(k)
                    digits.append(at)
                    counts.append(n)
            sizes = [len(x) for x in digits]
            whole = {"digit": np.concatenate(digits) if digits else [], "n": np.concatenate(counts) if counts else []}
            yield pd.DataFrame({"sid": np.repeat(np.array(sid, dtype=object), sizes), "which": np.repeat(which, sizes), **whole})

    done = []
    while True:
        tiles = _pairs(strips, state, tile).drop("ranks", "unknown", "end")
        counts = tiles.mapInPandas(count, "sid string, which int, digit long, n long")
        counts = counts.groupBy("sid", "which", "digit").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy("sid", "which").orderBy("digit")
        counts = counts.withColumn("upto", F.sum("n").over(upto))
        counts = counts.join(state.select("sid", "ranks", "found", "open"), "sid")
        picked = []
        for k in (0, 1):
            mine = F.col("which") == F.when(F.col("found")[0] == F.col("found")[1], 0).otherwise(k)
            rank = F.col("ranks")[k]
            hit = mine & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            found = F.struct(F.col("digit"), (rank - F.col("upto") + F.col("n")).alias("rank"), "n")
            picked.append(F.max(F.when(hit, found)).alias(f"hit{k}"))
        odd = F.max((F.col("open") == 64) & (F.col("digit") > INFINITE))
        hits = counts.groupBy("sid").agg(*picked, odd.alias("odd"))
        moved = F.array(*[F.call_function("shiftleft", F.col("found")[k], F.col("bits")) + F.col(f"hit{k}.digit") for k in (0, 1)])
        # Few distances in the bucket are counted by all their bits: they have no more values than a digit.
        few = F.greatest("hit0.n", "hit1.n") <= 1 << DIGIT
        left = F.col("open") - F.col("bits")
        state = state.join(hits, "sid").select(
            "sid", "begin", "end", moved.alias("found"), F.array("hit0.rank", "hit1.rank").alias("ranks"),
            (F.col("unknown") | F.col("odd")).alias("unknown"), left.alias("open"), F.when(few, left).otherwise(DIGIT).alias("bits"),
        )
        state = stored(state, "median")
        done.append(state.where("open = 0"))
        state = state.where("open > 0")
        if state.isEmpty():
            break
    state = reduce(DataFrame.union, done)
    value = F.pandas_udf(_number, "double")
    middle = (value(F.col("found")[0]) + value(F.col("found")[1])) / 2
    scale = F.when(F.col("unknown"), F.lit(float("nan"))).otherwise(middle)
    return state.select("sid", scale.alias("scale"))


def _sums(strips: DataFrame, spans: DataFrame, jump: int, tile: int) -> DataFrame:
    """sid, begin, end, block, and the block's kernel sums: with the span's blocks before it, with itself, with all of them."""
    width = _width(strips)
    per = tile // jump

    def block_sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            heads, sums = [], []
            for row in frame.itertuples():
                k = _distances(row, width)
                k *= 1.0 / row.scale if row.scale != 0 else 1.0
                np.exp(np.negative(np.clip(k, 0.01, 100.0, out=k), out=k), out=k)
                if row.i == row.j:
                    np.fill_diagonal(k, 1.0)
                k = np.add.reduceat(k, np.arange(0, k.shape[1], jump), axis=1)
                k = np.add.reduceat(k, np.arange(0, k.shape[0], jump), axis=0)
                rows, cols = row.i * per + np.arange(k.shape[0]), row.j * per + np.arange(k.shape[1])
                r, c = ((at >= row.begin // jump) & (at * jump < row.end) for at in (rows, cols))
                k, rows, cols = k[r][:, c], rows[r], cols[c]
                head = (row.sid, row.begin, row.end)
                if row.i == row.j:
                    heads.append(head)
                    sums.append((rows, np.tril(k, -1).sum(1), np.diag(k), k.sum(1)))
                else:
                    heads += [head, head]
                    sums += [(rows, np.zeros(len(rows)), np.zeros(len(rows)), k.sum(1)), (cols, k.sum(0), np.zeros(len(cols)), k.sum(0))]
            sizes = [len(s[0]) for s in sums]
            out = {c: np.repeat(np.array([h[i] for h in heads], dtype=object if i == 0 else np.int64), sizes) for i, c in enumerate(("sid", "begin", "end"))}
            yield pd.DataFrame(out | {c: np.concatenate([s[i] for s in sums]) if sums else [] for i, c in enumerate(("block", "before", "own", "total"))})

    sums = _pairs(strips, spans, tile).mapInPandas(block_sums, "sid string, begin int, end int, block int, before double, own double, total double")
    return sums.groupBy("sid", "begin", "end", "block").agg(*[F.sum(c).alias(c) for c in ("before", "own", "total")])


def _best_splits(strips: DataFrame, spans: DataFrame, jump: int, min_size: int, tile: int) -> DataFrame:
    """Every span with the gain of its best split and the point it splits `at`; null and 0 where none is possible."""
    sums = _sums(strips, spans, jump, tile)
    span = Window.partitionBy("sid", "begin", "end")
    before = span.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("block") * jump
    left = F.sum(2 * F.col("before") + F.col("own")).over(before)
    sums = sums.withColumns({"at": at, "left": left, "rows": F.sum("total").over(before), "whole": F.sum("total").over(span)})

    def cost(size, inside):
        return size - inside / size

    right = F.col("whole") + F.col("left") - 2 * F.col("rows")
    size = F.col("end") - F.col("begin")
    gain = cost(size, F.col("whole")) - cost(F.col("at") - F.col("begin"), F.col("left")) - cost(F.col("end") - F.col("at"), right)
    # The way the one-task kernel rounds: half to even. Of equal gains the last split counts.
    gain = F.rint(gain * 1e9) / 1e9
    able = (F.col("at") >= F.col("begin") + F.lit(max(jump, min_size))) & (F.col("end") - F.col("at") >= min_size)
    best = F.max(F.struct(gain.alias("gain"), F.col("at")))
    found = sums.where(able).groupBy("sid", "begin", "end").agg(best.alias("best"))
    return spans.join(found, ["sid", "begin", "end"], "left").select(
        *spans.columns, F.coalesce("best.gain", F.lit(0.0)).alias("gain"), F.col("best.at").cast("int").alias("at")
    )


def pair_medians(points: DataFrame, keys: Sequence[str], features: Sequence[str], pos: str = "pos", tile: int = TILE) -> DataFrame:
    """Median pairwise squared distance of series of any length; `pos` counts the points of a series from 0. Series of a
    single point have 0."""
    strips = stored(_strips(points, keys, features, pos, tile), "strips")
    spans = _whole(strips, 1)
    found = median_distances(strips, spans.where("end > 1"), tile).unionByName(spans.where("end = 1").select("sid", F.lit(0.0).alias("scale")))
    names = points.select(*keys).distinct().withColumn("sid", F.md5(F.to_json(F.struct(*keys))))
    return names.join(found, "sid").select(*keys, F.col("scale").alias("pair_median"))


def _whole(strips: DataFrame, least: int) -> DataFrame:
    sizes = strips.groupBy("sid").agg(F.sum(F.size("x0")).cast("int").alias("end"))
    return stored(sizes.where(F.col("end") >= least).select("sid", F.lit(0).alias("begin"), "end"), "spans")


def segment_ends(
    points: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = ("close_change", "volume_change"),
    pos: str = "pos",
    n_bkps: int = 5,
    jump: int = 5,
    min_size: int = 2,
    tile: int = TILE,
) -> DataFrame:
    """sid (digest of the keys) and `ends`, the ends of the segments of every series that is long enough for the splits.

    `pos` counts the points of a series from 0 without gaps; `features` are two numbers or more.
    """
    tile = max(jump, tile // jump * jump)
    strips = stored(_strips(points, keys, features, pos, tile), "strips")
    spans = _whole(strips, shortest_series(n_bkps, jump, min_size))
    spans = stored(spans.join(median_distances(strips, spans, tile), "sid"), "scales")
    known = stored(_best_splits(strips, spans, jump, min_size, tile), "splits")
    best_first = Window.partitionBy("sid").orderBy(F.desc("gain"), "begin")
    for left in reversed(range(n_bkps)):
        ranked = known.withColumn("place", F.row_number().over(best_first))
        splits = (F.col("place") == 1) & F.col("at").isNotNull()
        halves = F.array(F.struct(F.col("begin"), F.col("at").alias("end")), F.struct(F.col("at").alias("begin"), F.col("end")))
        fresh = ranked.where(splits).select("sid", "scale", F.explode(halves).alias("h")).select("sid", "h.begin", "h.end", "scale")
        fresh = stored(fresh.select(*spans.columns), "halves")
        if left:
            fresh = _best_splits(strips, fresh, jump, min_size, tile)
        else:
            fresh = fresh.withColumns({"gain": F.lit(0.0), "at": F.lit(None).cast("int")})
        known = stored(ranked.where(~splits).drop("place").unionByName(fresh), "splits")
    return known.groupBy("sid").agg(F.sort_array(F.collect_list("end")).alias("ends"))


def change_points(
    points: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = ("close_change", "volume_change"),
    pos: str = "pos",
    n_bkps: int = 5,
    jump: int = 5,
    min_size: int = 2,
    tile: int = TILE,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per series that is long enough: the keys and `segments` (start, end, volatility), as `changepoint` finds them."""
    points = points.select(F.md5(F.to_json(F.struct(*keys))).alias("sid"), *keys, pos, *features)
    ends = segment_ends(points, keys, features, pos, n_bkps, jump, min_size, tile)
    ends = stored(ends.withColumn("_n", F.element_at("ends", -1).cast("bigint")), "ends")
    rows = join_group(points, ends, ["sid"], "_n", max_rows, "inner")
    seg = F.size(F.filter("ends", lambda e: e <= F.col(pos)))
    spread = sum((F.pow(F.stddev_pop(F.col(f).cast("double")), 2) for f in features), F.lit(0.0))
    by_segment = (
        rows.withColumn("_seg", seg)
        .groupBy("sid", *keys, "_seg")
        .agg(F.min(pos).alias("a"), F.max(pos).alias("b"), F.sqrt(spread).alias("volatility"))
    )
    one = F.struct(F.col("a").cast("int").alias("start_i"), (F.col("b") + 1).cast("int").alias("end_i"), "volatility")
    return by_segment.groupBy("sid", *keys).agg(F.sort_array(F.collect_list(one)).alias("segments")).drop("sid")
