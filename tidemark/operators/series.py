"""Windows over long series.

A window runs each series in one task. A series with more than `max_rows` rows is
therefore cut at its own quantiles of time into up to `PARTS` parts with about equally
many rows, wherever in time they lie: the window runs inside a part, and what one part
needs from another (its last row, its row count) comes from a small table with one row
per part. Series below the limit are not cut and need no such table. The list of long
series has at most rows / `max_rows` entries, which bounds its broadcast. Parts follow
from the rows alone, so a task that is run again cuts them the same way.

A series holds one row per time stamp once repeated rows are removed (see dedup); rows
of one time stay in one part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 5_000_000
PARTS = 256
FIRST_UNDATED_PART = 2**40


def join_group(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, max_rows: int = ROWS_PER_TASK, how: str = "left") -> DataFrame:
    """`rows` joined with one row per group, of which `size` counts the rows; a group may hold most of them.

    Spark can't split a side that meets an aggregate. Groups above `max_rows`, at most rows /
    `max_rows` of them, are therefore broadcast, and only the others meet their rows by shuffle.
    """
    facts = [c for c in groups.columns if c not in keys]
    large = F.col(size) > max_rows
    long_groups = groups.where(large).select(*keys, F.struct(*facts).alias("_large"))
    short_groups = groups.where(~large).select(*keys, F.lit(0).cast("bigint").alias("_spread"), F.struct(*facts).alias("_small"))
    marked = rows.join(F.broadcast(long_groups), list(keys), "left")
    # Rows of long groups go on under keys of their own, which find nothing.
    spread = F.when(F.col("_large").isNotNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0))
    joined = marked.withColumn("_spread", spread).join(short_groups, [*keys, "_spread"], "left")
    found = F.coalesce("_large", "_small")
    out = joined if how == "left" else joined.where(found.isNotNull())
    return out.withColumn("_facts", found).select(*rows.columns, *[F.col(f"_facts.{c}").alias(c) for c in facts])


def undated_digest(ts: str, order: Sequence[str]) -> Column:
    """Digest of the order columns for rows without a time, which have nothing else to be spread by."""
    return F.when(F.col(ts).isNull(), F.md5(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in order])))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def split_long_series(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str] | None = None,
    max_rows: int = ROWS_PER_TASK,
    source: DataFrame | None = None,
) -> DataFrame:
    """Adds `_part`: -1 for a series that fits one task, else the number of the row's part.

    Rows without a time come last, in 4,096 parts by digest. Rows are counted in `source`
    when given: any frame with at least the rows of `df` will do, so the cheapest one to
    read should be taken.
    """
    counted = df if source is None else source
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > max_rows).select(*keys)
    shares = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    cuts = (
        counted.select(*keys, _micros(ts).alias("_at"))
        .join(F.broadcast(large), list(keys))
        .groupBy(*keys)
        .agg(F.coalesce(F.percentile_approx("_at", shares, 10 * PARTS), F.array().cast("array<bigint>")).alias("_cuts"))
    )
    undated = F.conv(F.left(undated_digest(ts, order or [ts]), F.lit(3)), 16, 10).cast("bigint") + FIRST_UNDATED_PART
    part = F.when(F.col(ts).isNull(), undated).otherwise(_cuts_before("_cuts", _micros(ts)))
    part = F.when(F.col("_cuts").isNotNull(), part).otherwise(F.lit(-1)).cast("bigint")
    return df.join(F.broadcast(cuts), list(keys), "left").withColumn("_part", part).drop("_cuts")


def _cuts_before(cuts: str, at: Column) -> Column:
    """How many of the sorted cuts lie before `at`: groups of 16 by their last cut, then within a group."""
    step = math.isqrt(PARTS)
    lasts = F.transform(F.sequence(F.lit(step), F.lit(PARTS), F.lit(step)), lambda i: F.get(F.col(cuts), i - 1))
    whole = F.size(F.filter(lasts, lambda c: c < at)) * step
    return whole + F.size(F.filter(F.slice(F.col(cuts), whole + 1, F.lit(step)), lambda c: c < at))


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str] | None = None,
    name: str = "pos",
    max_rows: int = ROWS_PER_TASK,
    source: DataFrame | None = None,
) -> DataFrame:
    """Adds the 0-based rank of each row in its series, by time and then the other order columns.

    Rows without a time come last, in the order of their digest.
    """
    order = list(order or [ts])
    parts = split_long_series(df, keys, ts, order, max_rows, source)
    by_order = [F.col(ts).asc_nulls_last(), undated_digest(ts, order), *[F.col(c).asc_nulls_last() for c in order if c != ts]]
    rank = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by_order)) - 1
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.where("_part >= 0")
        .groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_part", F.sum("_n").over(before).alias("_offset"))
    )
    position = (F.col("_rank") + F.coalesce(F.col("_offset"), F.lit(0))).cast("bigint")
    return (
        parts.withColumn("_rank", rank)
        .join(offsets, [*keys, "_part"], "left")
        .withColumn(name, position)
        .drop("_part", "_rank", "_offset")
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str],
    order: Sequence[str] | None = None,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds `_prev`, a struct with `cols` of the row before in the series (null on the first row)."""
    order = list(order or [ts])
    parts = split_long_series(df, keys, ts, order, max_rows)
    values = F.struct(*cols)
    inside = F.lag(values).over(Window.partitionBy(*keys, "_part").orderBy(*order))
    carry = (
        parts.where("_part >= 0")
        .groupBy(*keys, "_part")
        .agg(F.max_by(values, F.struct(*order)).alias("_last"))
        .select(*keys, "_part", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_part")).alias("_carry"))
    )
    return (
        parts.withColumn("_inside", inside)
        .join(carry, [*keys, "_part"], "left")
        .withColumn("_prev", F.coalesce("_inside", "_carry"))
        .drop("_part", "_inside", "_carry")
    )


def change_of(col: str, prev: Column) -> Column:
    """(x - previous) / (previous + 1e-9); null in the one case where the divisor is 0."""
    return F.try_divide(F.col(col) - prev, prev + F.lit(1e-9))


def relative_change(
    df: DataFrame,
    cols: Sequence[str] = ("close", "volume"),
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    order: Sequence[str] | None = None,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds `<col>_change` for each column; the first row of every series is dropped."""
    out = with_previous(df, keys, ts, cols, order, max_rows).where(F.col("_prev").isNotNull())
    changes = {f"{c}_change": change_of(c, F.col(f"_prev.{c}")) for c in cols}
    return out.withColumns(changes).drop("_prev")


# --- exponential smoothing -------------------------------------------------------------
#
# e0 = x0, e_t = a x_t + (1 - a) e_(t-1) is a weighted running sum. Rows are taken in
# blocks so short that the weights stay in range: (1 - a)^block is about 1e-10. Inside a
# block the sum is a running window. What all earlier blocks carry into a block follows
# from their sums by the same recurrence, over groups of GROUP blocks. A group passes its
# end value on to the next group; two groups away it would weigh less than 1e-640, which
# makes 0 of any double. Only the last block of a series is short, and it carries nothing.

GROUP = 64


def block_rows(alpha: float) -> int:
    return max(1, math.ceil(10 * math.log(10) / -math.log1p(-alpha)))


def ema(df: DataFrame, col: str, alpha: float = 0.3, keys: Sequence[str] = ("symbol",), pos: str = "pos", out: str = "ema") -> DataFrame:
    """Exponential smoothing along `pos` (0-based, without gaps) of series of any length.

    The shuffle is by (series, block), so one long series is spread over many tasks.
    """
    if alpha >= 1:
        return df.withColumn(out, F.col(col))
    size, keep = block_rows(alpha), F.lit(1.0 - alpha)
    placed = df.withColumns({"_block": F.floor(F.col(pos) / size).cast("bigint"), "_r": F.col(pos) % size})
    value = F.when(F.col(pos) == 0, F.col(col)).otherwise(F.col(col) * alpha)
    weighted = value * F.pow(keep, -F.col("_r"))
    inside = Window.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    local = F.pow(keep, F.col("_r")) * F.sum(weighted).over(inside)
    block_end = F.sum(weighted) * (1.0 - alpha) ** (size - 1)
    ends = placed.groupBy(*keys, "_block").agg(block_end.alias("_end"))
    # At most GROUP blocks meet in a group.
    groups = ends.groupBy(*keys, F.floor(F.col("_block") / GROUP).alias("_group")).agg(
        F.sort_array(F.collect_list(F.struct("_block", "_end"))).alias("_blocks")
    )
    over_block = F.lit((1.0 - alpha) ** size)
    at_end = F.aggregate("_blocks", F.lit(0.0), lambda e, b: e * over_block + b["_end"])
    before = groups.select(*keys, (F.col("_group") + 1).alias("_group"), at_end.alias("_before"))
    step = "STRUCT<done: ARRAY<STRUCT<_block: BIGINT, _carry: DOUBLE>>, last: DOUBLE>"
    start = F.struct(F.array().alias("done"), F.coalesce("_before", F.lit(0.0)).alias("last")).cast(step)

    def advance(acc: Column, b: Column) -> Column:
        here = F.array(F.struct(b["_block"].alias("_block"), acc["last"].alias("_carry")))
        return F.struct(F.concat(acc["done"], here).alias("done"), (acc["last"] * over_block + b["_end"]).alias("last")).cast(step)

    carry = (
        groups.join(before, [*keys, "_group"], "left")
        .select(*keys, F.explode(F.aggregate("_blocks", start, advance, lambda acc: acc["done"])).alias("_s"))
        .select(*keys, "_s._block", "_s._carry")
    )
    smoothed = F.col("_local") + F.pow(keep, F.col("_r") + 1) * F.coalesce("_carry", F.lit(0.0))
    return (
        placed.withColumn("_local", local)
        .join(carry, [*keys, "_block"], "left")
        .withColumn(out, smoothed)
        .drop("_block", "_r", "_local", "_carry")
    )


def ema_levels(segments: Column, alpha: float = 0.3) -> Column:
    """Smoothing of a series that is constant on segments, in closed form.

    `segments` is an array of (start_i, end_i, level). Adds `before`, the smoothed value at the
    end of the segment before; k rows into a segment the smoothed value is
    level + (before - level) (1 - alpha)^(k + 1).
    """
    step = "STRUCT<start_i: INT, end_i: INT, level: DOUBLE, before: DOUBLE>"
    empty = F.struct(F.array().cast(f"ARRAY<{step}>").alias("done"), F.lit(None).cast("double").alias("last"))

    def advance(acc: Column, s: Column) -> Column:
        before = F.coalesce(acc["last"], s["level"])
        here = F.struct(s["start_i"], s["end_i"], s["level"], before.alias("before")).cast(step)
        last = s["level"] + (before - s["level"]) * F.pow(F.lit(1.0 - alpha), s["end_i"] - s["start_i"])
        return F.struct(F.concat(acc["done"], F.array(here)).alias("done"), last.alias("last"))

    return F.aggregate(segments, empty, advance, lambda acc: acc["done"])


# --- fill ------------------------------------------------------------------------------


def bfill(df: DataFrame, col: str, keys: Sequence[str] = ("symbol",), order: str = "day") -> DataFrame:
    """Next known value. For daily series: a group holds one row per calendar day.

    The window runs backwards, because a frame that ends at the group's end is summed up
    anew for every row.
    """
    from_end = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(from_end))


def ffill(df: DataFrame, col: str, keys: Sequence[str] = ("symbol",), order: str = "day") -> DataFrame:
    """Last known value. For daily series: a group holds one row per calendar day."""
    behind = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(behind))


# --- last rows, ids, chunks ------------------------------------------------------------


def last_n(df: DataFrame, n: int = 5, keys: Sequence[str] = ("conv_id",), order: Sequence[str] = ("turn",)) -> DataFrame:
    """The last n rows per group. Each map task keeps n rows per group before the shuffle."""
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= n).drop("_rn")


def assign_ids(df: DataFrame, key_cols: Sequence[str], start: int | Column = 0, name: str = "id") -> DataFrame:
    """Dense ids start+1, start+2, ... in the order of the key's digest.

    `key_cols` must be unique. The digest spreads any set of keys evenly over 65,536
    slices; only their row counts are summed in one place. The same rows get the same
    ids however often a task is run again.
    """
    digest = F.md5(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in key_cols]))
    rows = df.withColumn("_digest", digest).withColumn("_slice", F.conv(F.left("_digest", F.lit(4)), 16, 10).cast("int"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    in_slice = F.row_number().over(Window.partitionBy("_slice").orderBy("_digest", *key_cols))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        rows.withColumn("_rn", in_slice)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(name, (first + F.col("_offset") + F.col("_rn")).cast("bigint"))
        .drop("_slice", "_digest", "_rn", "_offset")
    )


def with_chunk(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    order: Sequence[str] | None = None,
    chunk_rows: int | None = None,
    least: int = 1,
    max_rows: int = ROWS_PER_TASK,
    source: DataFrame | None = None,
) -> DataFrame:
    """Adds `chunk`: the number of the row's file when a series is stored in files of `chunk_rows` rows.

    Fewer than `least` rows at the end of a series belong to the chunk before them. Without
    `chunk_rows` a series is one chunk.
    """
    if chunk_rows is None:
        return df.withColumn("chunk", F.lit(0).cast("bigint"))
    rows = with_position(df, keys, ts, order, "_pos", max_rows, source)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    last = F.greatest(F.floor((F.col("_n") - F.lit(least)) / chunk_rows), F.lit(0))
    chunk = F.least(F.floor(F.col("_pos") / chunk_rows), last).cast("bigint")
    return join_group(rows, sizes, keys, "_n", max_rows).withColumn("chunk", chunk).drop("_pos", "_n")
