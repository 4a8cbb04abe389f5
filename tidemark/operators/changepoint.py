"""Change points of a series: greedy binary segmentation with a Gaussian kernel cost.

The kernel compares every point of a series with every other one, so the series must
be bounded: callers group by (symbol, chunk) with at most `chunk_rows` points each. Spark
groups and orders the points; the task then works on strips of the kernel matrix and
keeps only its block sums (splits are multiples of `jump`, so nothing finer is needed).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRIP_VALUES = 250_000
DIRECT_MEDIAN_POINTS = 2_000
SAMPLED_PAIRS = 100_000


def _distances(x: np.ndarray, lo: int, hi: int, start: int = 0) -> np.ndarray:
    """Squared distances of points lo..hi to points start.. ."""
    out = np.zeros((hi - lo, len(x) - start))
    for feature in x.T:
        diff = feature[lo:hi, None] - feature[None, start:]
        out += diff * diff
    return out


def _strips(n: int, step: int = 1):
    rows = max(step, STRIP_VALUES // max(n, 1) // step * step)
    return ((lo, min(lo + rows, n)) for lo in range(0, n, rows))


def _pair_strips(x: np.ndarray):
    """Distances of all pairs i < j, one strip of rows at a time."""
    for lo, hi in _strips(len(x)):
        near = _distances(x[:hi], lo, hi, lo)
        yield near[np.triu_indices(hi - lo, 1)]
        if hi < len(x):
            yield _distances(x, lo, hi, hi).ravel()


def pair_median(x: np.ndarray) -> float:
    """Median of the squared distances of all pairs.

    For long series a sample only says where to look: all distances are counted against
    two bounds around the sample's median, and those between the bounds are held. When
    the median is not between them, the bounds are moved apart, and at last to the two
    values of the sample that have it between them. Distances that are no numbers leave it
    unknown.
    """
    n = len(x)
    if n < 2:
        return 0.0
    if n <= DIRECT_MEDIAN_POINTS:
        return float(np.median(np.concatenate(list(_pair_strips(x)))))
    pairs = n * (n - 1) // 2
    ranks = ((pairs - 1) // 2, pairs // 2)
    i, j = np.random.default_rng(0).integers(0, n, (2, SAMPLED_PAIRS))
    sample = np.sort(((x[i] - x[j]) ** 2).sum(axis=1)[i != j])
    if np.isnan(sample).any() or np.isnan(x).any():
        return math.nan
    sample = np.concatenate([[-np.inf], sample, [np.inf]])
    for width in (0.01, 0.1, 0.0):
        lo, hi = np.quantile(sample, (0.5 - width, 0.5 + width), method="lower") if width else _around(x, sample, ranks)
        below = at_lo = at_hi = 0
        between = []
        for d in _pair_strips(x):
            below += int(np.count_nonzero(d < lo))
            at_lo += int(np.count_nonzero(d == lo))
            at_hi += int(np.count_nonzero(d == hi)) if hi > lo else 0
            between.append(d[(d > lo) & (d < hi)])
        held = np.sort(np.concatenate(between))
        edges = np.cumsum([below, at_lo, held.size, at_hi])
        if edges[0] <= ranks[0] and ranks[1] < edges[3]:
            return float(np.mean([lo if k < edges[1] else held[k - edges[1]] if k < edges[2] else hi for k in ranks]))
    return math.nan


def _around(x: np.ndarray, sample: np.ndarray, ranks: tuple[int, int]) -> tuple[float, float]:
    """Neighbours in the sorted sample between which the ranks lie: by halving, a count of all distances each time."""

    def last_where(most: int) -> int:
        """The last of the sample with at most `most` distances below it."""
        a, b = 0, len(sample)
        while b - a > 1:
            middle = (a + b) // 2
            if sum(int(np.count_nonzero(d < sample[middle])) for d in _pair_strips(x)) <= most:
                a = middle
            else:
                b = middle
        return a

    return float(sample[last_where(ranks[0])]), float(sample[min(last_where(ranks[1]) + 1, len(sample) - 1)])


def block_sums(x: np.ndarray, scale: float, jump: int) -> np.ndarray:
    """Kernel matrix summed over jump x jump blocks, as a two-way running sum.

    The matrix is symmetric: a strip covers the columns from its own first row on.
    """
    n = len(x)
    gamma = 1.0 / scale if scale != 0 else 1.0
    blocks = -(-n // jump)
    sums = np.zeros((blocks + 1, blocks + 1))
    for lo, hi in _strips(n, jump):
        k = np.exp(-np.clip(_distances(x, lo, hi, lo) * gamma, 0.01, 100.0))
        k[np.arange(hi - lo), np.arange(hi - lo)] = 1.0
        k = np.add.reduceat(np.add.reduceat(k, np.arange(0, n - lo, jump), axis=1), np.arange(0, hi - lo, jump), axis=0)
        first = lo // jump + 1
        sums[first : first + len(k), first:] = k
        sums[first + len(k) :, first : first + len(k)] = k[:, len(k) :].T
    return sums.cumsum(axis=0).cumsum(axis=1)


def segment_ends(x: np.ndarray, n_bkps: int = 5, jump: int = 5, min_size: int = 2) -> list[int] | None:
    """Ends of the segments (the last one is len(x)); None when the series is too short."""
    n = len(x)
    if n < shortest_series(n_bkps, jump, min_size):
        return None
    sums = block_sums(x, pair_median(x), jump)

    def cost(s, e):
        a, b = s // jump, -(-e // jump)
        inside = sums[b, b] - sums[a, b] - sums[b, a] + sums[a, a]
        return (e - s) - inside / (e - s)

    def best_split(s, e):
        at = np.arange(s + jump, e, jump)
        at = at[(at - s >= min_size) & (e - at >= min_size)]
        if not len(at):
            return 0.0, None
        gains = np.round(cost(s, e) - cost(s, at) - cost(at, e), 9)
        last = len(gains) - 1 - int(np.argmax(gains[::-1]))
        return float(gains[last]), int(at[last])

    ends, known = [n], {}
    for _ in range(n_bkps):
        spans = list(zip([0, *ends], ends))
        known = {span: known.get(span) or best_split(*span) for span in spans}
        _, at = max((known[span] for span in spans), key=lambda option: option[0])
        if at is None:
            break
        ends = sorted([*ends, at])
    return ends


def shortest_series(n_bkps: int = 5, jump: int = 5, min_size: int = 2) -> int:
    """The fewest points that hold n_bkps splits."""
    return max(n_bkps * jump, n_bkps * math.ceil(min_size / jump) * jump + min_size)


def segment_table(x: np.ndarray, n_bkps: int = 5, jump: int = 5, min_size: int = 2) -> list[dict] | None:
    """Start, end and volatility of every segment."""
    ends = segment_ends(x, n_bkps, jump, min_size)
    if ends is None:
        return None
    return [
        {"start_i": s, "end_i": e, "volatility": float(np.sqrt((x[s:e].std(axis=0) ** 2).sum()))}
        for s, e in zip([0, *ends], ends)
    ]


SEGMENTS = "ARRAY<STRUCT<start_i: INT, end_i: INT, volatility: DOUBLE>>"


def _per_series(fn, returns: str, features: Sequence[str]) -> Column:
    """Applies fn(matrix of points) to every row; `features` are fields of its `points`."""

    def apply(points: pd.Series) -> pd.Series:
        return pd.Series([fn(np.column_stack(list(arrays))) for arrays in points], dtype=object)

    wanted = F.array(*[F.col("points")[f].cast("array<double>") for f in features])
    return F.pandas_udf(apply, returns)(wanted)


def collect_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per group with its points in order. Groups must be bounded (see with_chunk)."""
    points = F.sort_array(F.collect_list(F.struct(*order, *cols)))
    return df.groupBy(*keys).agg(points.alias("points"))


def pair_medians(df: DataFrame, keys: Sequence[str], order: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Median pairwise squared distance per group, the scale of the kernel."""
    series = collect_series(df, keys, order, features)
    return series.select(*keys, _per_series(pair_median, "double", features).alias("pair_median"))


def change_points(
    df: DataFrame,
    keys: Sequence[str] = ("symbol", "chunk"),
    order: Sequence[str] = ("ts",),
    features: Sequence[str] = ("close_change", "volume_change"),
    n_bkps: int = 5,
    jump: int = 5,
    min_size: int = 2,
) -> DataFrame:
    """One row per group: its points in order and its segments (start, end, volatility).

    Groups with too few points for the splits give no row.
    """

    def segments(x):
        return segment_table(x, n_bkps, jump, min_size)

    series = collect_series(df, keys, order, features)
    long_enough = series.where(F.size("points") >= shortest_series(n_bkps, jump, min_size))
    return long_enough.withColumn("segments", _per_series(segments, SEGMENTS, features))
