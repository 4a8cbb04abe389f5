"""User functions per series."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import last_n_days
from tidemark.operators.series import ROWS_PER_TASK, split_long_series, with_chunk
from tidemark.session import shuffle_tasks


def apply_per_series(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame | None],
    schema: T.StructType,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    order: Sequence[str] | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Runs `fn` once for every series, or for every chunk of `chunk_rows` rows where asked for.

    A call that fails gives one row with its message in `error`; a call without result gives
    no row.
    """
    names = [f.name for f in schema.fields]
    by = [*keys, "chunk"]
    order = list(order or [ts])
    chunked = with_chunk(df, keys, ts, order, chunk_rows)
    out = T.StructType([chunked.schema[k] for k in by] + list(schema.fields) + [T.StructField("error", T.StringType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            result = fn(pdf.sort_values(order, ignore_index=True))
            result = pd.DataFrame(columns=names) if result is None else result[names].reset_index(drop=True)
            result["error"] = None
        except Exception as e:
            result = pd.DataFrame([[None] * len(names)], columns=names)
            result["error"] = f"{type(e).__name__}: {e}"
        for name, value in zip(by, key):
            result[name] = value
        return result[[*by, *names, "error"]]

    return chunked.repartition(shuffle_tasks(df.sparkSession), *by).groupBy(*by).applyInPandas(run, out)


def load_series(df: DataFrame, n_days: int | None, as_of: str, ts: str = "ts") -> DataFrame:
    """All series over the last n days (or all rows); a series without rows does not appear."""
    return df if n_days is None else last_n_days(df, n_days, as_of, ts)


def fold_per_series(
    df: DataFrame,
    start: Callable[[], object],
    step: Callable[[object, pd.DataFrame], object],
    merge: Callable[[object, object], object],
    finish: Callable[[object], pd.DataFrame | None],
    schema: T.StructType,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    order: Sequence[str] | None = None,
    max_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """A user function with a carried state over series of any length.

    A series above `max_rows` is cut in time order into parts, which lie in many tasks. Each part begins with `start()`;
    its rows come in order, some at a time, to `step`, which returns the next state. `merge` puts the states of two neighbouring
    parts together, the earlier one first, and `finish` turns the last state into rows. A call that fails gives one
    row for the series with its message in `error`; a series without result gives no row.
    """
    order = list(order or [ts])
    names = [f.name for f in schema.fields]
    parts = split_long_series(df, keys, ts, order, max_rows)
    by = [*keys, "_part"]
    dealt = parts.repartition(shuffle_tasks(df.sparkSession), *by).sortWithinPartitions(*by, F.col(ts).asc_nulls_last(), *[c for c in order if c != ts])
    states = T.StructType([parts.schema[k] for k in by] + [T.StructField("_state", T.BinaryType()), T.StructField("_error", T.StringType())])

    def message(e: Exception) -> str:
        return f"{type(e).__name__}: {e}"

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, error = None, None, None

        def done() -> pd.DataFrame:
            held = None if error else cloudpickle.dumps(state)
            return pd.DataFrame([(*key, held, error)], columns=states.names)

        for frame in frames:
            # Rows of a part follow each other.
            marks = list(map(tuple, frame[by].astype(object).where(frame[by].notna(), None).to_numpy()))
            edges = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
            for a, b in zip(edges, edges[1:]):
                mine, rows = marks[a], frame.iloc[a:b]
                if key is not None and mine != key:
                    yield done()
                if mine != key:
                    key, state, error = mine, None, None
                    try:
                        state = start()
                    except Exception as e:
                        error = message(e)
                if error is None:
                    try:
                        state = step(state, rows.drop(columns="_part").reset_index(drop=True))
                    except Exception as e:
                        error = message(e)
        if key is not None:
            yield done()

    out = T.StructType([df.schema[k] for k in keys] + list(schema.fields) + [T.StructField("error", T.StringType())])

    def join(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        errors = pdf["_error"].dropna()
        try:
            if len(errors):
                raise RuntimeError
            state = reduce(merge, [cloudpickle.loads(s) for s in pdf["_state"]])
            result = finish(state)
            result = pd.DataFrame(columns=names) if result is None else result[names].reset_index(drop=True)
            result["error"] = None
        except Exception as e:
            result = pd.DataFrame([[None] * len(names)], columns=names)
            result["error"] = errors.iloc[0] if len(errors) else message(e)
        for name, value in zip(keys, key):
            result[name] = value
        return result[[*keys, *names, "error"]]

    return dealt.mapInPandas(walk, states).groupBy(*keys).applyInPandas(join, out)
