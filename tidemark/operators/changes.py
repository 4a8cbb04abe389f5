"""Table changes as DataFrame operators: each returns the new state or the rows to write."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_keep_last
from tidemark.operators.filters import only_newer
from tidemark.operators.joins import anti_existing
from tidemark.operators.sets import union_all

log = logging.getLogger(__name__)

OHLC = ("open", "high", "low", "close")
RISK_KEYS = ("company_code", "model_name", "predict_date", "test_date")
RISK_VALUES = ("analysis_result", "risk_score")


def append_new(new: DataFrame, stored: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """The stored rows and the new tail of every series."""
    return union_all(stored, only_newer(new, stored, key, ts))


def _differs(cols: Sequence[str], tol: float) -> Column:
    """Any column further apart than tol; a missing value counts as a difference."""
    same = F.lit(True)
    for c in cols:
        same = same & (F.abs(F.col(f"_new.{c}") - F.col(c)) <= F.lit(tol))
    return ~F.coalesce(same, F.lit(False))


def _incoming(new, keys, cols):
    return new.select(*keys, F.struct(*cols).alias("_new"))


def reconcile_changes(new: DataFrame, stored: DataFrame, keys: Sequence[str] = ("symbol", "ts"), cols: Sequence[str] = OHLC, tol: float = 1e-4) -> DataFrame:
    """Stored rows whose incoming values differ, with old and new values."""
    pairs = stored.select(*keys, *cols).join(_incoming(new, keys, cols), list(keys)).where(_differs(cols, tol))
    return pairs.select(
        *keys, *[F.col(c).alias(f"{c}_old") for c in cols], *[F.col(f"_new.{c}").alias(f"{c}_new") for c in cols]
    )


def reconcile(new: DataFrame, stored: DataFrame, keys: Sequence[str] = ("symbol", "ts"), cols: Sequence[str] = OHLC, tol: float = 1e-4) -> DataFrame:
    """The stored rows with changed values taken over; the volume never changes, no row is added."""
    pairs = stored.join(_incoming(new, keys, cols), list(keys), "left")
    changed = F.col("_new").isNotNull() & _differs(cols, tol)
    taken = {c: F.when(F.col("_changed"), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in cols}
    return pairs.withColumn("_changed", changed).withColumns(taken).select(*stored.columns)


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str] = RISK_KEYS, update_cols: Sequence[str] = RISK_VALUES, *, order: Sequence[str]) -> DataFrame:
    """Updates `update_cols` of stored keys, adds the other rows; of a batch's rows with one key the last in `order` wins.

    A batch without a required column changes nothing.
    """
    missing = set(keys) | set(update_cols)
    missing -= set(new.columns)
    if missing:
        log.error("batch not written, columns missing: %s", sorted(missing))
        return target
    batch = dedup_keep_last(new, keys, order)
    others = [c for c in target.columns if c not in keys]
    given = [c for c in others if c in batch.columns]
    batch = batch.select(*keys, F.struct(*given).alias("_new"), F.lit(True).alias("_is_new"))
    merged = target.withColumn("_is_old", F.lit(True)).join(batch, list(keys), "full_outer")

    def value(c):
        if c not in given:
            return F.col(c)
        take_new = F.col("_is_new") if c in update_cols else F.col("_is_old").isNull()
        return F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)

    return merged.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def update_where(df: DataFrame, sets: Mapping[str, object], where: str) -> DataFrame:
    """SET ... WHERE ...; all values are computed from the row as it was."""
    hit = F.coalesce(F.expr(where), F.lit(False))
    columns = {c: v if isinstance(v, Column) else F.lit(v) for c, v in sets.items()}
    changed = [
        F.when(hit, columns[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ]
    return df.select(*changed)


def delete_where(df: DataFrame, where: str) -> DataFrame:
    """DELETE WHERE ...; a row whose condition is null stays."""
    return df.where(~F.coalesce(F.expr(where), F.lit(False)))


def new_companies(universe: DataFrame, existing: DataFrame, country: str) -> DataFrame:
    """Companies not stored yet; missing names and sectors are empty text."""
    rows = universe.select(
        F.col("symbol").alias("company_code"),
        F.coalesce("full_name", F.lit("")).alias("company_name"),
        F.lit(country).alias("country"),
        F.coalesce("sector", F.lit("")).alias("sector"),
    )
    return anti_existing(rows, existing, ["company_code"], ["company_name", "sector"])


def load_companies(universe: DataFrame, existing: DataFrame, country: str) -> DataFrame:
    """The company table with the new companies; existing ones stay as they are."""
    return union_all(existing, new_companies(universe, existing, country))
