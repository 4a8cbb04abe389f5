"""Row removal by key. Copies are dropped in the map tasks before rows are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df, keys, order):
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in arrival order."""
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in arrival order."""
    return _first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_values(df: DataFrame, value_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows whose values agree collapse to the last one, whatever their date."""
    return dedup_keep_last(df, value_cols, order)
