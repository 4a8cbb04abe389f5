"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_keep_last


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def accumulate(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old and new rows, one per key: the new one wins, then the later one."""
    both = union_all(old.withColumn("_src", F.lit(0)), new.withColumn("_src", F.lit(1)))
    return dedup_keep_last(both, keys, ["_src", *order]).drop("_src")


def sort_by_time(df: DataFrame, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """For final output: by time, rows without a time last."""
    return df.orderBy(F.col(ts).asc_nulls_last(), *tie)


def sort_by_id(df: DataFrame, col: str = "id") -> DataFrame:
    """Text ids in the order of their numbers."""
    return df.orderBy(F.col(col).try_cast("bigint"), col)
