"""Checks of a frame against a stored table's definition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import Table


def missing_columns(df: DataFrame, table: Table) -> list[str]:
    """Columns the table needs and the frame lacks (reads the schema only)."""
    return [f.name for f in table.fields if f.name not in df.columns]


def check_contract(df: DataFrame, table: Table) -> DataFrame:
    """One row per rule (rule, column, violations): missing column, null, too long, negative, repeated key.

    All column rules are counted in one pass; repeated keys need one grouping by key.
    """
    missing = set(missing_columns(df, table))
    rules = [("missing_column", f.name, F.lit(1 if f.name in missing else 0).cast("bigint")) for f in table.fields]
    for f in table.fields:
        if f.name in missing:
            continue
        if not f.nullable:
            rules.append(("null", f.name, F.count_if(F.col(f.name).isNull())))
        if f.length:
            rules.append(("too_long", f.name, F.count_if(F.length(f.name) > f.length)))
        if f.type == "bigint":
            rules.append(("negative", f.name, F.count_if(F.col(f.name) < 0)))
    counted = df.agg(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column"), n.alias("violations"))
                for rule, col, n in rules
            ]
        ).alias("r")
    ).select(F.inline("r"))
    if missing & set(table.key):
        return counted
    repeated = (
        df.groupBy(*table.key)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
        .select(F.lit("repeated_key").alias("rule"), F.lit(", ".join(table.key)).alias("column"), "violations")
    )
    return counted.unionByName(repeated)
