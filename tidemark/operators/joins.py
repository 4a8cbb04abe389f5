"""Joins between incoming and stored rows.

Spark broadcasts a side whose size it has measured, and splits skewed partitions of plain
joins (adaptive execution). It can't split a side beside an aggregate, so rows that meet one
row per series go through `join_group`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_keep_first, dedup_keep_last
from tidemark.operators.series import ROWS_PER_TASK, join_group
from tidemark.schemas import Table


def pair_on_key(new: DataFrame, old: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_new", "_old")) -> DataFrame:
    """Inner join; columns both sides have get a suffix."""
    shared = (set(new.columns) & set(old.columns)) - set(keys)

    def suffixed(df, suffix):
        return df.select(*[F.col(c).alias(c + suffix if c in shared else c) for c in df.columns])

    return suffixed(new, suffixes[0]).join(suffixed(old, suffixes[1]), list(keys), "inner")


def anti_existing(new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """New rows whose key is not stored; of several new rows with one key the first counts.

    Only the stored keys that the batch has are looked up: Spark broadcasts the keys of a
    small batch, so that a large table is scanned for them but not shuffled.
    """
    known = old.select(*keys).join(new.select(*keys).distinct(), list(keys), "left_semi")
    return dedup_keep_first(new, keys, order).join(known, list(keys), "left_anti")


def with_contents(articles: DataFrame, contents: DataFrame, key: str = "id") -> DataFrame:
    """Articles with their text, empty where there is none."""
    return articles.join(contents.select(key, "content"), key, "left").withColumn("content", F.coalesce("content", F.lit("")))


def with_reports(articles: DataFrame, reports: DataFrame, key: str = "id") -> DataFrame:
    """Articles with their report's fields; `has_report` tells a missing report from a score of 0."""
    report = reports.select(
        key,
        "sentiment",
        "positiveKeywords",
        "negativeKeywords",
        F.col("pubDate").alias("report_date"),
        F.lit(True).alias("has_report"),
    )
    return articles.join(report, key, "left").withColumn("has_report", F.coalesce("has_report", F.lit(False)))


def assemble_news(articles: DataFrame, contents: DataFrame, reports: DataFrame, key: str = "id") -> DataFrame:
    """Articles with their text and report; what is missing gets its default."""
    return with_reports(with_contents(articles, contents, key), reports, key)


def align(df: DataFrame, symbols: Sequence[str], order: Sequence[str], key: str = "symbol", ts: str = "ts", value: str = "close") -> DataFrame:
    """One row per time that any series has, one column per series: one grouping, not k outer joins.

    Of several known values of a series at one time the first in `order` counts.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    return df.withColumn("_order", known).groupBy(ts).pivot(key, list(symbols)).agg(F.min_by(value, "_order"))


def map_names(df: DataFrame, universes: Sequence[DataFrame], key: str = "symbol", name: str = "full_name", max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Adds the full name of each symbol; a later universe overrides an earlier one."""
    ranked = [u.select(key, name).withColumn("_rank", F.lit(i)) for i, u in enumerate(universes)]
    names = dedup_keep_last(reduce(DataFrame.unionByName, ranked), [key], ["_rank", name]).drop("_rank")
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(names, key)
    return join_group(df, sizes, [key], "_n", max_rows).drop("_n")


def calendar_grid(df: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """Every day between the first and last day of the data, for every series.

    The day range is a scalar subquery and each series unfolds its own days, so there is
    no join at all.
    """
    day = F.to_date(ts)
    bounds = df.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi")).alias("b"))
    return (
        df.select(key)
        .distinct()
        .withColumn("_b", bounds.scalar())
        .select(key, F.explode(F.sequence("_b.lo", "_b.hi")).alias("day"))
    )


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(parents, key, "left_anti")


def cascade_delete(parent: DataFrame, children: Sequence[DataFrame], key: str, where: str) -> list[DataFrame]:
    """The parent without the rows that match, and each child without the rows of deleted parents."""
    gone = parent.where(F.expr(where))
    kept = parent.where(~F.coalesce(F.expr(where), F.lit(False)))
    return [kept, *[c.join(gone.select(key), key, "left_anti") for c in children]]


def deletion_order(tables: Mapping[str, Table], table: str) -> list[str]:
    """`table` and all tables that refer to it, over any number of steps, each behind its parents; cycles are refused."""
    reached, waiting = {table}, [table]
    while waiting:
        parent = waiting.pop()
        for name, t in tables.items():
            if parent in t.parents.values() and name not in reached:
                reached.add(name)
                waiting.append(name)
    order: list[str] = []
    while len(order) < len(reached):
        free = [n for n in tables if n in reached and n not in order and all(p in order for p in tables[n].parents.values() if p in reached)]
        # Without a table whose parents are all done the keys go round.
        if not free:
            raise ValueError(f"foreign keys in a cycle: {sorted(reached - set(order))}")
        order += free
    return order


def delete_graph(frames: Mapping[str, DataFrame], tables: Mapping[str, Table], table: str, where: str) -> dict[str, DataFrame]:
    """All frames without the rows of `table` that match, and without every row that refers to a deleted row, over any
    number of steps and by any of its foreign keys. A null foreign key refers to nothing.

    Parents have one key column. Frames of tables that nothing leads to come back as they are.
    """
    kept, gone = dict(frames), {}
    for name in deletion_order(tables, table):
        if name not in frames:
            raise ValueError(f"table {name} refers to deleted rows and is not given")
        rows, about = frames[name], tables[name]
        links = {column: parent for column, parent in about.parents.items() if parent in gone}
        deleted = [gone[parent].select(F.col(tables[parent].key[0]).alias(column)) for column, parent in links.items()]
        if name == table:
            hit = F.coalesce(F.expr(where), F.lit(False))
            left, keys = rows.where(~hit), [rows.where(hit).select(*about.key)]
        else:
            left, keys = rows, []
        for keyed in deleted:
            keys.append(rows.join(keyed, keyed.columns, "left_semi").select(*about.key))
            left = left.join(keyed, keyed.columns, "left_anti")
        kept[name] = left.select(*rows.columns)
        gone[name] = reduce(DataFrame.unionByName, keys).distinct()
    return kept
