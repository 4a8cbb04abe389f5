"""Stored tables in folders.

A writer keeps the table's column types and folder columns beside it (LAYOUT), because the names of folders are text:
symbol 005930 stays 005930. Of a table without that file the folder columns are read as text, unless the caller
names their types. Changes read and write only the folders they have rows for. A folder that loses all its rows is
deleted; one of a null value counts like any other (Spark writes an empty text as null).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import OHLC, delete_where, reconcile, reconcile_changes, update_where, upsert
from tidemark.operators.filters import between_dates
from tidemark.operators.joins import anti_existing
from tidemark.session import stored as kept
from tidemark.sources.folders import first_file, folder_values, many_folders, write_parquet

ROWS_PER_FILE = 10_000
LAYOUT = "_layout"
#: Folders that a condition names one by one.
FEW_NAMES = 1000


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file beside a table; None where there is none."""
    at, fs = _folder(spark, path)
    if not fs.exists(at):
        return None
    file = fs.open(at)
    text = bytes(file.readAllBytes()).decode()
    file.close()
    return text


def write_text(spark: SparkSession, path: str, text: str) -> None:
    at, fs = _folder(spark, path)
    out = fs.create(at, True)
    out.write(text.encode())
    out.close()


def read_layout(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    """Column types and folder columns of a table, if its writer has kept them."""
    text = read_text(spark, f"{path}/{LAYOUT}")
    if text is None:
        return None
    kept = json.loads(text)
    return T.StructType.fromJson(kept["schema"]), kept["by"]


def write_layout(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Keeps the types of `df` beside a table; columns that are new to the table are added, other types are refused."""
    spark, schema = df.sparkSession, df.schema
    known = read_layout(spark, path)
    if known:
        types = {f.name: f.dataType for f in known[0]}
        differs = [f.name for f in schema if types.get(f.name, f.dataType) != f.dataType]
        if differs or known[1] != list(by):
            raise ValueError(f"{path} is laid out by {known[1]}; columns with another type there: {differs}")
        if set(schema.names) <= set(types):
            return
        schema = T.StructType([*known[0], *[f for f in schema if f.name not in types]])
    write_text(spark, f"{path}/{LAYOUT}", json.dumps({"schema": json.loads(schema.json()), "by": list(by)}))


def read_stored(spark: SparkSession, path: str, folders: Mapping[str, str] | None = None) -> DataFrame:
    """A stored table with the types it was written with; `folders` names types of folder columns of tables without layout."""
    known = read_layout(spark, path)
    if known:
        schema, by = known
    else:
        data, by = _inferred(spark, path)
        kinds = {n: T._parse_datatype_string(t) for n, t in (folders or {}).items()}
        schema = T.StructType([*data, *[T.StructField(n, kinds.get(n, T.StringType())) for n in by]])
    if not by or not many_folders(spark, path):
        return spark.read.schema(schema).parquet(path)
    rows = T.StructType([f for f in schema if f.name not in by])
    values = [v.cast(schema[c].dataType).alias(c) for c, v in zip(by, folder_values(by))]
    return spark.read.schema(rows).option("recursiveFileLookup", True).parquet(path).select(*rows.names, *values)


def _inferred(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """The columns that the files hold, by the first of them, and the folder columns of a table without layout."""
    first = first_file(spark, path)
    if first:
        # Not every folder is looked at: there may be hundreds of thousands.
        data = spark.read.parquet(first[0]).schema
        return data, [n for n in first[1] if n not in data.names]
    # Without a look at the folders, then with it: what is new are the folder columns.
    data = spark.read.option("recursiveFileLookup", True).parquet(path).schema
    return data, [n for n in spark.read.parquet(path).schema.names if n not in data.names]


def write_folders(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes a new table in folders of `by`, without layout; few tasks write to a folder, however many folders there are."""
    write_parquet(df, path, by)


def append_rows(df: DataFrame, path: str, by: Sequence[str] = (), rows_per_file: int = 0) -> None:
    """Appends to a table in folders of `by`, in one job.

    The rebalance hint gives every folder to few tasks and splits a folder that is too large for one.
    """
    write_layout(df, path, by)
    out = df.hint("rebalance", *by) if by else df
    out.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def append_prices(df: DataFrame, path: str, ts: str = "ts", by: Sequence[str] = ("symbol",), rows_per_file: int = ROWS_PER_FILE) -> None:
    """Appends to a table in folders of `by` and month, at most `rows_per_file` rows per file."""
    append_rows(df.withColumn("month", F.trunc(F.to_date(ts), "MM")), path, [*by, "month"], rows_per_file)


def read_prices_range(spark: SparkSession, path: str, start: str, end: str, ts: str = "ts", schema: str | None = None) -> DataFrame:
    """Rows between two times; only the month folders of the range are read."""
    table = spark.read.schema(schema).parquet(path) if schema else read_stored(spark, path, {"month": "date"})
    first = F.trunc(F.lit(start).cast("date"), "MM")
    last = F.trunc(F.lit(end).cast("date"), "MM")
    return between_dates(table.where(F.col("month").between(first, last)), start, end, ts)


def read_table(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """A stored table, or the rows that match a condition (pushed to the scan)."""
    table = read_stored(spark, path)
    return table.where(F.expr(where)) if where else table


# --- inserts ---------------------------------------------------------------------------


def insert_rows(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], strict: bool = False) -> None:
    """Appends the rows whose key is not stored, as one job; `strict` refuses a batch with a stored key."""
    spark = df.sparkSession
    stored = read_stored(spark, path)
    if strict and not df.join(stored.select(*keys), list(keys), "left_semi").isEmpty():
        raise ValueError(f"rows with these keys exist already: {list(keys)}")
    known = read_layout(spark, path)
    anti_existing(df, stored, keys, order).write.mode("append").partitionBy(*(known[1] if known else [])).parquet(path)


def insert_groups(df: DataFrame, path: str, keys: Sequence[str], group: str = "symbol") -> DataFrame:
    """All or nothing for each group (a series): groups with a stored key, or with one key twice, add no row at all.

    The other groups are appended by one job, which adds all its files or none. Returns the refused groups
    with their rows and the reason; keys with a null are never equal.
    """
    spark = df.sparkSession
    stored = read_stored(spark, path)
    # A batch is small beside the table: its keys are sent to the table, not the other way.
    there = stored.join(df.select(*keys).distinct(), list(keys), "left_semi").select(*keys).distinct()
    there = df.join(there, list(keys), "left_semi").select(group)
    twice = df.dropna(subset=list(keys)).groupBy(group, *[k for k in keys if k != group]).count().where("count > 1").select(group)
    reasons = there.withColumn("reason", F.lit("stored already")).unionByName(twice.withColumn("reason", F.lit("repeated key")))
    reasons = reasons.groupBy(group).agg(F.max("reason").alias("reason"))
    refused = kept(reasons, "refused-groups")
    known = read_layout(spark, path)
    fine = df.join(refused.select(F.col(group).alias("_g")), F.col(group).eqNullSafe(F.col("_g")), "left_anti")
    counts = df.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("n_rows"))
    out = refused.join(counts, F.col(group).eqNullSafe(F.col("_g"))).select(group, "n_rows", "reason")
    out = kept(out, "refused-groups")
    fine.write.mode("append").partitionBy(*(known[1] if known else [])).parquet(path)
    return out


# --- changes of folders ----------------------------------------------------------------


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces the folders of `by` that `df` has rows for; all others stay as they are.

    `df` may come from the same table: the new folders are put in place when all are written.
    """
    write_parquet(df, path, by, overwrite=True)


def in_folders(stored: DataFrame, folders: DataFrame, by: Sequence[str], many: bool = False) -> DataFrame:
    """The stored rows that lie in the same folders as `folders`; null folders count.

    Plain equality lets Spark prune the folders it reads; folders with a null are looked up apart. Of a table of `many` folders,
    whose values Spark doesn't know as such, the files to read are told by a condition if it needs few values.
    """
    names = folders.select(*by).distinct()
    plain = stored
    few = names.limit(FEW_NAMES + 1).collect() if many else []
    if many and len(few) <= FEW_NAMES:
        for c in by:
            plain = plain.where(F.col(c).isin(sorted({r[c] for r in few} - {None})))
    plain = plain.join(names, list(by), "left_semi")
    unnamed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by])
    odd = names.where(unnamed).select(*[F.col(c).alias(f"_{c}") for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return plain.unionByName(stored.where(unnamed).join(odd, same, "left_semi")).select(*stored.columns)


def delete_folders(spark: SparkSession, uris: Sequence[str]) -> None:
    for uri in uris:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _rewrite(spark: SparkSession, path: str, hit: Column, change: Callable[[DataFrame], DataFrame], table: DataFrame) -> None:
    """Changes the folders that hold a row for which `hit` is true; a folder without a row afterwards is deleted."""
    known = read_layout(spark, path)
    if not known or not known[1]:
        raise ValueError(f"{path} has no folders that could be rewritten one by one")
    by = known[1]
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    rows = table.withColumn("_folder", folder).withColumn("_hit", F.coalesce(hit, F.lit(False)))
    # One row per folder with a hit; the folders' rows are read once more.
    touched = rows.groupBy("_folder").agg(F.bool_or("_hit").alias("hit"), F.any_value(F.struct(*by)).alias("at")).where("hit")
    touched = [(r["_folder"], *r["at"]) for r in touched.collect()]
    if not touched:
        return
    fields = [T.StructField("_folder", T.StringType()), *[T.StructField(c, table.schema[c].dataType) for c in by]]
    folders = spark.createDataFrame(touched, T.StructType(fields))
    changed = change(in_folders(table, folders, by, many_folders(spark, path)))
    names = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in by]
    filled = changed.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
    empty = [r["_folder"] for r in folders.join(filled, names, "left_anti").collect()]
    if len(empty) < len(touched):
        overwrite_partitions(changed, path, by)
    delete_folders(spark, empty)
    spark.catalog.refreshByPath(path)


def upsert_table(batch: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str], order: Sequence[str], by: Sequence[str]) -> None:
    """`upsert` into a stored table in folders of `by` (part of the key): only the batch's folders are read and written.

    Folder columns have the batch's types, whatever their names look like.
    """
    if not set(by) <= set(keys):
        raise ValueError(f"{list(by)} must be part of the key {list(keys)}")
    stored = read_stored(batch.sparkSession, path, {c: batch.schema[c].dataType.simpleString() for c in by})
    touched = in_folders(stored, batch, by, many_folders(batch.sparkSession, path))
    overwrite_partitions(upsert(touched, batch, keys, update_cols, order=order), path, by)
    batch.sparkSession.catalog.refreshByPath(path)


def reconcile_table(new: DataFrame, path: str, keys: Sequence[str] = ("symbol", "ts"), cols: Sequence[str] = OHLC, tol: float = 1e-4) -> None:
    """`reconcile` in a stored table: the folders with a changed row are written anew; no row is added.

    The batch holds each key once, and its folder columns if the keys don't have them (see append_prices: month).
    """
    spark = new.sparkSession
    known = read_layout(spark, path)
    if not known or not set(known[1]) <= set(new.columns):
        raise ValueError(f"the batch must have the folder columns of {path}: {known and known[1]}")
    by, table = known[1], read_stored(spark, path)
    on = [*keys, *[c for c in by if c not in keys]]
    many = many_folders(spark, path)
    changes = reconcile_changes(new, in_folders(table, new, by, many), on, cols, tol)
    folders = in_folders(table, changes, by, many)
    if changes.isEmpty():
        return
    overwrite_partitions(reconcile(new, folders, on, cols, tol), path, by)
    spark.catalog.refreshByPath(path)


def update_table(spark: SparkSession, path: str, sets: Mapping[str, object], where: str) -> None:
    """UPDATE ... SET ... WHERE ... of a stored table; only folders with a hit are written. Folder columns can't be set."""
    table = read_stored(spark, path)
    known = read_layout(spark, path)
    if known and set(sets) & set(known[1]):
        raise ValueError(f"rows can't change their folder: {sorted(set(sets) & set(known[1]))}")
    _rewrite(spark, path, F.expr(where), lambda rows: update_where(rows, sets, where), table)


def delete_rows(spark: SparkSession, path: str, where: str) -> None:
    """DELETE ... WHERE ... of a stored table; only folders with a hit are written. A null condition keeps the row."""
    _rewrite(spark, path, F.expr(where), lambda rows: delete_where(rows, where), read_stored(spark, path))


def drop_old_days(spark: SparkSession, path: str, days: int, as_of: str, ts: str = "ts", by: str = "month") -> None:
    """Retention in a table whose folders include the month (see append_prices): older folders are deleted, those of the
    month of the first day kept are written anew where they hold older days. Rows without a time stay."""
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    table = read_stored(spark, path, {by: "date"})
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    # Names of folders only: no column of these rows is read.
    old = table.where(F.col(by) < F.trunc(first, "MM")).select(folder.alias("f")).distinct()
    delete_folders(spark, [r["f"] for r in old.collect()])
    spark.catalog.refreshByPath(path)
    border = table.where(F.col(by) == F.trunc(first, "MM"))
    _rewrite(spark, path, F.to_date(ts) < first, lambda rows: rows.where(F.coalesce(F.to_date(ts) >= first, F.lit(True))), border)
