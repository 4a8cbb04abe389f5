"""Price, risk and news files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import parse_time
from tidemark.operators.dedup import dedup_keep_last
from tidemark.schemas import PRICE_FILE
from tidemark.session import shuffle_tasks, stored
from tidemark.sources.folders import folder_values, write_csv
from tidemark.sources.jsonparts import keyed_entries
from tidemark.sources.tables import ROWS_PER_FILE


def _decode(c):
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _folder_symbol():
    """The folder a file lies in; a name written as "symbol=..." is escaped once more."""
    folder = _decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    written = folder.startswith("symbol=")
    return F.when(written, _decode(F.regexp_replace(folder, "^symbol=", ""))).otherwise(folder)


def read_prices(spark: SparkSession, path: str, schema: str = PRICE_FILE) -> DataFrame:
    """All price files below `path`, one folder per symbol; times in UTC.

    Columns are found by the names in each file's first line, whatever their order and number; columns
    that `schema` doesn't name are left out, missing ones are null. A file whose first line has no `date`,
    and rows whose date can't be read, give no rows. Symbols such as 005930 stay text. The first lines are
    stored, one row per file, and joined with the files' lines.
    """
    wanted = T.StructType.fromDDL(schema)
    files = spark.read.option("recursiveFileLookup", True)
    lines = files.text(path, pathGlobFilter="*.csv")
    # Ids grow along a task's part of a file, so the least one of the part at offset 0 is the first line's.
    at_start = lines.select("value", F.col("_metadata.file_path").alias("_of"), F.col("_metadata.file_block_start").alias("at"))
    at_start = at_start.withColumn("id", F.monotonically_increasing_id()).where("at = 0")
    firsts = stored(at_start.groupBy("_of").agg(F.min_by("value", "id").alias("line")), "first-lines")
    # Commas inside quotes make this too large, never too small.
    width = firsts.agg(F.max(F.length(F.regexp_replace("line", "[^,]", "")) + 1)).first()[0] or 1
    line = ", ".join(f"_c{i} STRING" for i in range(width))
    names = F.from_csv(F.ltrim("line", F.lit("\ufeff")), line)
    names = F.transform(F.array(*[names[f"_c{i}"] for i in range(width)]), lambda c: F.lower(F.trim(c)))
    heads = firsts.select("_of", names.alias("_names")).where(F.array_contains("_names", "date"))
    places = F.struct(*[F.array_position("_names", f.name).cast("int").alias(f.name) for f in wanted])
    heads = heads.select("_of", places.alias("_at"))
    raw = files.schema(line).csv(path, pathGlobFilter="*.csv")
    rows = raw.select(F.col("_metadata.file_path").alias("_file"), _folder_symbol().alias("symbol"), F.array(*raw.columns).alias("_cells"))

    def cell(name: str):
        # Place 0: the file has no such column.
        at = F.col(f"_at.{name}")
        return F.when(at > 0, F.get("_cells", at - 1))

    values = [cell(f.name).try_cast(f.dataType).alias(f.name) for f in wanted if f.name != "date"]
    found = rows.join(heads, F.col("_file") == F.col("_of"))
    return found.select("symbol", parse_time(cell("date")).alias("ts"), *values).where(F.col("ts").isNotNull())


def write_price_files(df: DataFrame, path: str, ts: str = "ts", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Price files in text form, one folder per symbol."""
    text = df.select("symbol", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS+00:00").alias("date"), "open", "high", "low", "close", "volume")
    (
        text.hint("rebalance", "symbol")
        .write.mode("append")
        .option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("symbol")
        .csv(path)
    )


def write_risk(df: DataFrame, path: str) -> None:
    """Risk files in folders of country and symbol, written by one job.

    A folder costs more time than its rows, so folders are dealt to all tasks, not to as few as their bytes would need; a large
    folder is split over several. Tasks write their files and put them in place themselves, since one process would do so for one
    folder after another; a write that was stopped leaves a folder without _SUCCESS.
    """
    rows, by = stored(df, "risk"), ["country", "symbol"]
    large = rows.groupBy(F.col("country").alias("_country"), F.col("symbol").alias("_symbol")).agg(F.count("*").alias("_n")).where(F.col("_n") > ROWS_PER_FILE)
    here = F.col("country").eqNullSafe(F.col("_country")) & F.col("symbol").eqNullSafe(F.col("_symbol"))
    pieces = F.coalesce(F.ceil(F.col("_n") / ROWS_PER_FILE), F.lit(1))
    dealt = rows.join(F.broadcast(large), here, "left").withColumn("_piece", F.pmod(F.xxhash64(*df.columns), pieces))
    tasks = max(shuffle_tasks(df.sparkSession), -(-rows.count() // ROWS_PER_FILE))
    dealt = dealt.repartition(tasks, *by, "_piece").select(*df.columns)
    if write_csv(dealt, path, by):
        return
    write = dealt.write.mode("overwrite").option("header", True).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    write.partitionBy(*by).csv(path)


def read_risk(spark: SparkSession, path: str) -> DataFrame:
    """Risk files with the country and symbol of their folders."""
    schema = "date STRING, risk_value DOUBLE, model_name STRING, analysis_result STRING, test_date STRING, predict_date STRING, risk_score DOUBLE"
    # Files are many and small; the parser's buffer is made anew for each, by default of a million characters.
    files = spark.read.schema(schema).option("header", True).option("inputBufferSize", 1 << 16).option("recursiveFileLookup", True)
    return files.csv(path).select("*", *folder_values(["country", "symbol"]))


def read_table_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict, where: str | None = None, split: tuple[str, str, str, int] | None = None
) -> DataFrame:
    """A database table, filtered by the database; `split` = (column, lowest, highest, parts) reads in parallel."""
    options = {}
    if split:
        options = dict(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), map(str, split)))
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **properties, **options).load()
    return rows.where(F.expr(where)) if where else rows


def insert_rows_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_rows: int = 10_000) -> None:
    """Appends to a database table in batches."""
    df.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=properties)


def write_keyed_json(df: DataFrame, path: str, id_col: str = "id", entry: str = "entry") -> None:
    """(id, entry) rows as JSON lines, ids in the order of their numbers."""
    rows = df.select(F.to_json(F.struct(F.col(id_col).alias("id"), F.col(entry).alias("entry"))).alias("value"), F.col(id_col).try_cast("bigint").alias("_n"))
    rows.sort("_n").select("value").write.mode("overwrite").text(path)


def read_keyed_json(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """(id, entry) rows of JSON lines."""
    return spark.read.schema(f"id STRING, entry {entry}").json(path)


def write_keyed_documents(
    df: DataFrame, path: str, id_col: str = "id", entry: str = "entry", entries_per_document: int = 10_000, order: Sequence[str] = ()
) -> None:
    """(id, entry) rows as documents of the form {"id": {...}, ...}, one per line, of about so many entries each.

    Of rows with one id the last by `order` (the entry itself without it) stays; rows without id are left out.
    """
    rows = dedup_keep_last(df.where(F.col(id_col).isNotNull()), [id_col], list(order) or [entry])
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(entry).alias("entry"))
    slices = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-df.count() // entries_per_document))))
    documents = rows.groupBy(slices.alias("_slice")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("id", "entry")))).alias("d"))
    documents.select(F.to_json("d").alias("value")).write.mode("overwrite").text(path)


def read_keyed_documents(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """(id, entry) rows of documents of the form {"id": {...}, ...}: one document of any size per .json file, or small
    ones, one per line, of the files that write_keyed_documents has written."""
    lines = spark.read.text(path, pathGlobFilter="part-*.txt").select("value")
    small = lines.select(F.explode(F.from_json("value", f"MAP<STRING, {entry}>")).alias("id", "entry"))
    return keyed_entries(spark, path, entry).unionByName(small)
