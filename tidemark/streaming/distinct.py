"""The first row of every key over all batches, by keyed state.

Keys are digests, and the state lies in RocksDB: on the executors' disks with copies in the checkpoint folder, not in memory and
not in files of the table. What is dealt out by key is the batch alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a stream with keyed state is started with, unless the session says otherwise; a stream keeps what it was started with.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "8",
}


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings above for streams that are started inside."""
    mine = [k for k in STATE_SETTINGS if k not in spark.conf.getAll]
    for k in mine:
        spark.conf.set(k, STATE_SETTINGS[k])
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def key_digest(keys: Sequence[str]):
    """A digest of the key columns; a null differs from an empty text."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys]))


def first_rows(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """The rows of a stream whose key no row before had, and the output mode to write them with (see new_rows).

    With `order` the first of a batch's rows with one key counts, and the state holds that row; without it the state
    holds the digests alone and any copy counts.
    """
    rows = source.withColumn("_key", key_digest(keys))
    if not order:
        return rows.dropDuplicates(["_key"]).drop("_key"), "append"
    row = F.struct(*source.columns)
    arrived = F.current_timestamp()
    firsts = (
        rows.withColumn("_at", arrived)
        .groupBy("_key")
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.min_by(row, F.struct("_at", *order)).alias("_row"))
    )
    return firsts.select("_row", (F.col("_first") == F.col("_last")).alias("_new")), "update"


def new_rows(batch: DataFrame) -> DataFrame:
    """The new rows of a batch of `first_rows`: keys that come again are left out."""
    return batch.where("_new").select("_row.*") if "_new" in batch.columns else batch
