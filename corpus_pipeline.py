"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept; all but the last return the
columns of the documents. `run` writes each stage's rows to the shared folder and reads them for the next.

Defined results: null and empty texts go through every stage (no word of theirs is toxic, their quality is judged by their
length, they have no duplicates, their sequence holds the end only). Null sources and languages form groups of their own.
Rows with equal ids are documents of their own: those with different texts stay, of copies one. Rows without id have no smallest
one and stay.
Extra columns are kept up to the last stage, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, packing, quality, toxicity
from tidemark.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity reaches the threshold."""
    machine = toxicity.fit_on_labels(spark, sf_dir, docs)
    # A document travels as one column, whatever its own columns are called, and its text only once.
    rows = toxicity.with_score(docs.select(F.struct("*").alias("doc")), machine, text="doc.text")
    return rows.where(F.col("score") < toxicity.THRESHOLD).select("doc.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose posterior is below the threshold; the source is the host, the language the path."""
    classifier = quality.fit_on_labels(spark, sf_dir, docs)
    rows = docs.select(F.struct("*").alias("doc"), "text", "source", "lang")
    judged = quality.judge(rows, classifier, F.col("source"), F.col("lang"))
    return judged.where(F.col("posterior") >= quality.THRESHOLD).select("doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of copies and near copies: the one with the smallest id.

    Rows are known by their place in `docs`, which are read from storage and so have the same places each time.
    """
    # A document travels as one column, whatever its own columns are called.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    linked = jaccard.link(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")))
    linked = linked.where("members > 1").select(F.col("doc_id").alias("row"), "component_id")
    members = stored(linked.join(rows.select("row", F.col("doc.doc_id").alias("id")), "row"), "copies")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row")))["row"]
    stays = members.groupBy("component_id").agg(first.alias("row")).select("row")
    gone = members.where("id IS NOT NULL").join(stays, "row", "left_anti").select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_copies),
    ("packing", pack_sequences),
]

#: SQL expresses neither the fitted models nor the packing; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
