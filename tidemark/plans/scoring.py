"""Scoring that asks for every text once and goes on where it stopped.

Texts that haven't been asked for are put in a queue of small files, one row per distinct text. A stream works the queue off, a few
files at a time, and stores the answers by the digest of the text; what is answered stays answered when a run is stopped,
and the next run, of the same articles or of others, asks only for what is left. Only the files of the step that was
stopped are asked for again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.chat import score_articles
from tidemark.operators.filters import present_content

QUEUE = "digest STRING, content STRING, attempt INT"
#: Steps that a run is made for at most: every step costs seconds of its own, and looks at the names of all files.
STEPS = 64


def _ready(spark: SparkSession, path: str) -> None:
    """The folder of the queue exists."""
    spark.createDataFrame([], QUEUE).write.mode("append").parquet(f"{path}/queue")


def _answers(spark: SparkSession, path: str) -> DataFrame:
    """digest, attempt, response, error: the last answer for every text."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/answers/_spark_metadata")
    schema = "digest STRING, attempt INT, response STRING, error STRING"
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    newest = Window.partitionBy("digest").orderBy(F.desc("attempt"))
    rows = spark.read.schema(schema).parquet(f"{path}/answers")
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def enqueue(
    articles: DataFrame, path: str, content: str = "content", rows_per_file: int = 64, again: bool = False, files_per_step: int = 64
) -> None:
    """Puts the distinct texts that were never queued into the queue; `again` also those whose last answer is an error.

    Files hold `rows_per_file` texts, or more where STEPS steps of `files_per_step` files wouldn't hold all that is new.
    """
    spark = articles.sparkSession
    _ready(spark, path)
    texts = present_content(articles, content).select(F.sha2(content, 256).alias("digest"), F.col(content).alias("content"))
    queued = spark.read.schema(QUEUE).parquet(f"{path}/queue")
    fresh = texts.dropDuplicates(["digest"]).join(queued.select("digest"), "digest", "left_anti").withColumn("attempt", F.lit(0))
    if again:
        failed = _answers(spark, path).where(F.col("error").isNotNull()).select("digest", (F.col("attempt") + 1).alias("attempt"))
        waiting = queued.groupBy("digest").agg(F.max("attempt").alias("_last"))
        failed = failed.join(waiting, "digest").where(F.col("attempt") > F.col("_last")).drop("_last")
        first = queued.where("attempt = 0").select("digest", "content")
        fresh = fresh.unionByName(first.join(failed, "digest"))
    most = max(rows_per_file, -(-fresh.select("digest").count() // (STEPS * files_per_step)))
    fresh.write.mode("append").option("maxRecordsPerFile", most).parquet(f"{path}/queue")


def work_off(spark: SparkSession, make_scorer: Callable[[], Callable[[str], str]], path: str, files_per_step: int = 64, tries: int = 3, pause: float = 1.0) -> None:
    """Asks for everything in the queue that has no answer yet."""
    queue = spark.readStream.schema(QUEUE).option("maxFilesPerTrigger", files_per_step).parquet(f"{path}/queue")
    named = queue.select(F.struct("digest", "attempt").alias("id"), "content")
    answers = score_articles(named, make_scorer, tries=tries, pause=pause).select("id.digest", "id.attempt", "response", "error")
    writer = answers.writeStream.format("parquet").option("path", f"{path}/answers").option("checkpointLocation", f"{path}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()


def score_once(
    articles: DataFrame,
    make_scorer: Callable[[], Callable[[str], str]],
    path: str,
    key: str = "id",
    content: str = "content",
    rows_per_file: int = 64,
    files_per_step: int = 64,
    tries: int = 3,
    pause: float = 1.0,
    again: bool = False,
) -> DataFrame:
    """(key, response, error) of every article with content, as `score_articles` gives them; answers are kept below `path`.

    Equal texts are asked for once, in steps of `files_per_step` files of `rows_per_file` texts; large runs have larger files
    instead of more than about STEPS steps. A text that fails is tried `tries` times with growing pauses; its error is kept, and
    `again` asks for it anew.
    """
    spark = articles.sparkSession
    enqueue(articles, path, content, rows_per_file, again, files_per_step)
    work_off(spark, make_scorer, path, files_per_step, tries, pause)
    rows = present_content(articles, content).select(key, F.sha2(content, 256).alias("digest"))
    return rows.join(_answers(spark, path), "digest").select(key, "response", "error")
