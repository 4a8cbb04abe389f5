"""Articles: positions and loads into the news tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import join_keywords, news_key, parse_sentiment, sentiment_date
from tidemark.operators.joins import anti_existing, with_contents, with_reports
from tidemark.operators.series import ROWS_PER_TASK, assign_ids, with_position
from tidemark.session import scratch_path

# Fixed value: the source stored with every article of the news feed.
NEWS_SOURCE = "Naver"


def article_positions(df: DataFrame, company: str = "company", pub_date: str = "pub_date", tie: Sequence[str] = ("link",), max_rows: int = ROWS_PER_TASK) -> DataFrame:
    """0-based rank of each article of a company by date; articles without a date come last."""
    return with_position(df, [company], pub_date, [pub_date, *tie], "position", max_rows)


def news_rows(rows: DataFrame) -> DataFrame:
    """Assembled articles with score, keywords and dates as the tables hold them."""
    return rows.withColumns(
        {
            "sentiment": F.bround(parse_sentiment("sentiment"), 4),
            "positive_keywords": join_keywords("positiveKeywords"),
            "negative_keywords": join_keywords("negativeKeywords"),
            "pub_date": sentiment_date("report_date", "pub_date"),
        }
    )


def stage_news(
    articles: DataFrame,
    contents: DataFrame,
    reports: DataFrame,
    existing: DataFrame,
    path: str,
    order: Sequence[str] = ("company", "pub_date", "id"),
) -> DataFrame:
    """The new articles with their ids, texts, reports and companies, written to `path` once.

    An article is new when its key is not among the `news_api` of `existing`; it counts once,
    under its first company. The three news tables are derived from the staged rows, so
    writing one of them does not change the others.
    """
    keyed = articles.withColumns(
        {"news_api": news_key("originallink", "link"), "title": F.coalesce("title", F.lit(""))}
    )
    fresh = anti_existing(keyed.where(F.col("pub_date").isNotNull()), existing, ["news_api"], order)
    last_id = existing.agg(F.coalesce(F.max("news_id"), F.lit(0)).alias("last_id")).scalar()
    numbered = assign_ids(fresh, ["news_api"], last_id, "news_id")
    companies = keyed.groupBy(F.col("news_api").alias("_key")).agg(F.sort_array(F.collect_set("company")).alias("companies"))
    full = with_reports(with_contents(numbered, contents), reports)
    full = full.join(companies, F.col("news_api") == F.col("_key"), "left").drop("_key")
    full.write.mode("overwrite").parquet(path)
    return articles.sparkSession.read.schema(full.schema).parquet(path)


def news_tables(staged: DataFrame, source: str = NEWS_SOURCE, link_all: bool = False) -> dict[str, DataFrame]:
    """The rows of the three news tables; with `link_all` every company that has an article is linked."""
    company = F.explode("companies") if link_all else F.col("company")
    linked = staged.select("news_id", company.alias("company_code"))
    return {
        "news_main": staged.select("news_id", "title", "content", "pub_date", F.lit(source).alias("source"), "news_api"),
        "news_company": linked.where(F.coalesce(F.col("company_code") != "", F.lit(False))),
        "news_sentiment": news_rows(staged).select(
            "news_id", "sentiment", "positive_keywords", "negative_keywords", "pub_date", "has_report"
        ),
    }


def load_news(
    articles: DataFrame,
    contents: DataFrame,
    reports: DataFrame,
    existing: DataFrame,
    source: str = NEWS_SOURCE,
    order: Sequence[str] = ("company", "pub_date", "id"),
    link_all: bool = False,
    path: str | None = None,
) -> dict[str, DataFrame]:
    """The rows to add to the three news tables, and the rejected articles.

    All three come from the staged rows at `path` (a scratch folder without it), whatever
    happens to `existing` afterwards. Articles without a date are rejected, since the
    tables need one.
    """
    path = path or scratch_path(articles.sparkSession, "news")
    staged = stage_news(articles, contents, reports, existing, path, order)
    return news_tables(staged, source, link_all) | {"rejected": articles.where(F.col("pub_date").isNull())}


def insert_news(staged: DataFrame, tables: Mapping[str, str], **options) -> None:
    """Adds staged rows to the stored tables (name to path), each row once however often this is run.

    The main table comes last: as long as an article is not in it, a run that was stopped
    can be repeated from its articles, and afterwards from its staged rows.
    """
    rows = news_tables(staged, **options)
    keys = {"news_company": ["news_id", "company_code"], "news_sentiment": ["news_id"], "news_main": ["news_id"]}
    for name, key in keys.items():
        anti_existing(rows[name], staged.sparkSession.read.parquet(tables[name]), key, key).write.mode("append").parquet(tables[name])


def load_news_tables(articles: DataFrame, contents: DataFrame, reports: DataFrame, tables: Mapping[str, str], staging: str, **options) -> None:
    """One load into the stored tables. What a stopped load has staged is added first."""
    spark = articles.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/_SUCCESS")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        insert_news(spark.read.parquet(staging), tables, **options)
    insert_news(stage_news(articles, contents, reports, spark.read.parquet(tables["news_main"]), staging), tables, **options)
