"""From fetched pages to article texts and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chat import parse_analysis
from tidemark.operators.dedup import dedup_keep_last
from tidemark.plans.scoring import score_once
from tidemark.session import scratch_path
from tidemark.sources.pages import extract_articles


class Analysis(NamedTuple):
    """Texts (id, content, error), reports (id and report fields) and failed scorings (id, error)."""

    contents: DataFrame
    reports: DataFrame
    failures: DataFrame


def article_contents(articles: DataFrame, pages: DataFrame, page_order: Sequence[str] = ("html",), whole: bool = False) -> DataFrame:
    """(id, content, error) of each article from the page at its original link, the last in `page_order`.

    The content is the body of the article, or all text of its element (`whole`, see extract_articles).
    """
    last = dedup_keep_last(pages.select("url", "html", *[c for c in page_order if c != "html"]), ["url"], page_order)
    texts = extract_articles(last.select("url", "html"), whole=whole)
    found = articles.select("id", F.col("originallink").alias("url")).join(texts, "url", "left")
    missing = F.when(F.col("content").isNull(), F.lit("page not fetched"))
    return found.select("id", F.coalesce("content", F.lit("")).alias("content"), F.coalesce("error", missing).alias("error"))


def analyse_articles(
    articles: DataFrame,
    pages: DataFrame,
    make_scorer: Callable[[], Callable[[str], str]],
    page_order: Sequence[str] = ("html",),
    path: str | None = None,
    whole: bool = False,
    **scoring,
) -> Analysis:
    """Texts and reports of articles, in the shape load_news takes.

    The scorer may be slow, cost money or answer differently: its answers are kept below
    `path` (a scratch folder without it), reports and failures come from there, and a run that is repeated
    there asks only for texts without answer (see score_once for further options).
    """
    spark = articles.sparkSession
    contents = article_contents(articles, pages, page_order, whole)
    scored = score_once(contents, make_scorer, path or scratch_path(spark, "scored"), **scoring)
    answered = parse_analysis(scored.where(F.col("error").isNull()).drop("error"))
    meta = articles.select("id", F.date_format("pub_date", "yyyy-MM-dd HH:mm:ss").alias("pubDate"), "title", "originallink", "link")
    return Analysis(
        contents,
        answered.drop("response").join(meta, "id"),
        scored.where(F.col("error").isNotNull()).select("id", "error"),
    )
