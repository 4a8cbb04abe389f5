"""Articles and headlines of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import anchor_texts, article_text, main_text, page_title


def extract_articles(pages: DataFrame, html: str = "html", whole: bool = False) -> DataFrame:
    """The other columns, title, content and error per page; a page without text has an error instead of content.

    The content is the body of the article (see main_text), or, with `whole` and where there is no running text, all
    text of its article element.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    others = [c for c in pages.columns if c != html]
    rows = pages.select(*others, page_title(page).alias("title"), page.alias("_page"))
    if whole:
        rows = rows.withColumn("content", article_text(F.col("_page"))).drop("_page")
    else:
        rows = rows.withColumn("content", main_text(F.col("_page")))
        short = (F.col("content") == "") & F.col("_page").rlike(r"(?i)<article\b")
        rows = rows.withColumn("content", F.when(short, article_text(F.col("_page"))).otherwise(F.col("content"))).drop("_page")
    error = F.when(F.col("content") == "", F.lit("no article text"))
    return rows.withColumn("error", error).withColumn("content", F.when(F.col("content") != "", F.col("content")))


def top_headlines(pages: DataFrame, n: int = 10, container: str = "nav", html: str = "html") -> DataFrame:
    """The first n link texts of each page's ranked list: (page columns, rank, headline)."""
    others = [c for c in pages.columns if c != html]
    texts = F.slice(anchor_texts(F.col(html), container), 1, n)
    return pages.select(*others, F.posexplode(texts).alias("rank", "headline"))
