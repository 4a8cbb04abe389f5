"""Column expressions: cleaning, dates and text."""

from tidemark.functions.cleaning import (
    drop_nan,
    join_keywords,
    map_role,
    news_key,
    parse_news_date,
    parse_sentiment,
    parse_time,
    risk_fields,
    round_score,
    sanitize_volume,
    sentiment_date,
    to_utc,
)
from tidemark.functions.text import anchor_texts, article_text, main_text, page_title, strip_markup

__all__ = [
    "anchor_texts",
    "article_text",
    "drop_nan",
    "join_keywords",
    "main_text",
    "map_role",
    "news_key",
    "page_title",
    "parse_news_date",
    "parse_sentiment",
    "parse_time",
    "risk_fields",
    "round_score",
    "sanitize_volume",
    "sentiment_date",
    "strip_markup",
    "to_utc",
]
