"""Row types of the feeds, files and tables."""

from __future__ import annotations

from dataclasses import dataclass

PRICE_FILE = "date STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"

PRICE_PAYLOAD = (
    "values ARRAY<STRUCT<datetime: STRING, open: STRING, high: STRING, "
    "low: STRING, close: STRING, volume: STRING>>"
)

NEWS_PAYLOAD = (
    "items ARRAY<STRUCT<title: STRING, originallink: STRING, link: STRING, "
    "description: STRING, pubDate: STRING>>"
)

CONTENT_ENTRY = (
    "STRUCT<pubDate: STRING, title: STRING, originallink: STRING, link: STRING, "
    "content: STRING, error: STRING>"
)

REPORT_ENTRY = (
    "STRUCT<sentiment: STRING, positiveKeywords: ARRAY<STRING>, negativeKeywords: ARRAY<STRING>, "
    "companyName: STRING, companySector: STRING, pubDate: STRING, title: STRING, "
    "originallink: STRING, link: STRING, error: STRING, raw_response: STRING>"
)

ANALYSIS = (
    "CompanyName STRING, CompanySector STRING, Sentiment STRING, "
    "PositiveKeywords ARRAY<STRING>, NegativeKeywords ARRAY<STRING>"
)

# Names in a model response and the names the reports carry.
ANALYSIS_FIELDS = {
    "CompanyName": "companyName",
    "CompanySector": "companySector",
    "Sentiment": "sentiment",
    "PositiveKeywords": "positiveKeywords",
    "NegativeKeywords": "negativeKeywords",
}


@dataclass(frozen=True)
class Field:
    """One column of a stored table: its type, text length and whether null is allowed."""

    name: str
    type: str
    length: int | None = None
    nullable: bool = False


@dataclass(frozen=True)
class Table:
    """A stored table: columns, primary key and foreign keys (column -> parent table)."""

    fields: tuple[Field, ...]
    key: tuple[str, ...]
    parents: dict[str, str]


def _text(name, length=None, nullable=False):
    return Field(name, "string", length, nullable)


# The stored tables.
TABLES = {
    "company_meta": Table(
        (_text("company_code", 12), _text("company_name", 100), _text("country", 10), _text("sector", 50)),
        ("company_code",),
        {},
    ),
    "company_division": Table(
        (_text("division_code", 11), _text("division_name", 100), _text("company_code", 12)),
        ("division_code",),
        {"company_code": "company_meta"},
    ),
    "branch_meta": Table(
        (_text("scm_key", 15), _text("scm_name", 100), _text("division_code", 11)),
        ("scm_key",),
        {"division_code": "company_division"},
    ),
    "supply_chain": Table(
        (
            Field("scm_idx", "int"),
            _text("scm_key", 15),
            _text("product", 100, True),
            Field("ratio", "decimal(7,4)", None, True),
            _text("loc_name", 255, True),
            _text("iso", 2, True),
            _text("address", 255, True),
            _text("state", 100, True),
            Field("lat", "decimal(10,8)", None, True),
            Field("lon", "decimal(11,8)", None, True),
        ),
        ("scm_idx",),
        {"scm_key": "branch_meta"},
    ),
    "news_main": Table(
        (
            Field("news_id", "bigint"),
            _text("title", 255),
            _text("content"),
            Field("pub_date", "timestamp"),
            _text("source", 100),
            _text("news_api", 255),
        ),
        ("news_id",),
        {},
    ),
    "news_company": Table(
        (Field("news_id", "bigint"), _text("company_code", 12)),
        ("news_id", "company_code"),
        {"news_id": "news_main", "company_code": "company_meta"},
    ),
    "news_sentiment": Table(
        (
            Field("news_id", "bigint"),
            Field("sentiment", "decimal(7,4)"),
            _text("positive_keywords", None, True),
            _text("negative_keywords", None, True),
            Field("pub_date", "timestamp"),
        ),
        ("news_id",),
        {"news_id": "news_main"},
    ),
    "risk": Table(
        (
            _text("company_code", 12),
            _text("model_name", 50),
            _text("analysis_result", 255),
            Field("test_date", "date"),
            Field("predict_date", "date"),
            Field("risk_score", "decimal(7,4)"),
        ),
        ("company_code", "model_name", "predict_date", "test_date"),
        {},
    ),
    "stock_price": Table(
        (
            _text("company_code", 12),
            Field("date", "timestamp"),
            Field("open", "decimal(12,4)"),
            Field("high", "decimal(12,4)"),
            Field("low", "decimal(12,4)"),
            Field("close", "decimal(12,4)"),
            Field("volume", "bigint"),
        ),
        ("company_code", "date"),
        {"company_code": "company_meta"},
    ),
}
