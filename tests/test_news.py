from datetime import datetime

import pytest

from tidemark.operators import news
from tidemark.plans.news import analyse_articles

ARTICLE = "id bigint, company string, title string, originallink string, link string, pub_date timestamp_ntz"


@pytest.fixture
def inputs(spark):
    day = datetime(2024, 1, 1)
    articles = spark.createDataFrame(
        [
            (1, "a", "t1", "u1", "n1", day),
            (2, "b", "t1 again", "u1", "n1", day),
            (3, "a", None, "", "n3", day),
            (4, "a", "no date", "u4", "n4", None),
            (5, "", "no company", "u5", "n5", day),
            (6, "b", "known", "u6", "n6", day),
        ],
        ARTICLE,
    )
    contents = spark.createDataFrame([(1, "text 1"), (5, None)], "id bigint, content string")
    reports = spark.createDataFrame(
        [(1, "0.75555", ["up"], [], "2024-03-01 10:00:00"), (3, None, None, ["down", "loss"], "later")],
        "id bigint, sentiment string, positiveKeywords array<string>, negativeKeywords array<string>, pubDate string",
    )
    existing = spark.createDataFrame([(40, "u6")], "news_id bigint, news_api string")
    return articles, contents, reports, existing


def test_new_articles_get_one_id_in_all_tables(inputs):
    out = news.load_news(*inputs)
    main = {r.news_api: r for r in out["news_main"].collect()}
    assert set(main) == {"u1", "n3", "u5"}
    assert sorted(r.news_id for r in main.values()) == [41, 42, 43]
    assert (main["u1"].title, main["u1"].content, main["n3"].title, main["n3"].content) == ("t1", "text 1", "", "")
    linked = {(r.news_id, r.company_code) for r in out["news_company"].collect()}
    assert linked == {(main["u1"].news_id, "a"), (main["n3"].news_id, "a")}
    tone = {r.news_id: r for r in out["news_sentiment"].collect()}
    one, three, five = (tone[main[k].news_id] for k in ("u1", "n3", "u5"))
    assert (one.sentiment, one.positive_keywords, one.negative_keywords, one.pub_date) == (0.7556, "up", "", datetime(2024, 3, 1, 10))
    assert (three.sentiment, three.negative_keywords, three.pub_date, three.has_report) == (0.0, "down, loss", datetime(2024, 1, 1), True)
    assert (five.sentiment, five.has_report) == (0.0, False)
    assert [r.id for r in out["rejected"].collect()] == [4]


def test_all_companies_can_be_linked(inputs):
    out = news.load_news(*inputs, link_all=True)
    one = out["news_main"].where("news_api = 'u1'").first().news_id
    assert sorted(r.company_code for r in out["news_company"].where(f"news_id = {one}").collect()) == ["a", "b"]


def test_a_second_load_adds_nothing(inputs):
    articles, contents, reports, existing = inputs
    first = news.load_news(*inputs)["news_main"].select("news_id", "news_api")
    assert news.load_news(articles, contents, reports, existing.union(first))["news_main"].count() == 0


def test_positions_put_unknown_dates_last(inputs):
    articles = inputs[0]
    out = {r.id: r.position for r in news.article_positions(articles, tie=["link", "id"]).collect()}
    assert (out[1], out[3], out[4]) == (0, 1, 2)
    split = {r.id: r.position for r in news.article_positions(articles, tie=["link", "id"], max_rows=1).collect()}
    assert split == out


def test_from_pages_to_tables(spark, inputs):
    articles, _, _, existing = inputs
    pages = spark.createDataFrame(
        [("u1", "<title>T</title><article>good news</article>"), ("u4", "<article>bad news</article>"), ("u5", "<article>odd</article>")],
        "url string, html string",
    )

    def make():
        def score(text):
            if "bad" in text:
                raise RuntimeError("no answer")
            return "no json" if "odd" in text else '{"Sentiment": "0.9", "PositiveKeywords": ["good"]}'

        return score

    contents, reports, failures = analyse_articles(articles, pages, make)
    texts = {r.id: (r.content, r.error) for r in contents.collect()}
    assert texts[1] == texts[2] == ("good news", None) and texts[6] == ("", "page not fetched")
    assert [(r.id, r.error) for r in failures.collect()] == [(4, "RuntimeError: no answer")]
    found = {r.id: (r.sentiment, r.error, r.title) for r in reports.collect()}
    assert found == {1: ("0.9", None, "t1"), 2: ("0.9", None, "t1 again"), 5: (None, "Invalid JSON from GPT", "no company")}
    tables = news.load_news(articles, contents, reports, existing)
    tone = {r.news_id: (r.sentiment, r.positive_keywords, r.has_report) for r in tables["news_sentiment"].collect()}
    ids = {r.news_api: r.news_id for r in tables["news_main"].collect()}
    assert tone[ids["u1"]] == (0.9, "good", True) and tone[ids["u5"]] == (0.0, "", True) and tone[ids["n3"]] == (0.0, "", False)
