from datetime import datetime

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import cleaning, filters


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


def test_round_half_even(spark):
    assert one(spark, 0.12345, "double", fn.round_score) == 0.1234
    assert one(spark, 2.00005, "double", fn.round_score) == 2.0
    assert one(spark, None, "double", fn.round_score) == 0.0
    assert one(spark, float("nan"), "double", fn.round_score) == 0.0


def test_volume(spark):
    for raw, clean in [(None, 0), (float("nan"), 0), (-5.0, 0), (7.9, 7), (1e12, 10**12)]:
        assert one(spark, raw, "double", fn.sanitize_volume) == clean


def test_seoul_midnight_is_the_day_before_in_utc(spark):
    assert one(spark, datetime(2024, 1, 2), "timestamp_ntz", lambda c: fn.to_utc(c, "Asia/Seoul")) == datetime(2024, 1, 1, 15)


def test_times(spark):
    assert one(spark, "2024-01-02T00:00:00+09:00", "string", fn.parse_time) == datetime(2024, 1, 1, 15)
    assert one(spark, "2024-01-02", "string", fn.parse_time) == datetime(2024, 1, 2)
    assert one(spark, "soon", "string", fn.parse_time) is None
    assert one(spark, "Mon, 26 Sep 2016 07:50:00 +0900", "string", fn.parse_news_date) == datetime(2016, 9, 25, 22, 50)
    assert one(spark, "26.9.2016", "string", fn.parse_news_date) is None


def test_sentiment_defaults(spark):
    cases = [("0.75", 0.75), (" 1 ", 1.0), ("n/a", 0.0), (None, 0.0), ("", 0.0), ("NaN", 0.0), ("Infinity", 0.0)]
    for raw, score in cases:
        assert one(spark, raw, "string", fn.parse_sentiment) == score


def test_keywords(spark):
    assert one(spark, ["a", "b"], "array<string>", fn.join_keywords) == "a, b"
    assert one(spark, [], "array<string>", fn.join_keywords) == ""
    assert one(spark, None, "array<string>", fn.join_keywords) == ""


def test_news_key(spark):
    df = spark.createDataFrame([("o", "l"), ("", "l"), (None, "l")], "a string, b string")
    assert [r[0] for r in df.select(fn.news_key("a", "b")).collect()] == ["o", "l", "l"]


def test_rename_keys_keeps_unknown_keys(spark):
    df = spark.createDataFrame([({"Sentiment": "1", "other": "2"},)], "m map<string,string>")
    from tidemark.schemas import ANALYSIS_FIELDS

    assert df.select(cleaning.rename_keys(F.col("m"), ANALYSIS_FIELDS)).first()[0] == {"sentiment": "1", "other": "2"}


def test_stamp_risk_in_market_time(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 15), 12.5)], "ts timestamp_ntz, risk_value double")
    utc = cleaning.stamp_risk(df, "2024-02-01").first()
    seoul = cleaning.stamp_risk(df, "2024-02-01", market_tz="Asia/Seoul").first()
    assert (utc.date, seoul.date, seoul.predict_date) == ("2024-01-01", "2024-01-02", "2024-01-02")
    assert (utc.test_date, utc.risk_score, utc.model_name, utc.analysis_result) == ("2024-02-01", 12.5, "Binseg", "Completed")
    assert "symbol" not in utc.asDict()


def test_normalize_columns_upper(spark):
    df = spark.createDataFrame([(1, 2)], "`Stock Splits` int, close int")
    assert cleaning.normalize_columns(df, "upper").columns == ["STOCK_SPLITS", "CLOSE"]


def test_between_dates_open_bounds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 6)], "ts timestamp_ntz")
    assert filters.between_dates(df).count() == 5
    assert filters.between_dates(df, start="2024-01-04").count() == 2
    assert filters.between_dates(df, end="2024-01-04").count() == 4


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 1, 1), 1.0)], "ts timestamp_ntz, x double").write.parquet(path)
    plan = filters.between_dates(spark.read.parquet(path), "2024-01-01").select("x")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_page_text(spark):
    html = (
        "<html><head><title> A &amp; B </title><script>x('<p>')</script></head><body><nav><li><a>Home</a></nav>"
        "<article><h1>Head</h1><p>One&nbsp;two  three<br>four</p><!-- no --><style>p{}</style></article></body></html>"
    )
    assert one(spark, html, "string", fn.page_title) == "A & B"
    assert one(spark, html, "string", fn.article_text) == "Head\nOne two three\nfour"


def test_main_text_leaves_out_what_is_around(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    menu = "".join(f"<li><a href='/{i}'>menu item {i}</a></li>" for i in range(5))
    html = (
        f"<html><head><title>t</title></head><body><ul>{menu}</ul><div>Advertisement</div><h1>A headline</h1><p>{words}.</p><p>Short line.</p>"
        f"<p>{words} &amp; <a href='#'>a link</a> more</p><div><a href='/x'><span>Read</span> <div>also this</div> and that</a></div>"
        f"<ul>{menu}</ul><footer>All rights</footer></body></html>"
    )
    found = one(spark, html, "string", fn.main_text).split("\n")
    assert found == ["A headline", f"{words}.", "Short line.", f"{words} & a link more"]
    for odd in ("", "<body></body>", "<a>", "no markup", "<ul>" + menu + "</ul>", "&#1;&#x2;<p>\x01\x02\x03</p>"):
        assert one(spark, odd, "string", fn.main_text) == ""
    assert one(spark, f"<p>{words}<a name=here>{words}<p>{words}", "string", fn.main_text) == f"{words}"
    assert one(spark, "<p>" + "日本語の文章" * 40 + "</p>", "string", fn.main_text) == "日本語の文章" * 40
    assert one(spark, None, "string", fn.main_text) is None
