import json
import os
from datetime import datetime

import pytest

from tidemark.schemas import CONTENT_ENTRY
from tidemark.sources import feeds, files, pages, tables, universe


def test_read_price_folders(spark, tmp_path):
    for folder, name, text in [
        ("005930", "2024-01-01_chunk0.csv", "date,open,high,low,close,volume\n2024-01-02 00:00:00+09:00,1,2,0.5,1.5,10\nbad,1,1,1,1,1\n"),
        ("005930", "2024-02-01_chunk0.csv", "date,open,high,low,close,volume\n2024-02-01,1,2,0.5,,-3\n"),
        ("^DJI", "2024-01-01_chunk0.csv", "date,open,high,low,close,volume\n2024-01-03,1,2,0.5,2.5,\n"),
        ("^DJI", "other.csv", "open,close\n1,2\n"),
        ("A+B", "2024-01-01_chunk0.csv", "date,open,high,low,close,volume\n2024-01-03,1,2,0.5,2.5,7\n"),
    ]:
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    rows = sorted((r.symbol, r.ts, r.close, r.volume) for r in files.read_prices(spark, str(tmp_path)).collect())
    assert rows == [
        ("005930", datetime(2024, 1, 1, 15), 1.5, 10.0),
        ("005930", datetime(2024, 2, 1), None, -3.0),
        ("A+B", datetime(2024, 1, 3), 2.5, 7.0),
        ("^DJI", datetime(2024, 1, 3), 2.5, None),
    ]


def test_month_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [("a", datetime(2024, m, d), float(m)) for m in (1, 2, 3) for d in range(1, 21)], "symbol string, ts timestamp_ntz, close double"
    )
    tables.append_prices(df, path, rows_per_file=7)
    names = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(names) == 9
    part = tables.read_prices_range(spark, path, "2024-01-15", "2024-02-03")
    assert part.count() == 9
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_us_feed(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 9), 1.0, 0.0, 1), ("a", datetime(2024, 1, 1, 9), 2.0, 0.0, 2)],
        "symbol string, Date timestamp_ntz, Close double, `Stock Splits` double, seq int",
    )
    (row,) = feeds.normalize("us_prices", df, zone="America/New_York").collect()
    assert row.asDict() == {"symbol": "a", "ts": datetime(2024, 1, 1, 14), "close": 2.0, "stock_splits": 0.0, "seq": 2}


def test_kr_feed(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 2), 1.0)], "symbol string, Date timestamp_ntz, Close double")
    assert feeds.normalize("kr_prices", df).first().ts == datetime(2024, 1, 1, 15)


def test_unknown_feed(spark):
    with pytest.raises(ValueError):
        feeds.normalize("nope", None)
    assert list(feeds.known_feeds()) == ["json_prices", "kr_prices", "news", "us_prices"]


def test_json_prices(spark):
    payloads = [
        ("a", 1, json.dumps({"values": [{"datetime": "2024-01-02", "close": "x", "volume": "5"}, {"datetime": "2024-01-02", "close": "2.5", "volume": "6"}, {"datetime": "2024-01-03", "open": "1"}]})),
        ("b", 1, json.dumps({"code": 400})),
        ("c", 1, "no json"),
    ]
    df = spark.createDataFrame(payloads, "symbol string, seq int, payload string")
    rows = sorted((r.symbol, r.ts.day, r.open, r.close, r.volume) for r in feeds.normalize("json_prices", df).collect())
    assert rows == [("a", 2, None, 2.5, 6.0), ("a", 3, 1.0, None, None)]


def news_payload(*items):
    return json.dumps({"items": [dict(zip(("title", "originallink", "link", "description", "pubDate"), i)) for i in items]})


def test_news_drops_bad_dates_after_keeping_the_last_copy(spark):
    good = "Mon, 26 Sep 2016 07:50:00 +0900"
    payload = news_payload(("t1", "u1", "l", "d", good), ("t2", "u1", "l", "d", "soon"), ("t3", "u2", "l", "d", "soon"), ("t4", "u2", "l", "d", good))
    df = spark.createDataFrame([(1, payload), (2, json.dumps({"items": []}))], "seq int, payload string")
    assert [(r.originallink, r.title) for r in feeds.normalize("news", df, keys=[]).collect()] == [("u2", "t4")]


def test_news_without_original_link_and_of_two_companies(spark):
    good = "Mon, 26 Sep 2016 07:50:00 +0900"
    payload = news_payload(("t1", "", "l1", "d", good), ("t2", "", "l2", "d", good), ("t3", "", "l1", "d", good))
    df = spark.createDataFrame([("a", 1, payload), ("b", 2, payload)], "company string, seq int, payload string")
    found = sorted((r.company, r.link, r.title) for r in feeds.normalize("news", df).collect())
    assert found == [("a", "l1", "t3"), ("a", "l2", "t2"), ("b", "l1", "t3"), ("b", "l2", "t2")]


def test_columns_are_found_by_name(spark, tmp_path):
    for folder, text in [
        ("a", "date,close,open,high,low,volume\n2024-01-02,10,1,2,0.5,7\n"),
        ("b", "Date,note,open,high,low,close,volume\n2024-01-03,x,1,2,0.5,2.5,8\n"),
        ("c", "open,high,low,close,volume\n1500,2,1,1,1\n71000,2,1,1,1\n"),
        ("d", "date,close\n1500,1\n71000,2\n2024-01-04,3\n"),
    ]:
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "x.csv").write_text(text)
    rows = sorted((r.symbol, r.ts.day, r.open, r.close, r.volume) for r in files.read_prices(spark, str(tmp_path)).collect())
    assert rows == [("a", 2, 1.0, 10.0, 7.0), ("b", 3, 1.0, 2.5, 8.0), ("d", 4, None, 3.0, None)]


def test_old_days_go_with_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", datetime(2024, m, d), float(m)) for m in (1, 2, 3) for d in (5, 25)], "symbol string, ts timestamp_ntz, close double")
    tables.append_prices(df, path, by=[])
    tables.drop_old_days(spark, path, 10, "2024-02-20")
    kept = sorted((r.ts.month, r.ts.day) for r in spark.read.parquet(path).collect())
    assert kept == [(2, 25), (3, 5), (3, 25)]
    assert sorted(x for x in os.listdir(path) if "=" in x) == ["month=2024-02-01", "month=2024-03-01"]
    tables.drop_old_days(spark, path, 0, "2024-02-28")
    assert sorted(x for x in os.listdir(path) if "=" in x) == ["month=2024-03-01"]


def test_keyed_json(spark, tmp_path):
    doc = {"10": {"title": "x", "content": ""}, "2": {"title": "y", "content": "ü", "error": None}}
    (tmp_path / "contents.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2))
    entries = files.read_keyed_documents(spark, str(tmp_path / "contents.json"), CONTENT_ENTRY)
    files.write_keyed_json(entries, str(tmp_path / "lines"))
    back = files.read_keyed_json(spark, str(tmp_path / "lines"), CONTENT_ENTRY)
    assert sorted((r.id, r.entry.title, r.entry.content) for r in back.collect()) == [("10", "x", ""), ("2", "y", "ü")]
    lines = [line for p in sorted((tmp_path / "lines").glob("part-*")) for line in p.read_text().splitlines()]
    assert [json.loads(line)["id"] for line in lines] == ["2", "10"]


def test_universe(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    config = {
        "data_pipelines": {
            "interval": "1d",
            "end_date": "TODAY",
            "stocks_file": "stocks.yaml",
            "stocks": [{"symbol": "old"}],
        }
    }
    stocks = {"stocks": [{"symbol": "005930", "query": "sam", "interval": "1h"}, {"symbol": "073240", "end_date": "2020-01-01"}, {"full_name": "nobody"}]}
    (tmp_path / "main.yaml").write_text(yaml.safe_dump(config))
    (tmp_path / "stocks.yaml").write_text(yaml.safe_dump(stocks))
    section = universe.read_universe_config(str(tmp_path / "main.yaml"))
    rows = sorted((r.symbol, r.search, r.interval, r.end_date, r.period) for r in universe.load_universe(spark, section, "2024-02-01").collect())
    assert rows == [("005930", "sam", "1h", "2024-02-01", None), ("073240", "073240", "1d", "2020-01-01", None)]
    with pytest.raises(ValueError):
        universe.load_universe(spark, {}, "2024-02-01")


def test_pages(spark):
    anchors = "".join(f"<li><a href='#'> item <b>{i}</b> </a></li>" for i in range(12))
    df = spark.createDataFrame([("u", f"<title>T</title><nav><ul>{anchors}</ul></nav><article>text</article>"), ("v", None), ("w", "<body><nav>x</nav></body>")], "url string, html string")
    top = [(r["rank"], r.headline) for r in pages.top_headlines(df).where("url = 'u'").collect()]
    assert top == [(i, f"item {i}") for i in range(10)]
    out = {r.url: r for r in pages.extract_articles(df).collect()}
    assert (out["u"].title, out["u"].content, out["u"].error) == ("T", "text", None)
    assert out["v"].content is None and out["w"].error == "no article text"


def test_risk_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("2024-01-01", 1.5, "Binseg", "Completed", "2024-02-01", "2024-01-01", 1.5, "KOR", "005930")],
        "date string, risk_value double, model_name string, analysis_result string, test_date string, predict_date string, risk_score double, country string, symbol string",
    )
    files.write_risk(df, str(tmp_path / "r"))
    assert files.read_risk(spark, str(tmp_path / "r")).collect() == df.collect()


def test_risk_folders_are_dealt_to_tasks(spark, tmp_path, monkeypatch, rows):
    """Small folders aren't all written by one task, and a large one isn't either; none is written by more than it needs."""
    monkeypatch.setattr(files, "ROWS_PER_FILE", 50)
    data = [(f"d{i}", float(i), "m", "Completed", "t", "p", 1.5, "USA", f"s{i % 40}") for i in range(80)]
    data += [(f"d{i}", float(i), "m", "Completed", "t", "p", 1.5, "KOR", None) for i in range(400)]
    names = "date string, risk_value double, model_name string, analysis_result string, test_date string, predict_date string, risk_score double, country string, symbol string"
    df = spark.createDataFrame(data, names)
    files.write_risk(df, str(tmp_path / "r"))
    assert rows(files.read_risk(spark, str(tmp_path / "r"))) == rows(df)
    small = list((tmp_path / "r" / "country=USA").glob("symbol=*/part-*"))
    assert len(small) == 40 and len({f.name.split("-")[1] for f in small}) > 2
    assert len(list((tmp_path / "r" / "country=KOR").glob("symbol=*/part-*"))) > 2
