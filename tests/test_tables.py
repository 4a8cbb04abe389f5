"""Stored tables: what lies in folders comes back as it went in."""

import os
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, tables

DAYS = "symbol string, ts timestamp_ntz, close double"


def days(spark, *rows):
    return spark.createDataFrame([(s, datetime(2024, m, d), float(c)) for s, m, d, c in rows], DAYS)


def content(spark, path):
    return sorted(((r.symbol, r.ts.month, r.ts.day, r.close) for r in tables.read_stored(spark, path).collect()), key=repr)


def test_symbols_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_prices(days(spark, ("005930", 1, 2, 1), ("000660", 2, 3, 2), (None, 2, 3, 3)), path)
    assert content(spark, path) == [("000660", 2, 3, 2.0), ("005930", 1, 2, 1.0), (None, 2, 3, 3.0)]
    assert tables.read_prices_range(spark, path, "2024-02-01", "2024-02-28").where("symbol = '000660'").count() == 1
    with pytest.raises(ValueError):
        tables.append_prices(days(spark, ("a", 1, 2, 1)), path, by=[])
    with pytest.raises(ValueError):
        tables.append_prices(days(spark, ("a", 1, 2, 1)).withColumn("symbol", F.lit(1)), path)
    tables.append_prices(days(spark, ("a", 1, 9, 1)).withColumn("note", F.lit("x")), path)
    assert tables.read_stored(spark, path).where("note = 'x'").count() == 1 and len(content(spark, path)) == 4


def test_tables_of_other_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    days(spark, ("005930", 1, 2, 1)).withColumn("day", F.to_date("ts")).write.partitionBy("symbol", "day").parquet(path)
    assert tables.read_stored(spark, path, {"day": "date"}).dtypes == [
        ("ts", "timestamp_ntz"), ("close", "double"), ("symbol", "string"), ("day", "date")
    ]
    assert tables.read_stored(spark, path).first()["symbol"] == "005930"


def test_retention_in_folders_of_symbol_and_month(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(s, m, d, m) for s in ("005930", "b/c") for m in (1, 2, 3) for d in (5, 25)]
    tables.append_prices(days(spark, *rows, ("gone", 2, 1, 0)), path)
    untouched = {p: os.path.getmtime(p) for p in Path(path).rglob("month=2024-03-01/*.parquet")}
    tables.drop_old_days(spark, path, 10, "2024-02-20")
    assert content(spark, path) == sorted(((s, m, d, float(m)) for s, m, d, _ in rows if (m, d) >= (2, 10)), key=repr)
    assert untouched == {p: os.path.getmtime(p) for p in Path(path).rglob("month=2024-03-01/*.parquet")}
    assert not list(Path(path).glob("symbol=gone/month=*"))
    tables.drop_old_days(spark, path, 0, "2024-03-25")
    assert [r[1:3] for r in content(spark, path)] == [(3, 25), (3, 25)]
    tables.drop_old_days(spark, path, 0, "2025-01-01")
    assert content(spark, path) == []


def test_null_folders_keep_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = [(1, None, 1.0), (2, None, 2.0), (3, "005930", 3.0), (4, "x", 4.0)]
    spark.createDataFrame(stored, "id int, code string, v double").write.partitionBy("code").parquet(path)
    batch = spark.createDataFrame([(9, None, 9.0), (3, "005930", 30.0)], "id int, code string, v double")
    tables.upsert_table(batch, path, ["id", "code"], ["v"], ["v"], ["code"])
    found = sorted(map(tuple, tables.read_stored(spark, path).select("id", "code", "v").collect()))
    assert found == [(1, None, 1.0), (2, None, 2.0), (3, "005930", 30.0), (4, "x", 4.0), (9, None, 9.0)]


def test_changes_write_the_folders_they_hit(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_prices(days(spark, ("a", 1, 2, 1), ("a", 2, 2, 2), (None, 1, 2, 3), ("b", 1, 2, 4)), path)
    names = lambda: {p: os.path.getmtime(p) for p in Path(path).rglob("*.parquet")}
    before = names()
    tables.update_table(spark, path, {"close": F.col("close") + 10}, "close = 3")
    assert len(set(before.items()) - set(names().items())) == 1
    tables.delete_rows(spark, path, "close IN (2, 13)")
    assert content(spark, path) == [("a", 1, 2, 1.0), ("b", 1, 2, 4.0)]
    tables.delete_rows(spark, path, "close > 100")
    with pytest.raises(ValueError):
        tables.update_table(spark, path, {"symbol": "x"}, "true")
    new = days(spark, ("a", 1, 2, 7), ("b", 1, 2, 4), ("c", 1, 2, 9)).withColumn("month", F.trunc("ts", "MM"))
    tables.reconcile_table(new, path, cols=["close"])
    assert content(spark, path) == [("a", 1, 2, 7.0), ("b", 1, 2, 4.0)]


def test_a_series_is_added_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(days(spark, ("a", 1, 2, 1)), path)
    batch = days(spark, ("a", 1, 2, 5), ("a", 1, 3, 5), ("b", 1, 2, 5), ("c", 1, 2, 5), ("c", 1, 2, 6), (None, 1, 2, 5))
    refused = sorted(map(tuple, tables.insert_groups(batch, path, ["symbol", "ts"]).collect()))
    assert refused == [("a", 2, "stored already"), ("c", 2, "repeated key")]
    assert content(spark, path) == [("a", 1, 2, 1.0), ("b", 1, 2, 5.0), (None, 1, 2, 5.0)]


def test_header_is_the_first_line(spark, tmp_path):
    for name, text in [
        ("late", "exported\n1,2\ndate,close\n2024-01-02,1\n"),
        ("twice", "close,date\n1,2024-01-02\ndate,close\n2,2024-01-03\n"),
        ("wide", ",".join(f"c{i}" for i in range(70)) + ",date,close\n" + ",".join(["x"] * 70) + ",2024-01-05,7\n"),
        ("bom", '﻿"date","close"\n2024-01-06,"8"\n'),
        ("empty", ""),
    ]:
        os.makedirs(tmp_path / name)
        (tmp_path / name / "x.csv").write_text(text, encoding="utf-8")
    rows = sorted((r.symbol, r.ts.day, r.close) for r in files.read_prices(spark, str(tmp_path)).collect())
    assert rows == [("bom", 6, 8.0), ("twice", 2, 1.0), ("twice", 3, 2.0), ("wide", 5, 7.0)]


def test_of_repeated_ids_the_last_entry_stays(spark, tmp_path):
    entries = spark.createDataFrame(
        [("1", 1, ("a",)), ("1", 2, ("b",)), ("2", 1, ("c",)), (None, 1, ("d",))], "id string, seq int, entry struct<title: string>"
    )
    files.write_keyed_documents(entries, str(tmp_path / "d"), order=["seq"])
    back = files.read_keyed_documents(spark, str(tmp_path / "d"), "STRUCT<title: STRING>")
    assert sorted((r.id, r.entry.title) for r in back.collect()) == [("1", "b"), ("2", "c")]


def test_readme_example(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("005930", start.replace(day=1 + i), 1.0, 2.0, 0.5, float(1 + i % 7), 10 + i % 5) for i in range(30)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume int")
    files.write_price_files(bars, str(tmp_path / "KOR"))
    text = (Path(__file__).resolve().parents[1] / "README.md").read_text()
    code = re.search(r"```python\n(.*?)```", text, re.S).group(1)
    exec(code.replace("spark = build_session()", "").replace("data/stocks/KOR", str(tmp_path / "KOR")), {"spark": spark})


def test_few_tasks_write_to_a_folder(spark, tmp_path):
    """Rows of every folder lie in all tasks; one folder has no name."""
    rows = spark.range(400, numPartitions=8).select("id", F.when(F.col("id") % 20 < 19, F.format_string("%06d", F.col("id") % 20)).alias("code"))
    tables.write_folders(rows, str(tmp_path / "t"), ["code"])
    folders = [d for d in (tmp_path / "t").iterdir() if d.is_dir()]
    assert len(folders) == 20 and all(len(list(d.glob("*.parquet"))) == 1 for d in folders)
    back = tables.read_stored(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.select("id", "code").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
