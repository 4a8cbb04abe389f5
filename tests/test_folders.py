"""Folders that tasks write themselves, beside those of Spark's writer."""

import os
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, folders, tables

ODD = "code STRING, n INT, day DATE, t TIMESTAMP, u TIMESTAMP_NTZ, x DOUBLE, d DECIMAL(12,3), a ARRAY<STRING>, m MAP<STRING, INT>, s STRUCT<p: BINARY>"
_T = datetime(2024, 1, 2, 3, 4, 5, 6)
ODD_ROWS = [
    ("a/b=c%d", 1, date(2024, 1, 2), _T, _T, 1e-9, Decimal("1.5"), ["x", None], {"k": 1}, (b"1",)),
    ("a/b=c%d", 2, None, None, None, float("nan"), None, None, None, None),
    ("000042", 3, date(1200, 1, 2), datetime(1500, 1, 1), datetime(1500, 1, 1), -0.0, Decimal("-2"), [], {}, (None,)),
    (None, 4, date(2024, 1, 2), _T, _T, 1e300, None, ["y"], {"k": None}, (b"",)),
    ("", 5, date(2024, 1, 2), _T, _T, 1.0, None, ["y"], {"k": None}, (b"",)),
    ("{x}'", 6, date(2024, 1, 2), _T, _T, 1.0, None, ["y"], {"k": None}, (b"",)),
]


def started():
    """Processes and threads that the machine has started."""
    return int(next(x for x in Path("/proc/stat").read_text().splitlines() if x.startswith("processes")).split()[1])


def names(path):
    """The folders of a table that hold files."""
    return sorted(str(Path(d).relative_to(path)) for d, _, found in os.walk(path) if any(x.startswith("part-") for x in found))


def test_names_of_folders(spark):
    """As Spark's writer gives them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for c in [*map(chr, range(1, 300)), "a=b/c", "005930", "%41"]:
        assert folders.escaped(c) == escape(c), repr(c)


@pytest.mark.parametrize("by", [["code"], ["code", "day"], ["t"]])
def test_rows_and_folders_of_parquet(spark, tmp_path, rows, by):
    df = spark.createDataFrame(ODD_ROWS, ODD)
    df.write.partitionBy(*by).parquet(str(tmp_path / "spark"))
    tables.write_folders(df, str(tmp_path / "own"), by)
    assert names(tmp_path / "own") == names(tmp_path / "spark")
    one, other = (spark.read.parquet(str(tmp_path / x)) for x in ("own", "spark"))
    assert one.schema == other.schema and repr(rows(one)) == repr(rows(other))
    assert sorted(os.listdir(tmp_path / "own"))[0] == "_SUCCESS"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_folders(df, str(tmp_path / "own"), by)
    assert repr(rows(spark.read.parquet(str(tmp_path / "own")))) == repr(rows(one))


def test_only_folders_with_rows_are_replaced(spark, tmp_path, rows):
    """One of them is written by several tasks; the rows come from the table itself."""
    path = str(tmp_path / "t")
    tables.write_folders(spark.range(3000).selectExpr("id AS n", "CASE WHEN id < 2000 THEN 'hot' ELSE 'c' || id % 7 END AS code"), path, ["code"])
    table = tables.read_stored(spark, path)
    changed = table.where("code IN ('hot', 'c3')").withColumn("n", -F.col("n")).repartition(4)
    want = rows(changed.unionByName(table.where("code NOT IN ('hot', 'c3')")))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        place = folders.local_place(changed, path, ["code"])
        staged = folders.Place(f"{path}/.staged", place.encoding)
        os.makedirs(staged.raw())
        written = folders._write(changed.select("n", *folders._keys(["code"])), staged, ["code"], folders._parquet_file(changed, ["n"]))
        assert written.where("folder = 'code=hot'").count() == 4
        folders._put(written, staged, place, True)
        folders._put(written, staged, place, True)  # tasks that run again change nothing
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert rows(tables.read_stored(spark, path)) == want
    tables.overwrite_partitions(tables.read_stored(spark, path).where("code = 'hot'").limit(0), path, ["code"])
    assert rows(tables.read_stored(spark, path)) == want


def test_rows_of_text_files(spark, tmp_path):
    """Character for character those of Spark's writer."""
    some = [("a", "x", 1e-9, None, _T, 'q"uo,te'), ("a", "x", 1e10, "", _T, " blank "), (None, "y/z", 0.1, "line\nend", None, "#"), ("", "", None, "\\", _T, "é")]
    df = spark.createDataFrame(some, "country STRING, symbol STRING, `a b` DOUBLE, t STRING, `c,d` TIMESTAMP, e STRING").coalesce(1)
    df.write.partitionBy("country", "symbol").option("header", True).csv(str(tmp_path / "spark"))
    assert folders.write_csv(df, str(tmp_path / "own"), ["country", "symbol"])
    assert names(tmp_path / "own") == names(tmp_path / "spark")
    for name in names(tmp_path / "own"):
        one, other = (sorted(next((tmp_path / x / name).glob("part-*.csv")).read_bytes().split(b"\n")) for x in ("own", "spark"))
        assert one == other


def test_folders_start_no_process(spark, tmp_path):
    """Hadoop starts six for each folder with a file."""
    df = spark.range(800).selectExpr("id AS n", "'c' || id AS symbol", "'USA' AS country").coalesce(1)
    tables.write_folders(df, str(tmp_path / "warm"), ["symbol"])
    for write in (lambda p: tables.write_folders(df, p, ["symbol"]), lambda p: files.write_risk(df, p)):
        path, before = str(tmp_path / f"t{id(write)}"), started()
        write(path)
        assert started() - before < 1600
        assert len(names(path)) == 800


def test_a_table_is_looked_through_once(spark, tmp_path):
    """Reading a table without layout lists its folders in one job."""
    path = str(tmp_path / "t")
    tables.write_folders(spark.range(100).selectExpr("id AS n", "lpad(id, 6, '0') AS code"), path, ["code"])
    spark.sparkContext.setJobGroup("reads", "reads")
    try:
        back = tables.read_stored(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert back.dtypes == [("n", "bigint"), ("code", "string")] and back.where("code = '000042'").first()["n"] == 42
    jobs = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("reads")]
    tasks = [sum(spark.sparkContext.statusTracker().getStageInfo(s).numTasks for s in j.stageIds) for j in jobs]
    assert len([n for n in tasks if n >= 100]) == 1


def test_values_of_folders(spark, tmp_path, rows):
    """As Spark finds them, and without its look at all folders, which took time that grows with the square of their number."""
    some = [("a/b=c%d", "x+y z"), ("USA", None), (None, "005930"), ("é%41", "symbol=1"), ("{x}", "a:b#?")]
    df = spark.createDataFrame([(f"d{i}", *x) for i, x in enumerate(some)], "date STRING, country STRING, symbol STRING")
    files.write_risk(df, str(tmp_path / "r"))
    back = files.read_risk(spark, str(tmp_path / "r"))
    plain = spark.read.schema(back.schema).option("header", True).csv(str(tmp_path / "r"))
    assert back.columns[-2:] == ["country", "symbol"] and rows(back) == rows(plain)
    assert back.where("symbol = '005930'").select("date", "country").collect() == [("d2", None)]
    plan = back._jdf.queryExecution().analyzed().toString()
    assert "_metadata" in plan and len(back._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().partitionSchema().fieldNames()) == 0


@pytest.mark.parametrize("few", [0, 1000])
def test_tables_of_many_folders(spark, tmp_path, rows, monkeypatch, few):
    """Changed and read without Spark's search for the values of folders, with the same rows."""
    df = spark.createDataFrame([(i, None if i % 7 == 0 else f"{i % 5:03d}/=%", date(2024, 1 + i % 3, 1), i) for i in range(60)], "id INT, code STRING, day DATE, v INT")
    batch = df.where("id % 2 = 0").withColumn("v", -F.col("v")).unionByName(df.where("id = 1").withColumn("id", F.lit(99)))
    found = []
    for many in (10_000, 0):
        monkeypatch.setattr(folders, "MANY", many)
        monkeypatch.setattr(tables, "FEW_NAMES", few)
        path = str(tmp_path / f"t{many}")
        tables.write_folders(df, path, ["code", "day"])
        tables.upsert_table(batch, path, ["id", "code", "day"], ["v"], ["v"], ["code", "day"])
        one = tables.read_stored(spark, path, {"day": "date"})
        laid = str(tmp_path / f"l{many}")
        tables.append_rows(df, laid, ["code", "day"])
        tables.update_table(spark, laid, {"v": -1}, "id IN (3, 7)")
        tables.delete_rows(spark, laid, "code = '002/=%' OR (code IS NULL AND id < 30)")
        other = tables.read_stored(spark, laid)
        found.append((one.dtypes, rows(one), other.dtypes, rows(other), rows(other.where("day = '2024-02-01'"))))
        searched = one._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().partitionSchema().fieldNames()
        assert len(searched) == (0 if many == 0 else 2)
    assert found[0] == found[1] and len(found[0][1]) == 66  # keys with a null are never equal
