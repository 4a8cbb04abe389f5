from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, filters, joins, perseries, quality
from tidemark.schemas import TABLES, Field, Table
from tidemark.sources import tables

BAR = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume bigint"


def bar(symbol, day, close, volume=1, open_=1.0):
    return (symbol, datetime(2024, 1, day), open_, 9.0, 0.5, close, volume)


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([bar("a", 1, 1.0), bar("a", 2, 2.0), bar("b", 5, 5.0)], BAR)


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame(
        [bar("a", 1, 1.00005), bar("a", 2, 2.5, 99), bar("a", 3, 3.0), bar("b", 4, 4.0), bar("b", 6, 6.0), bar("c", 1, 1.0)], BAR
    )


def keys(df):
    return sorted((r.symbol, r.ts.day) for r in df.collect())


def test_only_newer_rows_are_added(incoming, stored):
    assert keys(filters.only_newer(incoming, stored)) == [("a", 3), ("b", 6), ("c", 1)]
    state = changes.append_new(incoming, stored)
    assert keys(state) == [("a", 1), ("a", 2), ("a", 3), ("b", 5), ("b", 6), ("c", 1)]
    assert keys(changes.append_new(incoming, state)) == keys(state)


def test_reconcile_takes_prices_beyond_the_tolerance(incoming, stored):
    (change,) = changes.reconcile_changes(incoming, stored).collect()
    assert (change.symbol, change.ts.day, change.close_old, change.close_new) == ("a", 2, 2.0, 2.5)
    state = {(r.symbol, r.ts.day): r for r in changes.reconcile(incoming, stored).collect()}
    assert set(state) == {("a", 1), ("a", 2), ("b", 5)}
    assert state["a", 2].close == 2.5 and state["a", 2].volume == 1 and state["a", 1].close == 1.0


def test_reconcile_counts_missing_values_as_changes(spark, stored):
    new = spark.createDataFrame([("a", datetime(2024, 1, 1), None, 9.0, 0.5, 1.0, 1), bar("a", 2, float("nan"))], BAR)
    assert keys(changes.reconcile_changes(new, stored)) == [("a", 1), ("a", 2)]


def test_append_and_reconcile_in_any_order(incoming, stored, rows):
    one = changes.append_new(incoming, changes.reconcile(incoming, stored))
    other = changes.reconcile(incoming, changes.append_new(incoming, stored))
    assert rows(one) == rows(other)


RISK = "company_code string, model_name string, analysis_result string, test_date string, predict_date string, risk_score double, seq int"


def risk_row(code, score, seq=0, day="2024-01-01"):
    return (code, "Binseg", "Completed", "2024-02-01", day, score, seq)


def test_upsert(spark, rows):
    target = spark.createDataFrame([risk_row("a", 1.0), risk_row("b", 2.0)], RISK).drop("seq")
    new = spark.createDataFrame([risk_row("a", 5.0, 1), risk_row("a", 6.0, 2), risk_row("c", 7.0, 3)], RISK)
    once = changes.upsert(target, new, order=["seq"])
    assert {r.company_code: r.risk_score for r in once.collect()} == {"a": 6.0, "b": 2.0, "c": 7.0}
    assert rows(changes.upsert(once, new, order=["seq"])) == rows(once)
    assert rows(changes.upsert(target, new.drop("risk_score"), order=["seq"])) == rows(target)


def test_upsert_takes_a_null_update(spark):
    target = spark.createDataFrame([risk_row("a", 1.0)], RISK).drop("seq")
    new = spark.createDataFrame([risk_row("a", None, 1)], RISK)
    assert changes.upsert(target, new, order=["seq"]).first().risk_score is None


def test_update_and_delete_leave_rows_with_unknown_condition(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, x int")
    assert rows(changes.update_where(df, {"x": F.col("x") + 1, "id": 0}, "x > 6")) == [(0, 10), (1, 5), (2, None)]
    assert rows(changes.delete_where(df, "x > 6")) == [(1, 5), (2, None)]


def test_companies_are_added_once(spark):
    universe = spark.createDataFrame(
        [("a", "A", "Tech"), ("b", None, None), ("b", "B", "Old")], "symbol string, full_name string, sector string"
    )
    existing = spark.createDataFrame([("a", "Old name", "KOR", "x")], "company_code string, company_name string, country string, sector string")
    out = {r.company_code: r for r in changes.load_companies(universe, existing, "USA").collect()}
    assert len(out) == 2 and out["a"].company_name == "Old name" and out["b"].country == "USA"
    again = changes.load_companies(universe, changes.load_companies(universe, existing, "USA"), "USA")
    assert again.count() == 2


def test_insert_rows(spark, tmp_path, incoming, stored):
    path = str(tmp_path / "t")
    stored.write.parquet(path)
    with pytest.raises(ValueError):
        tables.insert_rows(incoming, path, ["symbol", "ts"], ["close"], strict=True)
    assert spark.read.parquet(path).count() == 3
    tables.insert_rows(incoming, path, ["symbol", "ts"], ["close"])
    tables.insert_rows(incoming, path, ["symbol", "ts"], ["close"])
    assert spark.read.parquet(path).count() == 7


def test_orphans_and_cascade(spark, rows):
    parent = spark.createDataFrame([(1, "x"), (2, "y")], "id int, kind string")
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "id int, v string")
    assert rows(joins.orphans(child, parent, "id")) == [(3, "c")]
    kept, kept_children = joins.cascade_delete(parent, [child], "id", "kind = 'x'")
    assert rows(kept) == [(2, "y")]
    assert rows(kept_children) == [(2, "b"), (3, "c"), (None, "d")]


def test_pair_on_key(spark):
    a = spark.createDataFrame([(1, 2, 3)], "k int, x int, only int")
    b = spark.createDataFrame([(1, 5)], "k int, x int")
    assert joins.pair_on_key(a, b, ["k"]).columns == ["k", "x_new", "only", "x_old"]


def test_contract(spark):
    table = Table((Field("id", "bigint"), Field("name", "string", 3), Field("note", "string", None, True)), ("id",), {})
    df = spark.createDataFrame([(1, "abcd"), (1, None), (-2, "x")], "id bigint, name string")
    out = {(r.rule, r.column): r.violations for r in quality.check_contract(df, table).collect() if r.violations}
    assert out == {
        ("missing_column", "note"): 1,
        ("null", "name"): 1,
        ("too_long", "name"): 1,
        ("negative", "id"): 1,
        ("repeated_key", "id"): 1,
    }
    empty = {(r.rule, r.column): r.violations for r in quality.check_contract(df.limit(0), table).collect() if r.violations}
    assert empty == {("missing_column", "note"): 1}
    assert quality.missing_columns(df, TABLES["risk"])[0] == "company_code"


def test_per_series_function_isolates_failures(spark):
    import pandas as pd
    from pyspark.sql import types as T

    df = spark.createDataFrame([(s, datetime(2024, 1, d), float(d)) for s in "abc" for d in (3, 1, 2)], "symbol string, ts timestamp_ntz, close double")

    def fn(pdf):
        if pdf["symbol"].iloc[0] == "a":
            raise ValueError("broken")
        if pdf["symbol"].iloc[0] == "b":
            return None
        return pd.DataFrame({"first": [pdf["close"].iloc[0]]})

    schema = T.StructType([T.StructField("first", T.DoubleType())])
    out = {(r.symbol, r.chunk): (r["first"], r.error) for r in perseries.apply_per_series(df, fn, schema, chunk_rows=2).collect()}
    assert out == {("a", 0): (None, "ValueError: broken"), ("a", 1): (None, "ValueError: broken"), ("c", 0): (1.0, None), ("c", 1): (3.0, None)}
