import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, dedup, joins, matrix, sets
from tidemark.operators import series as ops


@pytest.fixture(scope="module")
def hot(spark):
    """One series with two thirds of all rows, over several days; others are short."""
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(minutes=7 * i), rng.uniform(1, 9), rng.randint(0, 5)) for i in range(700)]
    rows += [(f"s{k}", start + timedelta(hours=i), rng.uniform(1, 9), rng.randint(0, 5)) for k in range(7) for i in range(50)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double, volume bigint").cache()


def test_long_series_is_split_and_short_ones_are_not(hot):
    parts = ops.split_long_series(hot, ["symbol"], "ts", max_rows=100)
    counts = {r["symbol"]: r["n"] for r in parts.groupBy("symbol").agg(F.countDistinct("_part").alias("n")).collect()}
    assert counts["hot"] > 100 and all(n == 1 for s, n in counts.items() if s != "hot")
    assert parts.count() == hot.count()


def test_parts_of_a_long_series_are_small(hot):
    parts = ops.split_long_series(hot, ["symbol"], "ts", max_rows=100).where("symbol = 'hot'")
    assert parts.groupBy("_part").count().agg({"count": "max"}).first()[0] <= 6


def test_outliers_and_busy_days_are_cut_by_rows(spark):
    busy = [("busy", datetime(2024, 1, 1) + timedelta(days=i), 1.0, 1) for i in range(300)]
    busy += [("busy", datetime(2024, 3, 1, 0, 0) + timedelta(seconds=i), 1.0, 1) for i in range(1, 700)]
    odd = [("odd", datetime(1970, 1, 1), 1.0, 1)] + [("odd", datetime(2024, 1, 1) + timedelta(minutes=i), 2.0, 1) for i in range(999)]
    df = spark.createDataFrame(busy + odd, "symbol string, ts timestamp_ntz, close double, volume bigint")
    parts = ops.split_long_series(df, ["symbol"], "ts", max_rows=100)
    assert parts.groupBy("symbol", "_part").count().agg({"count": "max"}).first()[0] <= 20
    whole = ops.with_position(df, ["symbol"], "ts").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, ops.with_position(df, ["symbol"], "ts", max_rows=100).collect()))


@pytest.mark.parametrize("max_rows", [10, 100, 400])
def test_long_groups_meet_the_same_values(hot, rows, max_rows):
    assert rows(aggregates.minmax(hot, "close", max_rows=max_rows)) == rows(aggregates.minmax(hot, "close"))


@pytest.mark.parametrize("max_rows", [10, 100, 400])
def test_split_series_give_the_same_results(hot, rows, max_rows):
    whole = rows(ops.relative_change(hot))
    assert rows(ops.relative_change(hot, max_rows=max_rows)) == whole
    assert rows(ops.with_position(hot, ["symbol"], "ts", max_rows=max_rows)) == rows(ops.with_position(hot, ["symbol"], "ts"))


def test_undated_rows_are_spread_too(spark, rows):
    start = datetime(2024, 1, 1)
    data = [("a", start + timedelta(hours=i) if i < 20 else None, f"u{i}") for i in range(200)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp_ntz, link string")
    split = ops.with_position(df, ["symbol"], "ts", ["ts", "link"], max_rows=10)
    assert rows(split) == rows(ops.with_position(df, ["symbol"], "ts", ["ts", "link"]))
    assert sorted(r.pos for r in split.collect()) == list(range(200))
    assert {r.pos for r in split.where("ts IS NOT NULL").collect()} == set(range(20))
    largest = ops.split_long_series(df, ["symbol"], "ts", ["ts", "link"], 10).groupBy("_part").count().agg({"count": "max"}).first()[0]
    assert largest <= 5


def test_positions_are_dense(hot):
    placed = ops.with_position(hot, ["symbol"], "ts", max_rows=10)
    for r in placed.groupBy("symbol").agg(F.collect_set("pos").alias("p"), F.count("*").alias("n")).collect():
        assert sorted(r["p"]) == list(range(r["n"]))


def test_relative_change_by_hand(spark, rows):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 2.0, 0), ("a", datetime(2024, 1, 2), 3.0, 4), ("b", datetime(2024, 1, 1), 1.0, 1)],
        "symbol string, ts timestamp_ntz, close double, volume bigint",
    )
    (only,) = ops.relative_change(df).collect()
    assert only.symbol == "a"
    assert only.close_change == pytest.approx(0.5) and only.volume_change == pytest.approx(4e9)


def sequential_ema(values, alpha):
    out = [values[0]]
    for x in values[1:]:
        out.append(alpha * x + (1 - alpha) * out[-1])
    return out


@pytest.mark.parametrize("alpha", [0.05, 0.3, 0.9, 1.0])
def test_ema_matches_the_recurrence(hot, alpha):
    out = ops.ema(ops.with_position(hot, ["symbol"], "ts", max_rows=50), "close", alpha).orderBy("symbol", "pos").collect()
    for symbol in ("hot", "s0", "s6"):
        mine = [r for r in out if r["symbol"] == symbol]
        expected = sequential_ema([r["close"] for r in mine], alpha)
        assert [r["ema"] for r in mine] == pytest.approx(expected, rel=1e-12)


def test_ema_by_hand(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([0.1, 0.9, 0.4, 0.0, 1.0])], "symbol string, pos bigint, x double")
    out = [r.ema for r in ops.ema(df, "x").orderBy("pos").collect()]
    assert out == pytest.approx([0.1, 0.34, 0.358, 0.2506, 0.47542])


def test_ids_are_dense_and_stable(hot):
    keyed = hot.withColumn("k", F.concat_ws("|", "symbol", F.col("ts").cast("string"))).select("k")
    first = {r.k: r.id for r in ops.assign_ids(keyed, ["k"], 10).collect()}
    again = {r.k: r.id for r in ops.assign_ids(keyed.repartition(7), ["k"], 10).collect()}
    assert sorted(first.values()) == list(range(11, 11 + len(first)))
    assert first == again


def test_last_n_keeps_n_rows_per_group_before_the_shuffle(hot):
    out = ops.last_n(hot, 3, ["symbol"], ["ts"])
    assert out.groupBy("symbol").count().where("count <> 3").count() == 0
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_chunks(hot):
    chunks = ops.with_chunk(hot, chunk_rows=100, max_rows=50).groupBy("symbol", "chunk").count().collect()
    assert sorted(r["count"] for r in chunks if r["symbol"] == "hot") == [100] * 7
    assert all(r["chunk"] == 0 for r in chunks if r["symbol"] != "hot")


def test_minmax(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), ("c", 5.0), ("c", 5.0)], "symbol string, x double")
    out = sorted((r.symbol, r.x, r.scaled) for r in aggregates.minmax(df, "x").collect())
    assert out == [("a", 1.0, 0.0), ("a", 2.0, 0.5), ("a", 3.0, 1.0), ("c", 5.0, 0.5), ("c", 5.0, 0.5)]


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def matrix_rows(spark):
    return spark.createDataFrame(
        [
            ("a", day(2, 10), 1.0, 1),
            ("a", day(2, 12), 2.0, 2),
            ("a", day(5), None, 3),
            ("a", day(6), 5.0, 4),
            ("b", day(4), 7.0, 5),
            ("b", day(4), 8.0, 6),
            ("b", day(8), 9.0, 7),
            ("none", day(3), None, 8),
        ],
        "symbol string, ts timestamp_ntz, close double, seq int",
    )


def test_price_matrix_by_hand(spark):
    out = matrix.price_matrix(matrix_rows(spark), ["a", "b"], order=["seq"]).orderBy("day").collect()
    assert [str(r["day"]) for r in out] == [f"2024-01-0{d}" for d in range(2, 9)]
    assert [r["a"] for r in out] == [2, 5, 5, 5, 5, 5, 5]
    assert [r["b"] for r in out] == [7, 7, 7, 9, 9, 9, 9]


def test_price_matrix_agrees_with_pandas(spark):
    import pandas as pd

    pdf = matrix_rows(spark).toPandas()
    parts = []
    for symbol, group in pdf.groupby("symbol"):
        if symbol != "none":
            s = group.set_index("ts")["close"]
            parts.append(s[~s.index.duplicated(keep="first")].rename(symbol))
    expected = pd.concat(parts, axis=1).resample("1D").last().bfill().ffill().sort_index()
    out = matrix.price_matrix(matrix_rows(spark), ["a", "b"], order=["seq"]).orderBy("day").toPandas()
    assert out[["a", "b"]].values.tolist() == expected[["a", "b"]].values.tolist()


def test_matrix_covers_days_and_series_without_prices(spark):
    rows = matrix_rows(spark).union(spark.createDataFrame([("none", day(10), None, 9)], "symbol string, ts timestamp_ntz, close double, seq int"))
    out = matrix.price_matrix(rows, ["a", "none"], order=["seq"]).orderBy("day").collect()
    assert [r["a"] for r in out] == [2, 5, 5, 5, 5, 5, 5, 5, 5] and {r["none"] for r in out} == {None}


def test_ffill_never_looks_ahead(spark):
    out = matrix.price_matrix(matrix_rows(spark), ["a", "b"], order=["seq"], method="ffill").orderBy("day").collect()
    assert [r["a"] for r in out] == [2, 2, 2, 2, 5, 5, 5]
    assert [r["b"] for r in out] == [None, None, 7, 7, 7, 7, 9]


def test_resample_in_market_time(spark):
    df = spark.createDataFrame([("a", day(1, 15), 1.0)], "symbol string, ts timestamp_ntz, close double")
    assert str(aggregates.resample_daily(df).first()["day"]) == "2024-01-01"
    assert str(aggregates.resample_daily(df, market_tz="Asia/Seoul").first()["day"]) == "2024-01-02"


def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (1, None, "d")], "k int, seq int, x string")
    last, first = dedup.dedup_keep_last(df, ["k"], ["seq"]), dedup.dedup_keep_first(df, ["k"], ["seq"])
    assert rows(last) == [(1, 2, "b"), (2, 1, "c")] and rows(first) == [(1, 1, "a"), (2, 1, "c")]
    assert rows(dedup.dedup_keep_last(last, ["k"], ["seq"])) == rows(last)


def test_equal_values_on_different_dates_collapse(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 6.0)], "d int, x double")
    assert rows(dedup.dedup_values(df, ["x"], ["d"])) == [(2, 5.0), (3, 6.0)]


def test_accumulate_new_wins(spark, rows):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "link string, seq int, x string")
    new = spark.createDataFrame([("a", 0, "new"), ("c", 0, "new"), ("c", 1, "newer")], "link string, seq int, x string")
    assert rows(sets.accumulate(old, new, ["link"], ["seq"])) == [("a", 0, "new"), ("b", 2, "old"), ("c", 1, "newer")]


def test_union_fills_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert rows(sets.union_all(a, b)) == [(1, 2), (3, None)]


def test_text_ids_sort_as_numbers(spark):
    df = spark.createDataFrame([("10",), ("2",), ("1",)], "id string")
    assert [r.id for r in sets.sort_by_id(df).collect()] == ["1", "2", "10"]


def test_names_of_later_universe_win(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    first = spark.createDataFrame([("a", "A1"), ("b", "B1")], "symbol string, full_name string")
    later = spark.createDataFrame([("a", "A2")], "symbol string, full_name string")
    assert rows(joins.map_names(df, [first, later])) == [("a", "A2"), ("b", "B1"), ("c", None)]
