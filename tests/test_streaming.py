import math
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import filters
from tidemark.streaming import news, prices
from tidemark.streaming.tiers import Tiers, cover, due

SCHEMA = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume bigint"


def bars(spark, *rows):
    return spark.createDataFrame([(s, datetime(2024, 1, d), c, c, c, c, 1) for s, d, c in rows], SCHEMA)


def keys(df):
    return sorted((r.symbol, r.ts.day, r.close) for r in df.collect())


def deliver(spark, df, home):
    df.coalesce(1).write.mode("append").parquet(f"{home}/landing")


def test_stream_equals_batch(spark, tmp_path):
    home = str(tmp_path)
    first, second = bars(spark, ("a", 1, 1.0), ("a", 2, 2.0), ("b", 5, 5.0)), bars(spark, ("a", 2, 2.5), ("a", 3, 3.0), ("b", 4, 4.0), ("c", 1, 1.0))
    for delivery in (first, second):
        deliver(spark, delivery, home)
        prices.stream_prices(spark, f"{home}/landing", f"{home}/table", first.schema)
    expected = first.union(filters.only_newer(second, first))
    assert keys(prices.stored_prices(spark, f"{home}/table")) == keys(expected)
    assert keys(prices.late_prices(spark, f"{home}/table")) == [("a", 2, 2.5), ("b", 4, 4.0)]
    assert ("a", 2, 2.5) in keys(prices.current_prices(spark, f"{home}/table", order=["close"]))
    prices.stream_prices(spark, f"{home}/landing", f"{home}/table", first.schema)
    assert prices.stored_prices(spark, f"{home}/table").count() == 5


def test_polling_stream(spark, tmp_path):
    home = str(tmp_path)
    deliver(spark, bars(spark, ("a", 1, 1.0)), home)
    query = prices.stream_prices(spark, f"{home}/landing", f"{home}/table", bars(spark).schema, once=False, interval="1 second")
    try:
        query.processAllAvailable()
        deliver(spark, bars(spark, ("a", 2, 2.0)), home)
        query.processAllAvailable()
    finally:
        query.stop()
    assert keys(prices.stored_prices(spark, f"{home}/table")) == [("a", 1, 1.0), ("a", 2, 2.0)]


def test_a_batch_run_twice_is_stored_once(spark, tmp_path):
    table = str(tmp_path / "t")
    first, second = bars(spark, ("a", 1, 1.0)), bars(spark, ("a", 2, 2.0))
    prices.store_batch(first, 0, table, "symbol", "ts")
    prices.store_batch(second, 1, table, "symbol", "ts")
    prices.store_batch(second, 1, table, "symbol", "ts")
    assert keys(prices.stored_prices(spark, table)) == [("a", 1, 1.0), ("a", 2, 2.0)]


def test_stream_starts_after_stored_rows(spark, tmp_path):
    home = str(tmp_path)
    deliver(spark, bars(spark, ("a", 1, 1.0), ("a", 2, 2.0)), home)
    prices.stream_prices(spark, f"{home}/landing", f"{home}/table", bars(spark).schema, stored=bars(spark, ("a", 1, 9.0)))
    assert keys(prices.stored_prices(spark, f"{home}/table")) == [("a", 2, 2.0)]


def test_catch_up_goes_step_by_step(spark, tmp_path):
    home = str(tmp_path)
    for d in (1, 2, 3):
        deliver(spark, bars(spark, ("a", d, float(d))), home)
    prices.catch_up(spark, f"{home}/landing", f"{home}/table", bars(spark).schema)
    assert Tiers(spark, f"{home}/table/rows").finished() == [(0, 0), (1, 1), (2, 2)]
    assert prices.stored_prices(spark, f"{home}/table").count() == 3


def test_redelivered_rows_are_stored_once(spark, tmp_path):
    home = str(tmp_path)
    for delivery in (bars(spark, ("a", 1, 1.0), ("a", 2, 2.0)), bars(spark, ("a", 2, 2.0), ("a", 3, 3.0))):
        deliver(spark, delivery, home)
        prices.stream_distinct(spark, f"{home}/landing", f"{home}/table", delivery.schema, keys=("symbol", "ts"))
    assert keys(prices.distinct_rows(spark, f"{home}/table")) == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0)]


def test_headlines_of_new_pages(spark, tmp_path):
    home = str(tmp_path)
    for n in (1, 2):
        page = spark.createDataFrame([(n, f"<nav><li><a>h{n}</a></li></nav>")], "page_id int, html string")
        deliver(spark, page, home)
        news.stream_headlines(spark, f"{home}/landing", f"{home}/table", page.schema)
    assert sorted(r.headline for r in spark.read.parquet(f"{home}/table/rows").collect()) == ["h1", "h2"]


def test_articles_accumulate(spark, tmp_path):
    home = str(tmp_path)
    schema = "seq int, company string, link string, title string"
    for rows in ([(1, "a", "u1", "t1"), (2, "a", "u2", "t2")], [(3, "a", "u1", "t1 new"), (4, "b", "u1", "t1 b")]):
        delivery = spark.createDataFrame(rows, schema)
        deliver(spark, delivery, home)
        news.stream_articles(spark, f"{home}/landing", f"{home}/table", delivery.schema)
    assert sorted(r.seq for r in news.accumulated_articles(spark, f"{home}/table").collect()) == [2, 3, 4]
    assert sorted(r.seq for r in news.unseen_articles(spark, f"{home}/table").select(F.col("seq")).collect()) == [1, 2, 4]


def test_often_delivered_article_is_unseen_once(spark, tmp_path):
    home = str(tmp_path)
    for part in range(2):
        rows = [(part * 100 + i, "a", "hot", f"t{i}") for i in range(60)] + [(part * 100 + 90 + i, "a", f"u{i}", "t") for i in range(5)]
        delivery = spark.createDataFrame(rows, "seq int, company string, link string, title string")
        deliver(spark, delivery, home)
        news.stream_articles(spark, f"{home}/landing", f"{home}/table", delivery.schema)
    seen = [r.link for r in news.unseen_articles(spark, f"{home}/table").collect()]
    assert sorted(seen) == ["hot", "u0", "u1", "u2", "u3", "u4"]


def test_first_delivery_may_come_late(spark, tmp_path):
    home = str(tmp_path)
    march, late = bars(spark, ("a", 31, 1.0)), bars(spark, ("a", 1, 5.0), ("a", 31, 1.0), ("b", 31, 2.0))
    for delivery in (march, late, late):
        deliver(spark, delivery, home)
        prices.stream_distinct(spark, f"{home}/landing", f"{home}/table", delivery.schema, keys=("symbol", "ts"))
    assert keys(prices.distinct_rows(spark, f"{home}/table")) == [("a", 1, 5.0), ("a", 31, 1.0), ("b", 31, 2.0)]


def test_compaction_and_merged_times(spark, tmp_path):
    table = str(tmp_path / "t")
    for b, d in enumerate((1, 2, 3, 4, 5)):
        day = bars(spark, ("a", d, float(d)), *([("z", 9, 1.0)] if b == 0 else []))
        prices.store_batch(day, b, table, "symbol", "ts", width=2)
        if b in (2, 3):
            prices.compact(spark, table, keep=1)
    prices.store_batch(bars(spark, ("z", 8, 2.0), ("a", 5, 7.0)), 5, table, "symbol", "ts", width=2)
    assert keys(prices.stored_prices(spark, table)) == [("a", d, float(d)) for d in (1, 2, 3, 4, 5)] + [("z", 9, 1.0)]
    assert keys(prices.late_prices(spark, table)) == [("a", 5, 7.0), ("z", 8, 2.0)]


def test_rows_are_rewritten_once_for_each_tier():
    for width in (2, 3, 8):
        folders, rewritten, most = [], 0, 0
        for batch in range(200):
            folders = cover(folders)
            span = due(batch, width)
            if span:
                assert span[1] == batch - 1
                folders.append(span)
                rewritten += span[1] - span[0] + 1
            folders.append((batch, batch))
            assert sorted(b for first, last in cover(folders) for b in range(first, last + 1)) == list(range(batch + 1))
            most = max(most, len(cover(folders)))
        tiers = math.floor(math.log(199, width))
        assert rewritten <= 200 * tiers and most <= width * (tiers + 1)


def test_a_failed_batch_meets_only_what_came_before(spark, tmp_path):
    table = str(tmp_path / "t")
    for b in range(5):
        for _ in range(2 if b in (2, 4) else 1):
            prices.store_batch(bars(spark, ("a", b + 1, float(b))), b, table, "symbol", "ts", width=2)
    assert keys(prices.stored_prices(spark, table)) == [("a", b + 1, float(b)) for b in range(5)]
    assert prices.late_prices(spark, table).isEmpty()
    assert Tiers(spark, f"{table}/rows").finished() == [(0, 3), (4, 4)]


def files_below(path):
    return sum(len(files) for _, _, files in os.walk(path))


@pytest.mark.parametrize("order", [(), ("close",)])
def test_many_batches_leave_few_files(spark, tmp_path, order):
    """Restarted after every four batches; each batch brings two old days and a new one."""
    home, counts = str(tmp_path), []
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for start in range(0, 24, 4):
            for d in range(start, start + 4):
                rows = [("a", 1 + day, float(day)) for day in (max(d - 9, 0), max(d - 1, 0), d)] + [("a", 1 + d, d + 0.5)] * bool(order)
                deliver(spark, bars(spark, *rows), home)
            options = {"keys": ("symbol", "ts"), "order": order, "max_files": 1, "width": 2}
            prices.stream_distinct(spark, f"{home}/landing", f"{home}/table", bars(spark).schema, **options)
            counts.append((files_below(f"{home}/table/rows"), files_below(f"{home}/table/_progress/state")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert keys(prices.distinct_rows(spark, f"{home}/table")) == [("a", 1 + d, float(d)) for d in range(24)]
    # 24 batches without merging would be 96 files.
    assert counts[-1][0] <= 4 * 10 and counts[-1][1] <= 4 * counts[1][1]


def test_two_late_copies_in_one_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    prices.store_batch(bars(spark, ("a", 1, 1.0)), 0, table, "symbol", "ts")
    prices.store_batch(bars(spark, ("a", 1, 3.0), ("a", 1, 2.0)), 1, table, "symbol", "ts")
    assert keys(prices.current_prices(spark, table, order=["close"])) == [("a", 1, 3.0)]
