"""Bucketed history: batches come to it, it is never shuffled."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import history

BARS = "symbol string, ts timestamp_ntz, open double, high double, low double, close double"


@pytest.fixture
def bars(spark):
    rows = [(s, datetime(2024, m, d), *[float(m)] * 3, float(d)) for s in ("005930", "b", "c") for m in (1, 2, 3) for d in range(1, 21)]
    return spark.createDataFrame(rows, BARS)


@pytest.fixture
def made(spark, bars, tmp_path):
    name = f"h_{tmp_path.name}"
    return history.create_history(bars.where("ts < '2024-03-05'"), name, str(tmp_path / "h"), buckets=5)


def above(plan, what):
    """The nodes above the scans that hold `what`, by the indentation of the plan."""
    lines = plan.splitlines()
    depth = lambda line: next((i for i, c in enumerate(line) if c not in " :+-"), 0)
    found = [i for i, line in enumerate(lines) if what in line]
    assert found
    out = []
    for at in found:
        least = depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < least:
                least = depth(line)
                out.append(line)
    return out


def test_history_is_not_shuffled(spark, bars, made):
    batch = bars.where("ts >= '2024-02-10'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows in (history.changes(made, batch), history.absent_rows(made, batch)):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and not any("Exchange" in line for line in above(plan, "Bucketed: true"))
        plan = history.newer_rows(made, batch)._jdf.queryExecution().executedPlan().toString()
        assert made.name not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_are_added_once(spark, bars, made):
    batch = bars.where("ts >= '2024-02-10'").unionByName(bars.where("ts = '2024-03-06'").withColumn("close", F.lit(100.0)))
    history.append_new(made, batch, ["close"])
    expected = sorted(map(tuple, bars.collect()))
    assert sorted(map(tuple, made.rows.select(*bars.columns).collect())) == expected
    # As if the task had died before the last times were written.
    made._write_last(bars.where("ts < '2024-03-05'").select("symbol", F.col("ts").alias("_last")))
    history.append_new(made, batch, ["close"])
    assert sorted(map(tuple, made.rows.select(*bars.columns).collect())) == expected
    assert len(list(Path(made.path, "_last").glob("*"))) == 2
    early = bars.where("ts < '2024-01-03'").withColumn("ts", F.col("ts") - F.expr("INTERVAL 60 DAYS"))
    history.append_new(made, early.withColumn("symbol", F.lit("new")).dropDuplicates(["ts"]), ["close"])
    history.append_new(made, early, ["close"])
    assert made.rows.count() == len(expected) + 2


def test_corrections_and_compaction_in_another_session(spark, bars, made):
    history.append_new(made, bars, ["close"])
    again = history.open_history(spark, f"{made.name}_again", made.path)
    fixed = bars.withColumn("close", F.when(F.col("ts") == datetime(2024, 2, 15), 99.0).otherwise(F.col("close")))
    untouched = {p: p.stat().st_mtime for p in Path(made.path).glob("month=2024-01-01/*.parquet")}
    history.reconcile_history(again, fixed.unionByName(fixed.limit(1).withColumn("symbol", F.lit("other"))))
    assert untouched == {p: p.stat().st_mtime for p in Path(made.path).glob("month=2024-01-01/*.parquet")}
    history.reconcile_history(again, fixed)
    march = lambda: len(list(Path(made.path).glob("month=2024-03-01/*.parquet")))
    assert march() > 5
    history.compact(again, [date(2024, 3, 1)])
    assert march() <= 5
    assert sorted(map(tuple, again.rows.select(*bars.columns).collect())) == sorted(map(tuple, fixed.collect()))
