"""Feeds as a data source, functions with a carried state, pieces of conversations, deletes over the key graph."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import chat, joins, perseries
from tidemark.schemas import TABLES, Field, Table
from tidemark.sources.feedsource import FileFeed, register_feed


def write(folder, **answers):
    for name, text in answers.items():
        os.makedirs(folder, exist_ok=True)
        (folder / name).write_text(text)


def test_a_feed_is_read_as_batch_and_stream(spark, tmp_path):
    root = tmp_path / "feed"
    write(root / "symbol=A%23B", a1="x1", a2="x2")
    write(root / "c", a1="y1")
    register_feed(spark, "test_feed", FileFeed(str(root)))
    batch = lambda: sorted(map(tuple, spark.read.format("test_feed").load().collect()))
    assert batch() == [("A#B", 0, "x1", None), ("A#B", 1, "x2", None), ("c", 0, "y1", None)]

    def poll():
        rows = spark.readStream.format("test_feed").load().writeStream.format("parquet")
        rows = rows.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
        rows.trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))

    assert poll() == batch()
    write(root / "c", a2="y2")
    write(root / "d", a1="z1")
    assert poll() == batch() and len(batch()) == 5


def test_an_item_that_fails_keeps_the_others(spark):
    class Broken:
        def items(self):
            return ["good", "bad"]

        def reached(self, item):
            return 2

        def fetch(self, item, first, last):
            yield f"{item} 0"
            if item == "bad":
                raise OSError("gone")
            yield f"{item} 1"

    register_feed(spark, "broken_feed", Broken(), item="company")
    rows = sorted(map(tuple, spark.read.format("broken_feed").load().collect()), key=repr)
    assert rows == [("bad", 0, "bad 0", None), ("bad", 1, None, "OSError: gone"), ("good", 0, "good 0", None), ("good", 1, "good 1", None)]


FOLDED = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType()), T.StructField("parts", T.LongType())])


def folded(spark, rows, max_rows, step=None):
    df = spark.createDataFrame(rows, "symbol string, at int, c string").repartition(3)
    df = df.withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz"))

    def add(state, pdf):
        return (state[0] + len(pdf), state[1] + "".join(pdf["c"]), state[2])

    def merge(a, b):
        return (a[0] + b[0], a[1] + b[1], a[2] + b[2])

    def finish(state):
        return None if state[1] == "none" else pd.DataFrame([state], columns=["n", "text", "parts"])

    return {
        r["symbol"]: tuple(r)[1:]
        for r in perseries.fold_per_series(df, lambda: (0, "", 1), step or add, merge, finish, FOLDED, max_rows=max_rows).collect()
    }


def test_state_is_carried_over_the_parts_of_a_series(spark):
    text = "".join(chr(97 + i % 26) for i in range(700))
    rows = [("hot", i, c) for i, c in enumerate(text)] + [("x", i, c) for i, c in enumerate("abc")] + [(None, 1, "z")]
    rows += [("nothing", i, c) for i, c in enumerate("none")]
    found = folded(spark, rows, 100)
    assert found["hot"][:2] == (700, text) and found["hot"][2] > 3
    assert found["x"] == (3, "abc", 1, None) and "nothing" not in found and found[None][:2] == (1, "z")
    assert folded(spark, rows, 10**6)["hot"] == (700, text, 1, None)


def test_a_failing_step_is_one_row_with_its_message(spark):
    def step(state, pdf):
        if (pdf["c"] == "!").any():
            raise ValueError("no")
        return (state[0] + len(pdf), "", 1)

    rows = [("bad", i, "!" if i == 150 else "a") for i in range(300)] + [("good", 1, "a")]
    assert folded(spark, rows, 50, step) == {"bad": (None, None, None, "ValueError: no"), "good": (1, "", 1, None)}


def test_pieces_of_a_conversation_are_the_whole(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", "é" * (t % 50)) for t in range(400)] + [(None, 1, None, None), (8, 1, "user", "x" * 500)]
    rows += [(7, 3, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(5)
    pieces = chat.message_pieces(df, max_bytes=300).collect()
    whole = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in chat.nested_messages(df).collect()}
    joined = {}
    for r in sorted(pieces, key=lambda r: r["first"]):
        size = sum(len((m["role"] or "").encode()) + len((m["content"] or "").encode()) for m in r["messages"])
        assert size <= 300 or len(r["messages"]) == 1
        joined.setdefault(r["conv_id"], []).extend(tuple(m) for m in r["messages"])
    assert joined == whole and len(pieces) > 40
    assert chat.message_pieces(df.limit(0)).collect() == []


def test_deletes_reach_every_level(spark):
    frames = {
        "company_meta": spark.createDataFrame([("a",), ("b",)], "company_code string"),
        "company_division": spark.createDataFrame([("d1", "a"), ("d2", "b"), ("d3", None)], "division_code string, company_code string"),
        "branch_meta": spark.createDataFrame([("s1", "d1"), ("s2", "d2"), ("s3", "d1")], "scm_key string, division_code string"),
        "supply_chain": spark.createDataFrame([(1, "s1"), (2, "s2"), (3, "s3")], "scm_idx int, scm_key string"),
        "news_main": spark.createDataFrame([(1,), (2,)], "news_id int"),
        "news_company": spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "news_id int, company_code string"),
        "news_sentiment": spark.createDataFrame([(1,), (2,)], "news_id int"),
        "stock_price": spark.createDataFrame([("a", 1), ("b", 1)], "company_code string, date int"),
    }
    rows = lambda kept: {n: sorted(map(tuple, f.select(*frames[n].columns).collect()), key=repr) for n, f in kept.items()}
    left = rows(joins.delete_graph(frames, TABLES, "company_meta", "company_code = 'a'"))
    assert left["company_division"] == [("d2", "b"), ("d3", None)] and left["branch_meta"] == [("s2", "d2")]
    assert left["supply_chain"] == [(2, "s2")] and left["news_company"] == [(1, "b"), (2, "b")]
    assert left["news_main"] == [(1,), (2,)] and left["stock_price"] == [("b", 1)]
    left = rows(joins.delete_graph(frames, TABLES, "news_main", "news_id = 1"))
    assert left["news_company"] == [(2, "b")] and left["news_sentiment"] == [(2,)] and len(left["company_meta"]) == 2
    with pytest.raises(ValueError):
        joins.delete_graph({"company_meta": frames["company_meta"]}, TABLES, "company_meta", "true")
    ring = {"a": Table((Field("k", "int"),), ("k",), {"b_k": "b"}), "b": Table((Field("k", "int"),), ("k",), {"a_k": "a"})}
    with pytest.raises(ValueError):
        joins.deletion_order(ring, "a")
