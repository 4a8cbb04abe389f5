"""Elements of JSON documents that lie over many parts."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.sources import jsonparts

JSON = st.recursive(
    st.none() | st.integers() | st.text(alphabet='a"\\{}[],:é\n ', max_size=8),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(alphabet='k"\\,', max_size=3), inner, max_size=4),
    max_leaves=20,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(JSON, max_size=6), st.integers(1, 2), st.sampled_from([None, 1]), st.data())
def test_cut_at_any_byte(items, level, indent, data):
    document = items if level == 1 else {"games": items}
    text = json.dumps(document, ensure_ascii=False, indent=indent).encode()
    where = sorted(data.draw(st.lists(st.integers(0, len(text)), max_size=5)))
    state, segments = (False, False, 0), [[False, b""]]
    for a, b in zip([0, *where], [*where, len(text)]):
        found, *state = jsonparts.cut(text[a:b], *state, level)
        segments[-1][1] += found[0][1]
        segments += [list(f) for f in found[1:]]
    elements = [json.loads(t) for element, t in segments if element and t.strip()]
    assert elements == items and state == [False, False, 0]


@pytest.fixture
def small_parts(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(n, seed):
    rnd = random.Random(seed)
    words = ['plain', 'quo"te', "back\\", "br{ace", "]}", "é,日", "\\\\\"", "x" * 300]
    return [{"id": i, "text": rnd.choice(words) * rnd.randint(0, 3), "turns": [{"a": rnd.choice(words)}, []]} for i in range(n)]


def test_documents_are_read_by_many_tasks(spark, tmp_path, small_parts):
    files = {"a.json": made(120, 1), "b.json": made(3, 2), "c.json": []}
    for name, items in files.items():
        (tmp_path / name).write_text(json.dumps(items, ensure_ascii=False, indent=1 if name == "a.json" else None))
    rows = jsonparts.array_lines(spark, str(tmp_path))
    found = sorted((r["file"].rsplit("/", 1)[1], r["number"], json.loads(r["line"])) for r in rows.collect())
    for name, items in files.items():
        assert [e for f, _, e in found if f == name] == items
    lines = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20


def test_arrays_of_fields_and_keyed_documents(spark, tmp_path, small_parts):
    (tmp_path / "a.json").write_text(json.dumps({"games": made(40, 3), "more": {"x": 1}, "other": made(4, 4), "n": 5}, indent=2))
    lines = jsonparts.array_lines(spark, str(tmp_path), "games").orderBy("number").collect()
    assert [json.loads(r["line"]) for r in lines] == made(40, 3)
    assert jsonparts.array_lines(spark, str(tmp_path), "other").count() == 4
    assert jsonparts.array_lines(spark, str(tmp_path), "nobody").count() == 0
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "c.json").write_text(json.dumps({str(m["id"]): {"title": m["text"]} for m in made(60, 5)}, ensure_ascii=False))
    back = jsonparts.keyed_entries(spark, str(tmp_path / "k"), "STRUCT<title: STRING>").collect()
    assert sorted((r["id"], r["entry"]["title"]) for r in back) == sorted((str(m["id"]), m["text"]) for m in made(60, 5))


def test_scans_hold_a_bounded_text(spark, tmp_path, monkeypatch):
    """Many rows of one batch, and one row that is longer than a stretch."""
    items = [*made(60, 6), {"id": 60, "text": "é\\\"{[" * 500}, *made(20, 7)]
    rows = [v for v in json.dumps(items, ensure_ascii=False).split("}")]
    monkeypatch.setattr(jsonparts, "STRETCH", 100)
    n = len(rows)
    batch = jsonparts.pa.RecordBatch.from_pydict({"value": rows, "file": ["f"] * n, "at": [0] * n, "inside": [False] * n, "escaped": [False] * n, "depth": [0] * n})
    texts = [t for _, t in jsonparts._stretches(iter([batch]))]
    assert max(len(t.decode()) for t in texts) <= 100 and b"".join(texts).decode() == "}".join(rows) + "}"
    segments = {}
    for part in jsonparts._cutter(1)(iter([batch])):
        for r in part.to_pylist():
            own = segments.setdefault(r["segment"], [r["element"], {}])
            own[0] |= r["element"]
            own[1][r["piece"]] = r["text"]
    found = ["".join(t for _, t in sorted(pieces.items())) for element, pieces in segments.values() if element]
    assert [json.loads(t) for t in found if t.strip(" }")] == items
