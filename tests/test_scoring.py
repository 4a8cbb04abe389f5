"""Texts are asked for once, whatever stops a run."""

import os
import uuid

import pytest

from tidemark.plans import scoring
from tidemark.plans.scoring import score_once


def counting(folder, broken=""):
    """A scorer that leaves a file for each call, fails on `bad` and ends its worker at `broken`."""

    def make():
        def score(text):
            body = text.split("#")[1]
            open(os.path.join(folder, f"{body}-{uuid.uuid4().hex}"), "w").close()
            if body == broken:
                os._exit(1)
            if body.startswith("bad"):
                raise ValueError("no score")
            return body.upper()

        return score

    return make


def asked(folder):
    return sorted(name.split("-")[0] for name in os.listdir(folder))


def test_a_stopped_run_goes_on_where_it_stopped(spark, tmp_path):
    rows = [(i, f"#t{i % 12:02d}#") for i in range(40)] + [(90, ""), (91, None), (92, "#bad#")]
    df = spark.createDataFrame(rows, "id int, content string").repartition(4)
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    options = {"rows_per_file": 1, "files_per_step": 2, "tries": 2, "pause": 0.0}
    with pytest.raises(Exception):
        score_once(df, counting(str(first), "t05"), str(tmp_path / "a"), **options)
    before = [t for t in asked(first) if t not in ("bad", "t05")]
    scored = {r["id"]: (r["response"], r["error"]) for r in score_once(df, counting(str(second)), str(tmp_path / "a"), **options).collect()}
    assert scored == {i: (f"T{i % 12:02d}", None) for i in range(40)} | {92: (None, "ValueError: no score")}
    after = asked(second)
    # Only the step that was stopped, two texts, is asked for again.
    assert len([t for t in after if t in before]) <= 1
    assert {t for t in [*before, *after] if t != "bad"} == {f"t{i:02d}" for i in range(12)}
    assert all(after.count(t) == 1 for t in after if t != "bad")
    third = tmp_path / "third"
    third.mkdir()
    more = df.unionByName(spark.createDataFrame([(100, "#new#")], "id int, content string"))
    assert score_once(more, counting(str(third)), str(tmp_path / "a"), **options).count() == 42
    assert asked(third) == ["new"]
    assert score_once(more, counting(str(third)), str(tmp_path / "a"), again=True, **options).count() == 42
    assert asked(third) == ["bad", "bad", "new"]


def test_large_runs_have_larger_files_not_more_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scoring, "STEPS", 5)
    (tmp_path / "calls").mkdir()
    df = spark.createDataFrame([(i, f"#t{i}#") for i in range(120)], "id int, content string").coalesce(1)
    options = {"rows_per_file": 1, "files_per_step": 2, "pause": 0.0}
    scored = score_once(df, counting(str(tmp_path / "calls")), str(tmp_path / "a"), **options)
    assert {r["id"]: r["response"] for r in scored.collect()} == {i: f"T{i}" for i in range(120)}
    steps = [n for n in os.listdir(tmp_path / "a" / "progress" / "commits") if n.isdigit()]
    # One more for each task that writes the queue.
    assert len(steps) <= 5 + 4 and len(asked(str(tmp_path / "calls"))) == 120
