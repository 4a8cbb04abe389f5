"""Change points and risk against a direct computation with the whole kernel matrix."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import changepoint, tiles
from tidemark.plans import risk


def direct_ends(x, n_bkps=5, jump=5, min_size=2):
    n = len(x)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    median = np.median(d[np.triu_indices(n, 1)])
    k = np.exp(-np.clip(d / median if median else d, 0.01, 100))
    np.fill_diagonal(k, 1)

    def cost(s, e):
        return (e - s) - k[s:e, s:e].sum() / (e - s)

    ends = [n]
    for _ in range(n_bkps):
        best = (None, 0.0)
        options = []
        for s, e in zip([0, *ends], ends):
            splits = [
                (round(cost(s, e) - cost(s, b) - cost(b, e), 9), b)
                for b in range(s, e, jump)
                if b - s >= min_size and e - b >= min_size
            ]
            options.append(max(splits) if splits else (0.0, None))
        best = max(options, key=lambda o: o[0])
        if best[1] is None:
            break
        ends = sorted([*ends, best[1]])
    return ends


def direct_risk(close, volume, alpha=0.3):
    close, volume = np.asarray(close, float), np.asarray(volume, float)
    x = np.column_stack([np.diff(close) / (close[:-1] + 1e-9), np.diff(volume) / (volume[:-1] + 1e-9)])
    raw, start = np.zeros(len(x)), 0
    for end in direct_ends(x):
        raw[start:end] = np.sqrt(x[start:end, 0].std() ** 2 + x[start:end, 1].std() ** 2)
        start = end
    lo, hi = raw.min(), raw.max()
    scaled = np.full(len(x), 0.5) if hi - lo < 1e-9 else (raw - lo) / (hi - lo)
    smooth = scaled.copy()
    for i in range(1, len(x)):
        smooth[i] = alpha * scaled[i] + (1 - alpha) * smooth[i - 1]
    return np.where(smooth < 1e-5, 0, smooth) * 100


@pytest.mark.parametrize("n", [27, 28, 30, 53, 131, 203])
def test_block_sums_find_the_same_splits(n):
    rng = np.random.default_rng(n)
    for scale in (1.0, 1e6):
        x = rng.normal(size=(n, 2)) * [1, scale] + (np.arange(n) > n // 2)[:, None]
        assert changepoint.segment_ends(x) == direct_ends(x)


def test_strips_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(160, 2)), 1)
    whole, median = changepoint.segment_ends(x), changepoint.pair_median(x)
    monkeypatch.setattr(changepoint, "STRIP_VALUES", 900)
    monkeypatch.setattr(changepoint, "DIRECT_MEDIAN_POINTS", 10)
    monkeypatch.setattr(changepoint, "SAMPLED_PAIRS", 30)
    assert changepoint.segment_ends(x) == whole and changepoint.pair_median(x) == median
    for n in (11, 12, 13, 40, 41):
        for y in (rng.normal(size=(n, 2)), rng.integers(0, 2, size=(n, 2)).astype(float), np.zeros((n, 2))):
            d = ((y[:, None] - y[None]) ** 2).sum(-1)[np.triu_indices(n, 1)]
            assert changepoint.pair_median(y) == np.median(d)


def test_unusable_numbers_end_the_search(monkeypatch):
    monkeypatch.setattr(changepoint, "DIRECT_MEDIAN_POINTS", 10)
    x = np.random.default_rng(0).normal(size=(40, 2))
    x[3, 0] = np.nan
    x[5, 1] = np.inf
    with np.errstate(invalid="ignore"):
        changepoint.pair_median(np.full((40, 2), np.nan))
        changepoint.pair_median(x)
        assert len(changepoint.segment_ends(x)) >= 1


def test_too_few_points_for_five_splits():
    assert changepoint.shortest_series() == 27
    assert changepoint.segment_ends(np.zeros((26, 2))) is None


def series(symbol, n, seed, step=timedelta(days=1)):
    rng = random.Random(seed)
    return [(symbol, datetime(2024, 1, 1) + step * i, rng.uniform(10, 90) * (3 if i > n / 2 else 1), rng.randint(0, 90)) for i in range(n)]


SCHEMA = "symbol string, ts timestamp_ntz, close double, volume bigint"


def by_symbol(df, symbol):
    return [r for r in df.orderBy("chunk", "ts").collect() if r["symbol"] == symbol]


def test_risk_matches_the_direct_computation(spark):
    data = series("a", 60, 1) + series("b", 28, 2) + series("short", 27, 3) + series("one", 1, 4)
    random.Random(0).shuffle(data)
    df = spark.createDataFrame(data, SCHEMA)
    out = risk.risk_scores(df, chunk_rows=None)
    for symbol, n, seed in (("a", 60, 1), ("b", 28, 2)):
        rows = sorted(series(symbol, n, seed), key=lambda r: r[1])
        mine = by_symbol(out, symbol)
        assert [r["ts"] for r in mine] == [r[1] for r in rows[1:]]
        assert [r["risk_value"] for r in mine] == pytest.approx(list(direct_risk([r[2] for r in rows], [r[3] for r in rows])), abs=1e-9)
        assert max(r["seg"] for r in mine) == 5
        assert all(0 <= r["risk_value"] <= 100 for r in mine)
    assert {r["symbol"] for r in out.select("symbol").distinct().collect()} == {"a", "b"}
    left_out = {(r["symbol"], r["n_points"]) for r in risk.unscored_chunks(df, chunk_rows=None).collect()}
    assert left_out == {("short", 27), ("one", 1)}


def test_alpha_is_honoured(spark):
    rows = series("a", 50, 9)
    out = by_symbol(risk.risk_scores(spark.createDataFrame(rows, SCHEMA), alpha=0.7, chunk_rows=None), "a")
    assert [r["risk_value"] for r in out] == pytest.approx(list(direct_risk([r[2] for r in rows], [r[3] for r in rows], 0.7)), abs=1e-9)


def test_long_series_are_scored_chunk_by_chunk(spark, rows):
    data = series("a", 150, 5, timedelta(minutes=20))
    df = spark.createDataFrame(data, SCHEMA)
    whole = risk.risk_scores(df, chunk_rows=60)
    expected = []
    for lo in (0, 60):
        part = data[lo : lo + 60]
        expected += list(direct_risk([r[2] for r in part], [r[3] for r in part]))
    part = data[120:]
    expected += list(direct_risk([r[2] for r in part], [r[3] for r in part]))
    assert [r["risk_value"] for r in by_symbol(whole, "a")] == pytest.approx(expected, abs=1e-9)
    assert rows(risk.risk_scores(df, chunk_rows=60, max_rows=20)) == rows(whole)


def test_unknown_points_are_left_out_and_counted(spark):
    data = series("a", 40, 6)
    broken = [(s, t, None if i == 10 else float("nan") if i == 20 else c, v) for i, (s, t, c, v) in enumerate(data)]
    kept = [r for i, r in enumerate(data) if i not in (10, 20)]
    df = spark.createDataFrame(broken, SCHEMA)
    out = by_symbol(risk.risk_scores(df, chunk_rows=None), "a")
    assert [r["risk_value"] for r in out] == pytest.approx(list(direct_risk([r[2] for r in kept], [r[3] for r in kept])), abs=1e-9)
    assert [(r["reason"], r["n_points"]) for r in risk.unscored_chunks(df, chunk_rows=None).collect()] == [("no close or volume", 2)]


def test_constant_series_has_middle_risk(spark):
    rows = [("a", datetime(2024, 1, 1) + timedelta(days=i), 5.0, 10) for i in range(40)]
    out = risk.risk_scores(spark.createDataFrame(rows, SCHEMA), chunk_rows=None).collect()
    assert len(out) == 39 and {r["risk_value"] for r in out} == {50.0}


def test_current_risk_is_the_last_score(spark):
    df = spark.createDataFrame(series("a", 60, 1) + series("b", 28, 2), SCHEMA)
    last = {r["symbol"]: r for r in risk.current_risk(df, chunk_rows=None).collect()}
    scores = by_symbol(risk.risk_scores(df, chunk_rows=None), "a")
    assert last["a"]["ts"] == scores[-1]["ts"] and last["a"]["risk_score"] == pytest.approx(scores[-1]["risk_value"], abs=1e-4)


def _points(spark, series):
    rows = [(name, i, float(a), float(b)) for name, x in series.items() for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "symbol string, pos int, close_change double, volume_change double").repartition(5)


def test_tiles_equal_the_one_task_kernel(spark):
    rng = np.random.default_rng(5)
    series = {n: rng.normal(size=(n, 2)) * (1 + 3 * (np.arange(n) > n // 3))[:, None] for n in (27, 99, 100, 101, 433)}
    series = {f"s{n}": x for n, x in series.items()} | {None: np.round(rng.normal(size=(150, 2)), 1), "flat": np.zeros((60, 2))}
    series["short"] = rng.normal(size=(26, 2))
    found = {r["symbol"]: r["segments"] for r in tiles.change_points(_points(spark, series), ["symbol"], tile=50).collect()}
    assert set(found) == set(series) - {"short"}
    medians = tiles.pair_medians(_points(spark, series), ["symbol"], ["close_change", "volume_change"], tile=50).collect()
    medians = {r["symbol"]: r["pair_median"] for r in medians}
    for name, x in series.items():
        assert name is None or medians[name] == changepoint.pair_median(x)
        if name != "short":
            expected = changepoint.segment_table(x)
            assert [(r["start_i"], r["end_i"]) for r in found[name]] == [(r["start_i"], r["end_i"]) for r in expected]
            assert [r["volatility"] for r in found[name]] == pytest.approx([r["volatility"] for r in expected])


def test_no_task_holds_more_than_a_tile(spark):
    x = np.random.default_rng(1).normal(size=(400, 2))
    strips = tiles._strips(_points(spark, {"a": x}), ["symbol"], ["close_change", "volume_change"], "pos", 50)
    spans = strips.groupBy("sid").agg(F.lit(0).alias("begin"), F.lit(400).alias("end"))
    pairs = tiles._pairs(strips, spans, 50).select(F.size("x0").alias("n"), F.size("y0").alias("m"), "i", "j").collect()
    assert len(pairs) == 36 and all(r["n"] == 50 and r["m"] == 50 and r["i"] <= r["j"] for r in pairs)


def test_unusable_numbers_have_no_median(spark):
    x = np.random.default_rng(0).normal(size=(40, 2))
    y = x.copy()
    y[3, 0] = np.nan
    medians = tiles.pair_medians(_points(spark, {"x": x, "y": y, "one": x[:1]}), ["symbol"], ["close_change", "volume_change"], tile=15)
    medians = {r["symbol"]: r["pair_median"] for r in medians.collect()}
    assert medians["x"] == changepoint.pair_median(x) and np.isnan(medians["y"]) and medians["one"] == 0.0


def test_whole_series_are_scored_alike_in_one_task_and_as_tiles(spark):
    rng = np.random.default_rng(8)
    start = datetime(2024, 1, 1)
    rows = [
        (s, start + timedelta(minutes=i), float(rng.uniform(1, 9)), int(rng.integers(1, 99))) for s, n in (("a", 140), ("b", 35)) for i in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, risk.risk_scores(df, chunk_rows=None).collect()))
    spread = sorted(map(tuple, risk.risk_scores(df, chunk_rows=None, one_task=50).collect()))
    assert [r[:-1] for r in one] == [r[:-1] for r in spread] and len(one) == 173
    assert [r[-1] for r in spread] == pytest.approx([r[-1] for r in one])
    chunked = sorted(map(tuple, risk.risk_scores(df).collect()))
    assert [r[-1] for r in chunked] == pytest.approx([r[-1] for r in one])


def test_only_changed_chunks_are_scored_again(spark, tmp_path):
    rng = np.random.default_rng(4)
    start = datetime(2024, 1, 1)
    rows = [(s, start + timedelta(minutes=i), float(rng.uniform(1, 9)), int(rng.integers(1, 99))) for s in ("a", "b", None) for i in range(130)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
    path = str(tmp_path / "r")
    scored = lambda run: spark.read.parquet(f"{path}/scores/run={run}").groupBy("symbol", "chunk").count().count()
    for run, (now, chunks) in enumerate(
        [
            (df.where(F.col("ts") < start + timedelta(minutes=100)), 6),
            (df, 4),
            (df, 0),
            (df.withColumn("close", F.when((F.col("symbol") == "a") & (F.col("ts") == start), 99.0).otherwise(F.col("close"))), 1),
            (df.where("symbol = 'b'"), 0),
        ]
    ):
        found = plain(risk.score_changed(now, path, chunk_rows=50).drop("risk_value"))
        full = risk.risk_scores(now, chunk_rows=50)
        assert found == plain(full.drop("risk_value"))
        assert [r[-1] for r in plain(risk.changed_scores(spark, path))] == pytest.approx([r[-1] for r in plain(full)])
        assert run == 0 or scored(run) <= chunks + 2
    assert scored(3) == 1 and scored(2) == 0 and scored(4) == 0


def test_short_series_need_two_passes_for_the_median(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(90, 2)), np.repeat(rng.normal(size=(10, 2)), 7, axis=0)
    passes, pairs = [], tiles._pairs
    monkeypatch.setattr(tiles, "_pairs", lambda *a: passes.append(1) or pairs(*a))
    medians = tiles.pair_medians(_points(spark, {"x": x, "y": y}), ["symbol"], ["close_change", "volume_change"], tile=15)
    found = {r["symbol"]: r["pair_median"] for r in medians.collect()}
    for name, points in (("x", x), ("y", y)):
        d = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1)
        assert found[name] == pytest.approx(float(np.median(d[np.triu_indices(len(points), 1)])), rel=1e-12)
    assert len(passes) == 2
