"""Vector codes, license scans and resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import compare, connect
from tidemark.llm import codes, licenses, resampling
from tidemark.llm.common import WORD
from tidemark.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ODD = [
    (1, None),
    (2, ""),
    (3, " .,;\n"),
    (4, "One"),
    (5, "two WORDS"),
    (6, "İstanbul é日本 x\x7fy z " * 5),
    (7, "the cat sat on the mat " * 2000),
    (7, "the cat sat on the mat " * 2000),
    (8, "under the MIT license; Under the mit, license under the mit license"),
    (None, "licensed CC BY-NC and cc/by/nc by nc or Apache License, Version 2.0 " + "filler " * 20),
    (None, "w" * 5000 + " x " + "y" * 300 + " z" * 25),
]


def words_of(text):
    return re.findall(WORD, (text or "").translate(UPPER))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_licenses", "op13_resampling"])
def test_queries_equal_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == ""


# Vector codes


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 62), st.integers(1, 20), st.randoms(use_true_random=False))
def test_products_of_limbs_are_exact(bits, width, rnd):
    x, c = ([[rnd.randint(-(1 << bits), 1 << bits) for _ in range(width)] for _ in range(n)] for n in (5, 3))
    exact = [[sum(a * b for a, b in zip(u, v)) for v in c] for u in x]
    assert codes.dot_products(np.array(x, dtype=object), np.array(c, dtype=object), True).tolist() == exact
    wrapped = codes.dot_products(np.array(x, dtype=np.int64), np.array(c, dtype=np.int64), False)
    assert [[(e + (1 << 63)) % (1 << 64) - (1 << 63) for e in row] for row in exact] == wrapped.tolist()
    parts, limit = codes.limbs(np.array(x, dtype=object))
    assert all(np.abs(p).max() <= 1 << limit for p in parts) and width << (2 * limit) <= 1 << 53


def whole(x):
    return int(x) * 4096 if abs(x) >= 2**53 else math.floor(x * 4096)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lb) for i, v, lb in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    step = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    pad = lambda v: [whole(x) for x in v] + [0] * (parts * step - len(v))
    cut = lambda v: [pad(v)[p * step : (p + 1) * step] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    cuts = [cut(v) for _, v, _ in kept]

    def assign(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for c in cuts:
                members[assign(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(col) // len(m) for col in zip(*m)] if m else e for m, e in zip(members, books[p])]
    found, label = [], Counter()
    for (i, _, lb), c in zip(kept, cuts):
        pairs = [assign(part, book) for part, book in zip(c, books)]
        found.append((i, "".join(f"{k:02x}" for k, _ in pairs), sum(d for _, d in pairs), lb))
        label[lb] += found[-1][2]
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    fits = lambda n: n if n < 1 << 63 else None
    rows = [(i, code, fits(e), fits(label[lb])) for i, code, e, lb in found]
    return sorted(rows, key=repr), hashlib.sha256(numbers.encode()).hexdigest()


def run_codes(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, v array<double>, label string").repartition(3)
    df = df.withColumn("code", F.lit("x")).withColumn("part", F.lit(1))
    books = codes.fit(df, "v", "id")
    coded = codes.encode(df, books, "v", ["id", "label"])
    out = codes.with_group_error(coded, "label").select("id", "code", "error", "label_error").collect()
    return sorted(map(tuple, out), key=repr), books


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=16) * 10.0 ** (i % 5)).tolist(), "ab"[i % 2]) for i in rng.permutation(120)]
    rows += [(5, rows[3][1], None), (5, rows[3][1], None), (None, rows[4][1], ""), (7, [1.0] * 5, "=a"), (8, [], None)]
    rows += [(1, None, "a"), (2, [None] * 16, "a"), (3, [math.nan] * 16, "b"), (4, [math.inf] + [0.0] * 15, "b")]
    found, books = run_codes(spark, rows)
    expected, digest = brute_codes(rows)
    assert found == expected and books.digest() == digest


def test_codes_of_large_components(spark):
    rows = [(i, [float((i * 37 + k) % 11) for k in range(9)], "a") for i in range(30)]
    rows += [(90, [2.0**40, -(2.0**33)] * 4, "b"), (91, [3.7e19, -1.0] * 4, "c"), (0, [1e300] * 8, "d"), (92, [1e300] * 8, "d")]
    found, books = run_codes(spark, rows)
    expected, digest = brute_codes(rows)
    assert found == expected and books.digest() == digest


def test_codes_of_few_or_no_rows(spark):
    rows = [(2, [1.0, 2.0, 3.0], "a"), (1, [0.5, -0.25, -3.0], "a")]
    assert run_codes(spark, rows)[0] == brute_codes(rows)[0]
    found, books = run_codes(spark, [(1, None, "a")])
    assert found == [] and books.digest() == hashlib.sha256(b"").hexdigest()
    assert run_codes(spark, [(1, [], "a"), (2, [], None)])[0] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    with pytest.raises(ValueError):
        codes.fit(spark.createDataFrame([], "id bigint, v array<double>"), "v", "id", entries=257)


def test_codes_can_be_decoded(spark):
    rows = spark.createDataFrame([(i, [i / 8, -i / 4, i % 3 + 0.5, 1.0]) for i in range(40)], "id bigint, v array<double>")
    books = codes.fit(rows, "v", "id", parts=2, entries=4, rounds=3)
    coded = codes.encode(rows, books, "v", ["id", "v"]).withColumn("back", codes.decode(F.col("code"), books))
    for r in coded.collect():
        assert r["error"] == sum((math.floor(4096 * a) - round(4096 * b)) ** 2 for a, b in zip(r["v"], r["back"]))


# License scans


def scanned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "id", "words", "label", "template", "score")})
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return sorted((tuple(r) for r in licenses.scan(docs).select(*names).collect()), key=repr)


def test_places_equal_brute_force(spark):
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    expected = []
    for doc_id, text in ODD:
        w = words_of(text)
        at = {n: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for n, p in phrases.items()}
        places = sorted(i for v in at.values() for i in v)
        labels = ",".join(sorted(n for n, v in at.items() if v))
        expected.append((doc_id, len(w), len(places), places[0] if places else None, places[-1] if places else None, labels))
    assert [r[:6] for r in scanned(spark, ODD)] == sorted(expected, key=repr)


def labels_of(spark, *texts):
    return [r[6] for r in scanned(spark, list(enumerate(texts)))]


def test_notices_are_found_and_relatives_are_not(spark):
    gpl, mit, bsd = ([t.text for t in licenses.TEMPLATES if t.label == n][-1] for n in ("gpl-3", "mit", "bsd"))
    edited = mit.replace("without restriction", "without any restriction at all").replace("and/or sell", "or sell")
    half = " ".join(mit.split()[: len(mit.split()) // 2])
    found = labels_of(spark, "x " * 50 + gpl, gpl.replace("version 3", "version 2"), edited, half, "a\n" + bsd.upper() + " b")
    assert found == ["gpl-3", "gpl-2", "mit", "", "bsd"]
    apart = mit.replace("to deal", "word " * 200 + "to deal")
    assert labels_of(spark, apart, "GNU General Public License, version 3", "GNU General Public License, version 4") == ["", "gpl-3", ""]


def test_scores_and_phrases_side_by_side(spark):
    rows = scanned(spark, [(1, "cc by nc cc by nc"), (2, "cc by nc by nc"), (3, "nothing here at all")])
    assert rows == [
        (1, 6, 2, 0, 3, "cc-by-nc", "cc-by-nc", 1.0), (2, 5, 1, 0, 0, "cc-by-nc", "cc-by-nc", 1.0), (3, 4, 0, None, None, "", "", 0.0),
    ]
    assert scanned(spark, []) == []


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 4)
    text = " ".join(f"w{i % 17}" for i in range(300))
    batch = pa.RecordBatch.from_pydict({"row": [7], "id": [70], "text": [text]})

    def runs(stretch):
        monkeypatch.setattr(licenses, "STRETCH", stretch)
        out, documents = [], []
        for r in (r for b in licenses._hash_texts(iter([batch])) for r in b.to_pylist()):
            if r["n_words"] is not None:
                documents.append((r["id"], r["n_words"]))
            else:
                out += [(r["start"] + i, h, tuple(r["words"][i : i + 3])) for i, h in enumerate(r["hashes"])]
        return sorted(out), documents

    assert runs(50) == runs(1 << 20)
    assert runs(50)[1] == [(70, 300)] and len(runs(50)[0]) == 298


# Resampling


def runs_of(text):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def brute_resample(docs, target, buckets=10_000):
    number = lambda f: zlib.crc32(f.encode()) % buckets
    s, t, rows = Counter(), Counter(), []
    for doc_id, text in docs:
        found, n = runs_of(text)
        rows.append((doc_id, n, [number(f) for f in found]))
        s.update(rows[-1][2])
    for text in target:
        t.update(map(number, runs_of(text)[0]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc_id, n, b in rows:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        out.append((doc_id, n, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able


@pytest.mark.parametrize("percent", [0, 40, 100])
def test_resampling_equals_brute_force(spark, percent):
    docs = ODD + [(i, f"w{i} w{i % 3} and more words of this kind " * (i % 5)) for i in range(20, 60)]
    target = ["the cat sat", None, "more words of this", "x z z"]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumns({"h": F.lit(1), "rank": F.lit("x")})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(rows, wanted, percent).collect()
    everything, able = brute_resample(docs, target)
    mine = [(r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in found]
    assert sorted(mine, key=repr) == sorted(everything, key=repr)
    drawn = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    most = percent * len(able) // 100
    assert [r["rank"] for r in drawn] == list(range(1, most + 1))
    assert [(r["score"], r["doc_id"]) for r in drawn] == [(r[4], r[0]) for r in able[:most]]


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert resampling.resample(none, none).collect() == []
    one = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert [tuple(r)[1:4] for r in resampling.resample(one, none).collect()] == [(0, 0, 0)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab1é日", min_size=1, max_size=90), min_size=1, max_size=9))
def test_checksums_of_windows(words):
    numbers = np.arange(len(words))
    for k, (at, sums) in enumerate(resampling.window_sums(words, numbers, numbers, 3), 1):
        assert sums.tolist() == [zlib.crc32(" ".join(words[i - k + 1 : i + 1]).encode()) for i in at.tolist()]
        assert at.tolist() == list(range(k - 1, len(words)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é.\n日\x7f1", max_size=30), max_size=40))
def test_split_segments_equals_the_pattern(segments):
    words, counts = resampling.split_segments(segments)
    found = [re.findall(WORD, s) for s in segments]
    assert words == [w for ws in found for w in ws] and counts.tolist() == [len(ws) for ws in found]


@pytest.mark.parametrize("stretch", [20, 100, 1 << 20])
def test_long_texts_are_counted_in_pieces(monkeypatch, stretch):
    monkeypatch.setattr(resampling, "STRETCH", stretch)
    texts = ["a b", " ".join(f"w{i % 17}" for i in range(90)) + " " + "v" * 150 + " end é", None, "..", "x y z"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    found = Counter()
    for part, rows, some, known in resampling._units(iter([batch])):
        for owner, sums, k in resampling._features(some, known):
            found.update(zip(part.column("text").take(pa.array(rows[owner])).to_pylist(), sums.tolist()))
    assert found == Counter((t, zlib.crc32(f.encode())) for t in texts for f in runs_of(t)[0])
