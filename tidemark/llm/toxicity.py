"""Toxicity of documents by a factorization machine over hashed terms.

Terms are the words of a text and their first characters, hashed into buckets. A bucket's weight says what a term means
alone; the inner product of two buckets' factors says what they mean together, such as an insult beside a group's name,
which a sum of weights can't. Buckets are chosen by how much they tell about the labels (G2 statistic), counted over all
labelled documents outside the held-out fold by a grouped sum; then by how much they tell among the documents that hold one of
the ANCHORS best buckets, or any chosen one, since a term that tells nothing alone may do so beside another. The machine is
fitted on at most about SAMPLE labelled documents, whose chosen buckets (not texts) come to the driver; scoring reads every
whole text.

Defined results: a null or empty text gets the score of a document without any known term. Labels that are null take no
part; of several labels of a document the largest counts. Without labels of both kinds every score is the share of label 1
(0 without labels). Rows with equal ids are scored one by one. Columns besides text are kept and never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fold, join_by_group, query, stored, table

#: Labelled documents used for fitting, in expectation; all labels are used while there are fewer.
SAMPLE = 50_000
#: Hash buckets; lengths of the beginnings of words that are terms; buckets chosen at most, and what they must tell.
BUCKETS, BEGINNINGS, CHOSEN, LEAST_G2 = 1 << 20, (4, 5), 4096, 25.0
#: Chosen buckets whose documents are counted apart; buckets chosen there at most; pairs that a task holds before it adds them
#: up; rows of sums that leave it at once.
ANCHORS, PARTNERS, HELD_PAIRS, ROWS_OUT = 64, 1024, 1 << 21, 1 << 16
#: Places of a bucket's pairs, slices of all pairs, and pairs of a slice.
PLACES, SLICES = ANCHORS + 1, 64
SLICE = -(-(BUCKETS + 1) * PLACES // SLICES)
#: Factors of a bucket, and how the machine is fitted: rounds over the sample, and steps at least.
FACTORS, EPOCHS, STEPS, BATCH, RATE, DECAY = 8, 12, 1500, 128, 0.1, 1e-4
THRESHOLD = 0.3
#: Bits of one of Spark's bitmaps, bits for each labelled id, and bitmaps at most.
BITMAP, BITS_PER_ID, MOST_BITMAPS = 32768, 8, 4096


@dataclass(frozen=True)
class Machine:
    """bias + sum of weights + sum over pairs of inner products of factors, for the buckets a text holds."""

    buckets: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def buckets_of(word: bytes) -> list[int]:
    """The buckets of a lower-case word: the word, and its first characters where it is longer."""
    text = word.decode(errors="replace")
    terms = [b"w" + word, *(b"p" + text[:n].encode() for n in BEGINNINGS if len(text) >= n)]
    return [crc32(t) % BUCKETS for t in terms]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode(errors="replace").lower().split()


class _Terms:
    """The chosen buckets of texts; the answer for a word is kept until there are too many."""

    def __init__(self, chosen: dict[int, int] | None, most: int = 1 << 17):
        self.chosen, self.most, self.known = chosen, most, {}

    def __call__(self, text: str | None) -> list[int]:
        known, found = self.known, set()
        if len(known) > self.most:
            known.clear()
        for word in set(_words(text)):
            own = known.get(word)
            if own is None:
                own = buckets_of(word)
                if self.chosen is not None:
                    own = [self.chosen[b] for b in own if b in self.chosen]
                # Most words have no chosen bucket: they share one empty tuple.
                own = tuple(own)
                known[word] = own
            if own:
                found.update(own)
        return sorted(found)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int = SAMPLE) -> DataFrame:
    """text and y of labelled documents outside the held-out fold; about `sample` at most, chosen by their id."""
    known, _ = _known(labels, label, folds, held_out, sample)
    # A bounded number of narrow rows: the texts needn't be shuffled.
    return docs.select("doc_id", "text").join(F.broadcast(known.where("drawn")), "doc_id").select("text", "y")


def all_labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int = SAMPLE) -> DataFrame:
    """text and y of all labelled documents outside the held-out fold, stored; `drawn` is true for those of `labelled`."""
    known, n = _known(labels, label, folds, held_out, sample)
    # The texts of documents without a label mostly stay where they are.
    docs = _maybe_known(docs.select("doc_id", "text").where(F.col("doc_id").isNotNull()), known, n)
    sizes = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    known = stored(known.join(sizes, "doc_id"), "labels")
    # The number of labels has no bound: they are never broadcast, however few there are in a run.
    rows = join_by_group(docs, known.hint("merge"), "doc_id", "rows", docs.count()).where("y IS NOT NULL")
    return stored(rows.select("text", "y", "drawn"), "labelled")


def _maybe_known(docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """The documents whose id has a bit in common with one of the `n` known ids: all of these, and a few others.

    The bits travel as bitmaps of Spark's own size, MOST_BITMAPS at most.
    """
    bits = min(MOST_BITMAPS, max(1, n * BITS_PER_ID // BITMAP)) * BITMAP
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(bits))
    maps = known.select(place.alias("_bit")).groupBy(F.floor(F.col("_bit") / BITMAP).alias("_map"))
    maps = stored(maps.agg(F.bitmap_construct_agg((F.col("_bit") % BITMAP).cast("int")).alias("_bits")), "bitmaps")
    rows = docs.withColumn("_bit", place).withColumn("_of", F.floor(F.col("_bit") / BITMAP))
    rows = rows.join(F.broadcast(maps), F.col("_of") == F.col("_map"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast((_bit % {BITMAP}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return rows.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0).select(*docs.columns)


def _known(labels: DataFrame, label: str, folds: int, held_out: int, sample: int) -> tuple[DataFrame, int]:
    """doc_id, y and drawn of the labels, and how many there are."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).alias("y")).where(fold("doc_id", folds) != held_out)
    n = known.count()
    share = min(1.0, sample / max(1, n))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))
    return known.withColumn("drawn", drawn), n


def fit(rows: DataFrame, counted: DataFrame | None = None) -> Machine:
    """Fits the machine on text and y (0 or 1); its buckets are chosen by the rows of `counted`, if there are any."""
    counted = rows if counted is None else counted

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, n = _Terms(None), np.zeros((2, BUCKETS), dtype=np.int64)
        for frame in frames:
            for text, y in zip(frame["text"], frame["y"]):
                n[int(y > 0), terms(text)] += 1
        yield from _used(n)

    sizes = {r["y"]: r["n"] for r in counted.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    zeros, ones = sizes.get(False, 0), sizes.get(True, 0)
    if not zeros or not ones:
        share = ones / max(1, zeros + ones)
        return Machine({}, _logit(share), np.zeros(0), np.zeros((0, FACTORS)))
    counts = counted.mapInPandas(count, "bucket long, n0 long, n1 long")
    counts = counts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    best = counts.withColumn("g2", _g2(zeros, ones)).where(F.col("g2") >= LEAST_G2)
    best = best.orderBy(F.desc("g2"), "bucket").limit(CHOSEN).collect()
    buckets = {r["bucket"]: i for i, r in enumerate(best)}
    for bucket in _partners(counted, buckets):
        buckets[bucket] = len(buckets)

    def design(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = _Terms(buckets)
        for frame in frames:
            held = [np.array(terms(t), dtype=">i4").tobytes() for t in frame["text"]]
            yield pd.DataFrame({"held": held, "y": (frame["y"] > 0).astype("int32")})

    # Equal rows are counted, so what comes to the driver is at most the sample, and mostly far less.
    data = rows.mapInPandas(design, "held binary, y int").groupBy("held", "y").agg(F.count("*").alias("n"))
    data = sorted((bytes(r["held"]), r["y"], r["n"]) for r in data.toLocalIterator())
    return _descend([(np.frombuffer(h, dtype=">i4"), y, n) for h, y, n in data], buckets, _logit(ones / (zeros + ones)))


def _used(n: np.ndarray) -> Iterator[pd.DataFrame]:
    """The counts of the buckets that were met, some at a time."""
    used = np.flatnonzero(n.any(axis=0))
    for a in range(0, len(used), ROWS_OUT):
        at = used[a : a + ROWS_OUT]
        yield pd.DataFrame({"bucket": at, "n0": n[0, at], "n1": n[1, at]})


def _partners(rows: DataFrame, buckets: dict[int, int]) -> list[int]:
    """Buckets that tell something among the documents with one of the best buckets, or with any chosen one."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, held, size = _Terms(None), ([], []), 0
        for frame in frames:
            for text, y in zip(frame["text"], frame["y"]):
                own = terms(text)
                found = [buckets[b] for b in own if b in buckets]
                if found:
                    # Chosen buckets need no partner's place; the last place counts the documents themselves.
                    own = np.array([*(b for b in own if b not in buckets), BUCKETS], dtype=np.int32)
                    for a in [ANCHORS, *(i for i in found if i < ANCHORS)]:
                        held[int(y > 0)].append(own * PLACES + a)
                        size += len(own)
                if size > HELD_PAIRS:
                    yield _packed(held)
                    held, size = ([], []), 0
        yield _packed(held)

    # Sums leave a task packed by slices of buckets, and are added up slice by slice.
    sums = rows.mapInPandas(count, "slice int, y int, pairs binary, counts binary").repartition(SLICES, "slice").sortWithinPartitions("slice")
    counts = stored(sums.mapInPandas(_added, "anchor int, bucket long, n0 long, n1 long"), "partners")
    sizes = counts.where(F.col("bucket") == BUCKETS).select("anchor", F.col("n0").alias("zeros"), F.col("n1").alias("ones"))
    told = counts.where(F.col("bucket") != BUCKETS).join(F.broadcast(sizes), "anchor")
    told = told.withColumn("g2", _g2(F.col("zeros"), F.col("ones"))).where(F.col("g2") >= LEAST_G2)
    chosen = F.broadcast(rows.sparkSession.createDataFrame([(b,) for b in buckets], "bucket long"))
    told = told.groupBy("bucket").agg(F.max("g2").alias("g2")).join(chosen, "bucket", "left_anti")
    return [r["bucket"] for r in told.orderBy(F.desc("g2"), "bucket").limit(PARTNERS).collect()]


def _packed(held: tuple[list, list]) -> pd.DataFrame:
    """Counts of distinct pairs (bucket * PLACES + anchor) of each label by slices of pairs: the ascending pairs as differences."""
    rows = []
    for y, parts in enumerate(held):
        if parts:
            pairs, n = np.unique(np.concatenate(parts), return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(SLICES + 1) * SLICE)
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[i], cuts[i + 1])
                rows.append((i, y, _small(np.diff(pairs[own], prepend=i * SLICE)), _small(n[own])))
    return pd.DataFrame(rows, columns=["slice", "y", "pairs", "counts"])


def _small(x: np.ndarray) -> bytes:
    """Numbers from 0 to 2^31 in one byte each; those from 255 on have their four bytes behind all of them."""
    large = x >= 255
    return len(x).to_bytes(4, "little") + np.where(large, 255, x).astype(np.uint8).tobytes() + x[large].astype("<i4").tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    out = np.frombuffer(raw, dtype=np.uint8, count=n, offset=4).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, dtype="<i4", offset=4 + n)
    return out


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The counts of all pairs, for packed rows in the order of slices; a slice has a place for each of its pairs."""
    slice_, total = None, None
    for frame in frames:
        for i, y, pairs, counts in zip(frame["slice"], frame["y"], frame["pairs"], frame["counts"]):
            if i != slice_:
                yield from _rows_of(slice_, total)
                slice_, total = i, np.zeros((2, SLICE), dtype=np.int64)
            total[y, np.cumsum(_numbers(pairs))] += _numbers(counts)
    yield from _rows_of(slice_, total)


def _rows_of(slice_: int | None, total: np.ndarray | None) -> Iterator[pd.DataFrame]:
    met = np.flatnonzero(total.any(axis=0)) if total is not None else ()
    for a in range(0, len(met), ROWS_OUT):
        at = met[a : a + ROWS_OUT]
        pairs = slice_ * SLICE + at
        yield pd.DataFrame({"anchor": (pairs % PLACES).astype("int32"), "bucket": pairs // PLACES, "n0": total[0, at], "n1": total[1, at]})


def _g2(zeros, ones):
    """How far the shares of label 1 differ between documents with and without the bucket."""
    total = zeros + ones
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    n0, n1, n = F.col("n0"), F.col("n1"), F.col("n0") + F.col("n1")
    with_ = part(n0, n * zeros / total) + part(n1, n * ones / total)
    without = part(zeros - n0, (total - n) * zeros / total) + part(ones - n1, (total - n) * ones / total)
    return 2 * (with_ + without)


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _descend(data: list[tuple[np.ndarray, int, int]], buckets: dict[int, int], bias: float) -> Machine:
    """Adaptive gradient descent on the weighted logistic loss."""
    n, rng = len(buckets), np.random.default_rng(0)
    w, v = np.zeros(n), rng.normal(0, 0.05, (n, FACTORS))
    gw, gv, gb = np.full(n, 1e-2), np.full((n, FACTORS), 1e-2), 1e-2
    # All rows' buckets one after another: a batch costs as much as its rows hold, however long one of them is.
    held = np.concatenate([d[0] for d in data]).astype(np.int64) if data else np.zeros(0, dtype=np.int64)
    sizes = np.array([len(d[0]) for d in data])
    ends = np.cumsum(sizes)
    ys, counts = np.array([d[1] for d in data]), np.array([d[2] for d in data], dtype=float)
    for _ in range(max(EPOCHS, STEPS // max(1, -(-len(data) // BATCH)))):
        order = rng.permutation(len(data))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            size = sizes[rows]
            until = np.cumsum(size)
            flat = held[np.arange(until[-1]) + np.repeat((ends - sizes)[rows] - until + size, size)]
            row = np.repeat(np.arange(len(rows)), size)
            vs = v[flat]
            total = lambda x: np.bincount(row, weights=x, minlength=len(rows))  # noqa: B023, E731
            sums = np.column_stack([total(vs[:, f]) for f in range(FACTORS)])
            z = bias + total(w[flat]) + 0.5 * ((sums**2).sum(axis=1) - total((vs**2).sum(axis=1)))
            weight = counts[rows]
            slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - ys[rows]) / weight.sum()
            touched, at = np.unique(flat, return_inverse=True)
            steep = slope[row]
            dw = np.bincount(at, weights=steep, minlength=len(touched)) + DECAY * w[touched]
            pull = steep[:, None] * (sums[row] - vs)
            dv = np.column_stack([np.bincount(at, weights=pull[:, f], minlength=len(touched)) for f in range(FACTORS)])
            # Counts of nothing are integers.
            dv = dv + DECAY * v[touched]
            gw[touched] += dw**2
            gv[touched] += dv**2
            gb += slope.sum() ** 2
            w[touched] -= RATE * dw / np.sqrt(gw[touched])
            v[touched] -= RATE * dv / np.sqrt(gv[touched])
            bias -= RATE * slope.sum() / math.sqrt(gb)
    return Machine(buckets, float(bias), w, v)


def with_score(docs: DataFrame, machine: Machine, name: str = "score", text: str = "text") -> DataFrame:
    """The documents with a score from 0 to 1 of their text in column `name`; `text` may be a field of a column."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = _Terms(machine.buckets)
        for batch in texts:
            out = np.empty(len(batch))
            for i, text in enumerate(batch):
                held = terms(text)
                v = machine.factors[held]
                z = machine.bias + machine.weights[held].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v**2).sum())
                out[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            yield pd.Series(out)

    return docs.withColumn(name, score(F.col(text)))


def fit_on_labels(spark: SparkSession, sf: str, docs: DataFrame) -> Machine:
    rows = all_labelled(docs, table(spark, sf, "labels"), "toxic", 4, 2)
    return fit(rows.where("drawn"), rows)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = with_score(docs.select("doc_id", "text"), fit_on_labels(spark, sf, docs))
    return scored.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
