"""Resampling of documents towards a target distribution, by importance weights of hashed word runs.

Texts are pre-tokenised by an untrained Regex Split that returns words with offsets. Every run of one to three words is a
window from the offset of its first word to the end of its last one, and the CRC-32 of the window's bytes names its bucket.
The checksum of a window follows from those of its words (a checksum moves over the bytes behind it by a linear map), so
words are hashed once and windows by table look-ups over whole stretches of text. One pass counts the buckets of all
documents, another those of the target; a bucket's gain compares both, and a second pass over the documents sums the gains
of each. Gumbel noise by the digest of the id turns weights into scores, and the highest scores are drawn.

Only the bucket counts, 10,000 numbers by default, reach the driver and the tasks. Ranks come from ranges of the sorted scores
with one row count each, so no task holds more than a range.

Defined results: a null or empty text has no words, no features and weight 0. A null id counts as the empty text in the
digest and comes last among ties. Repeated rows are documents of their own; equal ids have equal noise, ties between them go by
weight and features. Texts of any length are taken whole; those above a stretch are cut between words, and windows that
reach over a cut count once. No documents: no rows; no target: its counts are 0. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from tidemark.llm.common import WORD, lowered, numbered_words, query, stored, stretches, table, word_pieces
from tidemark.session import shuffle_tasks

BUCKETS, RUN = 10_000, 3
#: Bytes of text that are worked on together; segments that are split by one call.
STRETCH, SPLIT_TOGETHER = 8 << 20, 256
#: Checksums move over so many bytes by one look-up; rows of a range that are ranked together.
SHIFTED, RANGE_ROWS = 64, 1_000_000


@cache
def _splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def split_segments(segments: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of all segments and how many each has. Many segments are split by one call, and offsets tell whose a word is."""
    words: list[str] = []
    counts = np.zeros(len(segments), dtype=np.int64)
    for i in range(0, len(segments), SPLIT_TOGETHER):
        some = segments[i : i + SPLIT_TOGETHER]
        ends = np.cumsum([len(s) + 1 for s in some])
        found = _splitter().pre_tokenize_str("\n".join(some))
        if found:
            texts, spans = zip(*found)
            words += texts
            whose = np.searchsorted(ends, [at for at, _ in spans], side="right")
            counts[i : i + len(some)] = np.bincount(whose, minlength=len(some))
    return words, counts


@cache
def _shift_tables() -> np.ndarray:
    """By length and byte of a checksum: what it is after so many more zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1)).astype(np.uint32)
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], dtype=np.uint32)[:, None]
    out = [now]
    for _ in range(SHIFTED):
        now = (now >> np.uint32(8)) ^ step[now & 255]
        out.append(now)
    return np.array(out)


def _moved(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums over `lengths` more bytes, before the bytes' own checksum is added."""
    tables = _shift_tables()
    near = np.minimum(lengths, SHIFTED)
    out = tables[near, 0, sums & 255]
    for b in (1, 2, 3):
        out ^= tables[near, b, (sums >> np.uint32(8 * b)) & 255]
    far = np.flatnonzero(lengths > SHIFTED)
    if len(far):
        out[far] = _moved(out[far], lengths[far] - SHIFTED)
    return out


def window_sums(words: list[str], numbers: np.ndarray, starts: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the places of their last words and the CRC-32 of the words joined by one space.

    `numbers` are words of texts one after another, `starts` the place in its text of every word.
    """
    coded = [w.encode() for w in words]
    own = np.array([zlib.crc32(w) for w in coded], dtype=np.uint32)[numbers]
    spaced = np.array([zlib.crc32(b" ", zlib.crc32(w)) for w in coded], dtype=np.uint32)[numbers]
    sizes = np.array([len(w) for w in coded], dtype=np.int64)[numbers]
    # Of the words before a place joined by spaces, with one more space behind them.
    before = None
    for k in range(1, longest + 1):
        at = np.flatnonzero(starts >= k - 1)
        if k == 1:
            yield at, own
            before = spaced
            continue
        lead = before[at - 1]
        yield at, _moved(lead, sizes[at]) ^ own[at]
        if k < longest:
            after = np.zeros_like(own)
            after[at] = _moved(lead, sizes[at] + 1) ^ spaced[at]
            before = after


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, pa.Array, int]]:
    """A stretch of rows, places in it, their texts, and how many words of the text came before; long texts in pieces."""
    for part in stretches(batches, "text", STRETCH):
        texts = lowered(part.column("text"))
        if part.num_rows > 1 or not part.num_rows or len(texts[0].as_py()) <= STRETCH:
            yield part, np.arange(part.num_rows), texts, 0
            continue
        last: list[str] = []
        for piece in word_pieces(texts[0].as_py(), STRETCH):
            yield part, np.zeros(1, dtype=np.int64), pa.array([" ".join(last) + " " + piece]), len(last)
            last = [*last, *re.findall(WORD, piece)][-(RUN - 1) :]


def _features(texts: pa.Array, known: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For runs of one, two and three words: the texts they are of and their checksums.

    Runs that end in the first `known` words of a text are left out.
    """
    words, lists = numbered_words(texts, split_segments)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    numbers = np.asarray(lists.values)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(numbers)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    for k, (at, sums) in enumerate(window_sums(words, numbers, place, RUN), 1):
        if known:
            new = place[at] >= known
            at, sums = at[new], sums[new]
        yield owner[at], sums, k


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, _, texts, known in _units(batches):
            for _, sums, _ in _features(texts, known):
                total += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    rows = texts.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the logarithm of smoothed shares, target over source."""
    s, t, b = float(source.sum()), float(target.sum()), len(source)
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in pairs], dtype=np.int64)


def digest_number(doc_id: str, seed: str = "42:") -> Column:
    """The first 8 hexadecimal digits of the SHA-256 of the seed and the id, as a number."""
    named = F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")


def _noise(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest_number(doc_id).alias("h"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    buckets = np.uint32(len(gain))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        for part, rows, texts, known in _units(batches):
            if part is not held:
                if held is not None:
                    yield _scored(held, sums)
                held, sums = part, np.zeros((3, part.num_rows), dtype=np.int64)
            for owner, crc, k in _features(texts, known):
                per = np.bincount(owner, minlength=len(rows))
                run = np.concatenate([[0], np.cumsum(gain[crc % buckets])])
                ends = np.cumsum(per)
                sums[0, rows] += per if k == 1 else 0
                sums[1, rows] += per
                sums[2, rows] += run[ends] - run[ends - per]
        if held is not None:
            yield _scored(held, sums)

    def _scored(part: pa.Table, sums: np.ndarray) -> pa.RecordBatch:
        noise = [_noise(h) for h in part.column("h").to_pylist()]
        columns = [part.column("doc_id").combine_chunks(), *map(pa.array, sums), pa.array(sums[2] + np.array(noise, dtype=np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, order: Sequence[Column], drawn: int, total: int) -> DataFrame:
    """`rank` 1, 2, 3, ... of the first `drawn` of `total` rows by `order`, null for the others; all rows come back."""
    if not drawn:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    spark = rows.sparkSession
    # Rows that are alike in all of `order` are told apart by a random number, so that no range holds them all.
    rows = rows.withColumn("_tie", F.rand(0))
    ranges = max(shuffle_tasks(spark), -(-total // RANGE_ROWS))
    parts = rows.repartitionByRange(ranges, *order, F.col("_tie")).withColumn("_range", F.spark_partition_id())
    parts = stored(parts, "ranges")
    sizes = {r["_range"]: r["n"] for r in parts.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for k in sorted(sizes):
        if before < drawn:
            starts.append((k, before))
        before += sizes[k]
    last = starts[-1][0]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_tie"))
    starts = F.broadcast(spark.createDataFrame(starts, "_range int, _before long"))
    near = parts.join(starts, "_range").withColumn("rank", F.col("_before") + place).drop("_before")
    near = near.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    far = parts.where(F.col("_range") > last).withColumn("rank", F.lit(None).cast("long"))
    return near.unionByName(far).drop("_tie", "_range")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank: the `percent` of the documents with at least `least_words`
    words that have the highest scores are drawn. `docs` are read twice."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = stored(score(docs, gain), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    total = able.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(able, order, percent * total // 100, total).unionByName(others)


SQL_WORDS = """
  SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}
"""
SQL_RUNS = """
  unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f
"""
# The checksum bit by bit: every byte is added and followed by eight steps of the polynomial, the entries of -1.
SQL_RESAMPLING = f"""
WITH d AS MATERIALIZED ({SQL_WORDS.format(id="doc_id", table="documents")}), df AS MATERIALIZED (SELECT doc_id, {SQL_RUNS} FROM d),
bf AS MATERIALIZED (SELECT {SQL_RUNS} FROM ({SQL_WORDS.format(id="item_id", table="benchmark")})),
h AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
k AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(1, len(h), 2), lambda i:
    [(instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) % 10000 AS b FROM h
), s AS (SELECT b, count(*) AS s FROM df JOIN k USING (f) GROUP BY b), t AS (SELECT b, count(*) AS t FROM bf JOIN k USING (f) GROUP BY b),
g AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM df) + 10000.0::DOUBLE)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bf) + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (b)
), w AS (
  SELECT doc_id, len(w) AS n, greatest(3 * len(w) - 3, CASE len(w) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END) AS n_features,
    CAST(concat('0x', substr(sha256(concat('42:', doc_id)), 1, 8)) AS BIGINT) AS h FROM d
), z AS (
  SELECT w.doc_id, n, n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN k USING (f) JOIN g USING (b) GROUP BY doc_id) USING (doc_id)
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n >= 20
  QUALIFY rank <= 5 * (SELECT count(*) FROM z WHERE n >= 20) // 100
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, rank FROM z LEFT JOIN r USING (doc_id)
"""


@query("op13_resampling", SQL_RESAMPLING)
def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("n_words")
