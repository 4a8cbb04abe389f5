"""Vector codes: integer vectors cut into parts, each part replaced by the number of its nearest codebook entry.

Distances are exact. Integers are broken into limbs so small that a matrix product of two limbs stays below 2^53 and
float64 BLAS computes it without rounding; the products are put together again in int64, where a distance that fits is
exact whatever wraps on the way, and the nearest entry is the first argmin. Rows or entries too large for that take the
same limbs and are put together in Python integers. Every round is one pass in which each task sums the parts of each
entry; only those sums, entries x components of them, reach the driver.

Defined results: rows whose vector is null or holds a null, NaN or infinite component take no part. Shorter vectors count as
padded with zeros up to the longest one, and that up to a multiple of the number of parts; an empty vector counts as zeros.
The first entries come from the smallest ids (no id: last), rows with one id by their vectors; repeated rows count each
time. With fewer rows than entries there are as many entries as rows, without rows none. An error that no long holds is null.
Of the columns only the named ones are read, so others may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_by_group, query, stored, table

#: Rows with larger integers are put together in Python integers.
NARROW = 1 << 28
#: Sums travel in pieces of so many bits.
SUM_BITS = 32


@dataclass(frozen=True)
class Codebooks:
    """`entries[part][entry]` holds integer components; a component x of a vector counts as floor(scale * x)."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]
    scale: int
    width: int

    def digest(self) -> str:
        """SHA-256 of all components as decimal numbers, by part, entry and position."""
        numbers = (str(c) for part in self.entries for entry in part for c in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def usable(vector: str) -> Column:
    """Whether a vector holds finite components only."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf))
    return F.coalesce(fine, F.lit(False))


def limbs(values: np.ndarray) -> tuple[list[np.ndarray], int]:
    """`values` as floats whose weighted sum they are, lowest first, and the bits of a limb; all but the last are >= 0."""
    bits = (53 - max(1, values.shape[1] - 1).bit_length()) // 2
    out, rest = [], values
    while rest.size and max(int(rest.max()), -int(rest.min())) >= 1 << bits:
        out.append((rest & ((1 << bits) - 1)).astype(float))
        rest = rest >> bits
    return [*out, rest.astype(float)], bits


def dot_products(x: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products of the rows of x and c: in int64, modulo 2^64, or in Python integers."""
    (left, bits), (right, _) = limbs(x), limbs(c)
    out = np.zeros((len(x), len(c)), dtype=object if wide else np.int64)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            shift = bits * (i + j)
            if wide:
                out += (a @ b.T).astype(np.int64).astype(object) << shift
            elif shift < 64:
                out += (a @ b.T).astype(np.int64) << np.int64(shift)
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest row of c for every row of x, and its squared distance."""
    if not x.shape[1] or not len(x):
        return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    reach = sum(max(int(m.max()), -int(m.min())) for m in (x, c))
    wide = x.shape[1] * reach * reach >= 1 << 63
    if wide:
        x, c = x.astype(object), c.astype(object)
    else:
        x, c = x.astype(np.int64), c.astype(np.int64)
    d = (x * x).sum(axis=1)[:, None] - 2 * dot_products(x, c, wide) + (c * c).sum(axis=1)[None, :]
    code = np.argmin(d, axis=1)
    return code, d[np.arange(len(d)), code]


def _whole(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def integers(vectors: pa.Array, scale: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of small integers and their places, and the places of the other rows; see `large_integers`."""
    offsets = np.asarray(vectors.offsets).astype(np.int64)
    sizes = np.diff(offsets)
    flat = np.asarray(vectors.values).astype(float)[offsets[0] : offsets[-1]]
    x = np.zeros((len(vectors), width))
    x[np.repeat(np.arange(len(vectors)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    narrow = (np.abs(v) < NARROW).all(axis=1)
    return v[narrow].astype(np.int64), np.flatnonzero(narrow), np.flatnonzero(~narrow)


def large_integers(vectors: pa.Array, places: np.ndarray, scale: int, width: int) -> np.ndarray:
    out = np.zeros((len(places), width), dtype=object)
    for i, at in enumerate(places.tolist()):
        found = [_whole(x, scale) for x in vectors[at].as_py()]
        out[i, : len(found)] = found
    return out


def _groups(batch: pa.RecordBatch, vector: str, scale: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Integer rows of a batch with their places: the small ones, then the large ones if there are any."""
    vectors = batch.column(vector)
    small, at, rest = integers(vectors, scale, width)
    yield small, at
    if len(rest):
        yield large_integers(vectors, rest, scale, width), rest


def _arrays(books: Codebooks) -> list[np.ndarray]:
    return [np.array(part, dtype=object).reshape(len(part), -1) for part in books.entries]


def _refined(rows: DataFrame, books: Codebooks, vector: str) -> Codebooks:
    """Every entry moved to the floored mean of the parts it is nearest to."""
    scale, width, step = books.scale, books.width, books.width // len(books.entries)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(part), step + 1), dtype=object) for part in books.entries]
        tables = _arrays(books)
        for batch in batches:
            for x, _ in _groups(batch, vector, scale, width):
                for p, c in enumerate(tables):
                    part = x[:, p * step : (p + 1) * step]
                    code, _ = nearest(part, c)
                    ones = np.ones((len(x), 1), dtype=part.dtype)
                    mine = code[None, :] == np.arange(len(c))[:, None]
                    both = np.hstack([part, ones])
                    if x.dtype == object:
                        for i, e in enumerate(code.tolist()):
                            total[p][e] += both[i]
                    else:  # Below 2^28 x 2^24 rows of a batch: exact in float64.
                        total[p] += (mine.astype(float) @ both.astype(float)).astype(np.int64).astype(object)
        out = []
        for p, t in enumerate(total):
            for (e, i), amount in np.ndenumerate(t):
                limb = 0
                while amount and t[e, -1]:
                    last = -(1 << SUM_BITS) < amount < 1 << SUM_BITS
                    out.append((p, e, i, limb, amount if last else amount & ((1 << SUM_BITS) - 1)))
                    amount, limb = 0 if last else amount >> SUM_BITS, limb + 1
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], ["part", "entry", "position", "limb", "amount"])

    found = rows.select(vector).mapInArrow(sums, "part long, entry long, position long, limb long, amount long")
    found = found.groupBy("part", "entry", "position", "limb").agg(F.sum("amount").alias("amount")).collect()
    total = [np.zeros((len(part), step + 1), dtype=object) for part in books.entries]
    for r in found:
        total[r["part"]][r["entry"], r["position"]] += r["amount"] << (SUM_BITS * r["limb"])
    moved = [
        tuple(tuple(int(a) // int(t[-1]) for a in t[:-1]) if t[-1] else entry for entry, t in zip(part, sums_of))
        for part, sums_of in zip(books.entries, total)
    ]
    return Codebooks(tuple(moved), scale, width)


def fit(rows: DataFrame, vector: str, order: str, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks of all usable rows: the parts of the first `entries` rows by `order`, refined `rounds` times.

    `rows` are read once for each round and should be stored.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    rows = rows.where(usable(vector))
    longest = rows.agg(F.max(F.size(vector))).first()[0] or 0
    step = -(-longest // parts)
    first = rows.select(F.col(vector).alias("v")).orderBy(F.col(order).asc_nulls_last(), vector).limit(entries).collect()
    whole = [[_whole(x, scale) for x in r["v"]] for r in first]
    whole = [v + [0] * (parts * step - len(v)) for v in whole]
    books = Codebooks(
        tuple(tuple(tuple(v[p * step : (p + 1) * step]) for v in whole) for p in range(parts)), scale, parts * step
    )
    for _ in range(rounds if whole else 0):
        books = _refined(rows, books, vector)
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str, keep: Sequence[str]) -> DataFrame:
    """`keep`, code and error of every usable row: the number of the nearest entry of each part as two hexadecimal
    digits, and the squared distances summed over the parts."""
    rows = rows.where(usable(vector))
    kept = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(vector).alias("v"))
    schema = ", ".join(f"k{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    scale, width, parts = books.scale, books.width, len(books.entries)
    step = width // parts
    names = [*[f"k{i}" for i in range(len(keep))], "code", "error"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _arrays(books)
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), dtype=np.uint8)
            errors = np.zeros(batch.num_rows, dtype=object)
            for x, at in _groups(batch, "v", scale, width):
                for p, c in enumerate(tables):
                    code, d = nearest(x[:, p * step : (p + 1) * step], c)
                    codes[at, p] = code
                    errors[at] += d.astype(object)
            digits = codes.tobytes().hex()
            text = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            fits = [int(e) if e < 1 << 63 else None for e in errors]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(text, type=pa.string()), pa.array(fits, type=pa.int64())], names
            )

    coded = kept.mapInArrow(assign, f"{schema}, code string, error long")
    return coded.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "code", "error")


def decode(code: Column, books: Codebooks) -> Column:
    """The components that a code stands for, divided by the scale."""
    parts = [
        F.element_at(
            F.array(*[F.array(*[F.lit(c / books.scale) for c in entry]) for entry in part]),
            F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") + 1,
        )
        for p, part in enumerate(books.entries)
    ]
    return F.concat(*parts)


def with_group_error(coded: DataFrame, label: str, out: str = "label_error") -> DataFrame:
    """The error summed over the rows with an equal label, nulls together; a label may hold most rows. `coded` is read twice."""
    # Written out: a null label and a label that reads like its stand-in stay apart.
    named = coded.withColumn("label_key", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    groups = named.groupBy("label_key").agg(F.try_sum("error").alias(out), F.count(F.lit(1)).alias("label_rows"))
    groups = stored(groups, "label-errors")
    total = groups.agg(F.coalesce(F.sum("label_rows"), F.lit(0))).first()[0]
    return join_by_group(named, groups, "label_key", "label_rows", total).drop("label_key")


def _sql() -> str:
    rounds = []
    for r in range(1, 8):
        rounds.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, part, min(d * 16 + entry) % 16 AS entry, min(d * 16 + entry) // 16 AS d FROM (
    SELECT vec_id, part, entry, CAST(sum((v - c) * (v - c)) AS BIGINT) AS d FROM comp JOIN b{r - 1} USING (part, pos)
    GROUP BY vec_id, part, entry) GROUP BY vec_id, part)"""
        )
        if r < 7:
            rounds.append(
                f"""s{r} AS MATERIALIZED (
  SELECT part, entry, pos, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM comp JOIN a{r} USING (vec_id, part) GROUP BY part, entry, pos),
b{r} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM b{r - 1} LEFT JOIN s{r} USING (part, entry, pos))"""
            )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding, CAST(len(embedding) AS BIGINT) // 8 AS step FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comp AS MATERIALIZED (
  SELECT vec_id, (i - 1) // step AS part, (i - 1) % step AS pos, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT vec_id, step, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), first AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16
), b0 AS MATERIALIZED (
  SELECT part, entry, pos, v AS c FROM comp JOIN first USING (vec_id)
), {", ".join(rounds)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a7 GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b6) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


@query("op11_vector_codes", _sql())
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    rows = stored(rows.where(usable("embedding")), "vectors")
    books = fit(rows, "embedding", "vec_id")
    coded = stored(encode(rows, books, "embedding", ["vec_id", "label"]), "codes")
    return with_group_error(coded, "label").drop("label").withColumn("codebooks_sha256", F.lit(books.digest()))
