"""Exact search for the k rows with the largest inner product, by columnar branch and bound.

Vectors are turned into integers. Queries are taken in blocks of bounded size; a block is sent to all tasks, and every task
reads its candidates once. A task keeps them column by column: products are accumulated one block of dimensions after
another, and after each block the pairs are compacted whose product can't reach the query's k-th best any more. What the
remaining dimensions can add is bounded by the product of the two remaining norms (Cauchy-Schwarz). A block of queries
starts with the k-th best of a bounded sample of rows, which is a lower bound and so never costs a result.

Vectors too long for products in int64 (norm of 2^31 and more) are searched without bounds, by exact products of limbs (see
codes); a frame without any pays nothing.

Defined results: vectors that are null, or hold a null or a value that isn't finite, take no part, nor do rows without id.
A product that no long holds counts as the nearest long. Shorter vectors count as padded with zeros, an empty one as zeros. Every other
row with the query's id is no candidate; a query that is repeated with the same vector is answered once, a candidate that
is repeated counts each time. Ties go to the smaller id. Fewer candidates than k: all of them. No rows: no results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.codes import dot_products
from tidemark.llm.common import query, table

#: Queries of a block on average, rows of the sample that the first bounds come from, dimensions of a block.
QUERY_BLOCK, SEED_ROWS, DIMENSION_BLOCK = 4096, 2048, 16
#: Pairs of a query and a candidate that are looked at together; above one survivor in DENSE, all of them are multiplied on.
PAIRS, DENSE = 1 << 21, 16
#: Vectors of a smaller norm have products below 2^62. Pairs of other vectors are looked at in blocks of so many rows a side.
LIMIT, WIDE_BLOCK = 2.0**31, 256
LARGEST = float(np.finfo(float).max)


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """id and v = floor(scale * component) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: _floored(F.lit(float(scale)) * x.cast("double")))
    found = rows.select(F.col(id_column).cast("long").alias("id"), v.alias("v"), F.col(vector).alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= LARGEST))
    return found.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))).select("id", "v")


def _floored(y: Column) -> Column:
    """The floor as a double; doubles of 2^53 and more are whole, and the type of floor doesn't hold them all."""
    held = F.least(F.greatest(y, F.lit(-LARGEST)), F.lit(LARGEST))
    return F.when(F.abs(y) >= 2.0**53, held).otherwise(F.floor(y).cast("double"))


def top_k(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: for every query the k rows with the largest inner product.

    Both frames hold id and v. Each block of queries is a pass over `rows`; the passes are united.
    """
    queries = queries.dropDuplicates(["id", "v"])
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    sample = queries.sparkSession.sparkContext.broadcast(_matrix(rows.limit(SEED_ROWS).collect()))

    def seed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            qid, q = frame["id"].to_numpy(), _columns(frame["v"].tolist())
            floor = np.full(len(qid), -np.inf)
            if len(qid):
                qi, _, s = _search(qid, q, floor, *sample.value, k)
                floor = _raise_floor(floor, qi, s, k)
            yield frame.assign(floor=floor)

    found = None
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
        part = _block_top_k(block.mapInPandas(seed, "id long, v array<double>, floor double").collect(), rows, k)
        found = part if found is None else found.union(part)
    best = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors as a matrix whose columns are the rows."""
    ids = np.array([r["id"] for r in rows], dtype=np.int64)
    return ids, _columns([r["v"] for r in rows])


def _columns(vectors: list) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((width, len(vectors)))
    lengths = {len(v) for v in vectors}
    if len(lengths) == 1 and width:
        out[:] = np.array(vectors, dtype=float).T
    else:
        for i, v in enumerate(vectors):
            out[: len(v), i] = v
    return out


def _widen(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, width - len(matrix)), (0, 0))) if len(matrix) < width else matrix


def _tail_norms(matrix: np.ndarray, starts: list[int]) -> np.ndarray:
    """For every start the norm of the dimensions from there on, rounded up."""
    squares = np.cumsum((matrix**2)[::-1], axis=0)[::-1]
    rows = [squares[s] if s < len(matrix) else np.zeros(matrix.shape[1]) for s in starts]
    return np.sqrt(np.array(rows).reshape(len(starts), -1)) * (1 + 1e-9)


def _products(q: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the columns of q with those of c; in integers where doubles could round."""
    if exact:
        return q.T @ c
    return (q.T.astype(np.int64) @ c.astype(np.int64)).astype(np.int64)


def _norms(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((matrix**2).sum(axis=0))


def _search(qid, q, floor, cid, c, k):
    """Pairs (query, candidate, score) that can be among the best k, floor being a known k-th best.

    Returns indexes of queries, indexes of candidates and scores.
    """
    width = max(len(q), len(c), 1)
    q, c = _widen(q, width), _widen(c, width)
    wide_q, wide_c = _norms(q) >= LIMIT, _norms(c) >= LIMIT
    if not wide_q.any() and not wide_c.any():
        return _bounded_search(qid, q, floor, cid, c, k)
    every, narrow = np.arange(len(qid)), np.flatnonzero(~wide_q)
    parts = [(narrow, np.flatnonzero(~wide_c), None), (every, np.flatnonzero(wide_c), _wide_search)]
    parts.append((np.flatnonzero(wide_q), np.flatnonzero(~wide_c), _wide_search))
    found = []
    for at_q, at_c, search in parts:
        if search is None:
            qi, ci, s = _bounded_search(qid[at_q], q[:, at_q], floor[at_q], cid[at_c], c[:, at_c], k)
        else:
            qi, ci, s = search(qid[at_q], q[:, at_q], cid[at_c], c[:, at_c], k)
        found.append((at_q[qi], at_c[ci], s))
    return _best(*[np.concatenate(x) for x in zip(*found)], cid, k)


def _best(qi, ci, s, cid, k):
    """Per query the best k: ties go to the smaller id."""
    order = np.lexsort((cid[ci], ~s, qi))
    qi, ci, s = qi[order], ci[order], s[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], ci[keep], s[keep]


def _wide_search(qid, q, cid, c, k):
    """All pairs in small blocks, their products exact and at most what a long holds; of each block the best k stay."""
    held = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    whole = lambda m: np.array([[int(x) for x in row] for row in m.T], dtype=object).reshape(m.shape[1], m.shape[0])
    for a in range(0, len(qid), WIDE_BLOCK):
        left = whole(q[:, a : a + WIDE_BLOCK])
        for b in range(0, len(cid), WIDE_BLOCK):
            right = whole(c[:, b : b + WIDE_BLOCK])
            s = np.clip(dot_products(left, right, True), -(1 << 63), (1 << 63) - 1).astype(np.int64)
            qi, ci = np.nonzero(qid[a : a + WIDE_BLOCK, None] != cid[None, b : b + WIDE_BLOCK])
            new = (qi + a, ci + b, s[qi, ci])
            held = _best(*[np.concatenate(x) for x in zip(held, new)], cid, k)
    return held


def _bounded_search(qid, q, floor, cid, c, k):
    """`_search` by bounds, block of dimensions by block."""
    width = len(q)
    starts = list(range(0, width, DIMENSION_BLOCK))
    ends = [min(s + DIMENSION_BLOCK, width) for s in starts]
    tq, tc = _tail_norms(q, ends), _tail_norms(c, ends)
    exact = (tq_all := np.sqrt((q**2).sum(0)).max(initial=0)) * np.sqrt((c**2).sum(0)).max(initial=0) < 2.0**52
    kind = float if exact else np.int64
    q, c = q.astype(kind), c.astype(kind)
    slack = 0 if exact else 1 + 1e-9 * float(tq_all) * float(tc.max(initial=0))
    qs, cs, scores = [], [], []
    step = max(1, PAIRS // max(1, c.shape[1]))
    for a in range(0, q.shape[1], step):
        block = q[:, a : a + step]
        partial = _products(block[: ends[0]], c[: ends[0]], exact)
        reach = partial + tq[0, a : a + step, None] * tc[0][None, :] + slack
        qi, ci = np.nonzero((reach >= floor[a : a + step, None]) & (qid[a : a + step, None] != cid[None, :]))
        s = partial[qi, ci]
        for n in range(1, len(starts)):
            d = slice(starts[n], ends[n])
            # The survivors' products of this block of dimensions: of all pairs while many survive, since columns of their own
            # would take as many numbers a pair as the block has dimensions.
            if len(qi) * DENSE > partial.size:
                s = s + _products(block[d], c[d], exact)[qi, ci]
            else:
                s = s + np.einsum("dp,dp->p", block[d][:, qi], c[d][:, ci])
            keep = s + tq[n, a + qi] * tc[n, ci] + slack >= floor[a + qi]
            if not keep.all():
                qi, ci, s = qi[keep], ci[keep], s[keep]
        qi = qi + a
        # Per query the best k: survivors are few, ties go to the smaller id.
        order = np.lexsort((cid[ci], -s, qi))
        qi, ci, s = qi[order], ci[order], s[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = place < k
        qs.append(qi[keep])
        cs.append(ci[keep])
        scores.append(s[keep].astype(np.int64))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (qs, cs, scores)]


def _raise_floor(floor: np.ndarray, qi: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """The k-th best of what one search found, where it found k."""
    last = np.flatnonzero(np.diff(np.append(qi, -1)) != 0)
    counts = np.bincount(qi, minlength=len(floor))
    full = last[counts[qi[last]] >= k] if len(last) else last
    out = floor.copy()
    out[qi[full]] = np.maximum(out[qi[full]], s[full])
    return out


def _block_top_k(block: list, rows: DataFrame, k: int) -> DataFrame:
    """The best k of a block of queries, with their first bounds, in every task."""
    floor = np.array([r["floor"] for r in block], dtype=float)
    sent = rows.sparkSession.sparkContext.broadcast((*_matrix(block), floor))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qid, q, floor = sent.value
        best = pd.DataFrame({"query": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        for frame in frames:
            if not len(qid) or not len(frame):
                continue
            cid = frame["id"].to_numpy()
            qi, ci, s = _search(qid, q, floor, cid, _columns(frame["v"].tolist()), k)
            best = pd.concat([best, pd.DataFrame({"query": qi, "vec_id": cid[ci], "score": s})])
            best = best.sort_values(["query", "score", "vec_id"], ascending=[True, False, True], kind="stable")
            best = best[best.groupby("query").cumcount() < k]
            floor = _raise_floor(floor, best["query"].to_numpy(), best["score"].to_numpy(), k)
        best["query_id"] = qid[best["query"].to_numpy(dtype=np.int64)] if len(qid) else best["query"]
        yield best[["query", "query_id", "vec_id", "score"]]

    return rows.mapInPandas(search, "query long, query_id long, vec_id long, score long")



SQL_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op2_topk", SQL_TOP)
def op2_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = integer_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", 64)
    return top_k(rows.where(F.col("id") % 20 == 0), rows, 20)
