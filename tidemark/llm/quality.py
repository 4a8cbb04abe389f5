"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over binned figures of the whole text (symbols, repetition, case, lines, ...) gives each document its
evidence. Grouped sums of that evidence over all documents give the shares of good documents of each host and of each path
below a host. Shares of sparse paths are shrunk toward their host, those of sparse hosts toward all documents; how far
follows from how much the groups differ (method of moments). A document's posterior joins its own evidence with its path's
share, from which the document itself is left out.

Defined results: a null or empty text has figures of its own (all zero) and is judged by them. A null host or path is a
group of its own. Null labels take no part; of several labels of a document the largest counts. Without labels of both kinds
the evidence is the share of good labels (1 without labels, so nothing is rejected). Rows with equal ids count each. All
columns are kept; the result's columns replace columns of those names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fold, join_by_group, query, stored, table
from tidemark.llm.toxicity import labelled

#: Labelled documents used for fitting, in expectation; all labels are used while there are fewer.
SAMPLE = 20_000
#: Bins of a figure, steps of Newton's method, and the weight of the prior on the coefficients.
BINS, STEPS, RIDGE = 12, 15, 1.0
#: Documents below this posterior are rejected.
THRESHOLD = 0.3
#: Evidence of one document counts within these bounds.
FLOOR = 1e-4

_KIND = np.zeros(256, dtype=np.int64)
_KIND[[*range(65, 91)]] = 1  # capitals
_KIND[[*range(97, 123), *range(128, 256)]] = 2  # small letters, other scripts
_KIND[[*range(48, 58)]] = 3  # digits
_KIND[[9, 10, 11, 12, 13, 32]] = 4  # white space
_KIND[[44, 46, 59, 58, 63, 39, 34, 45]] = 5  # ordinary punctuation
# The rest are symbols: kind 0.


def figures(text: str | None) -> list[float]:
    """What the classifier sees of a text."""
    raw = (text or "").encode(errors="replace")
    if not raw:
        return [0.0] * 12
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=6)
    n = len(raw)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    w = max(1, len(words))
    shares = counts[counts > 0] / n
    distinct = len(set(words))
    return [
        math.log(n),
        kinds[0] / n,
        kinds[1] / n,
        kinds[3] / n,
        kinds[5] / n,
        kinds[4] / n,
        float(-(shares * np.log2(shares)).sum()),
        distinct / w,
        math.log(w / max(1, distinct)),
        sum(map(eq, words, words[1:])) / w,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(x) < 4 for x in words) / w,
    ]


@dataclass(frozen=True)
class Classifier:
    """Coefficients of the bins of each figure."""

    edges: list[np.ndarray]
    coefficients: list[np.ndarray]
    bias: float

    def evidence(self, texts: pd.Series) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        if self.edges and len(texts):
            x = np.array([figures(t) for t in texts])
            for j, (edges, c) in enumerate(zip(self.edges, self.coefficients)):
                z += c[np.searchsorted(edges, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: DataFrame) -> Classifier:
    """Fits the classifier on text and y (1: good); the figures of the sample, not its texts, come to the driver."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def seen(texts: pd.Series) -> pd.Series:
        return texts.map(figures)

    data = rows.select(seen("text").alias("x"), (F.col("y") > 0).cast("int").alias("y")).collect()
    y = np.array([r["y"] for r in data], dtype=float)
    if not len(y) or y.min() == y.max():
        return Classifier([], [], 10.0 if not len(y) or y.min() == 1 else -10.0)
    x = np.array([r["x"] for r in data])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
    starts = np.cumsum([0, *(len(e) + 1 for e in edges)])
    design = np.zeros((len(y), starts[-1] + 1))
    design[:, -1] = 1
    for s, b in zip(starts, bins):
        design[np.arange(len(y)), s + b] = 1
    ridge = np.full(design.shape[1], RIDGE)
    ridge[-1] = 1e-6
    beta = np.zeros(design.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design.T * np.maximum(p * (1 - p), 1e-6)) @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(edges, [beta[a:b] for a, b in zip(starts, starts[1:])], float(beta[-1]))


def _strength(mean: float, variance: float | None) -> float:
    """How many documents the share of the level above is worth: large where groups hardly differ."""
    if not variance or variance <= 0 or not 0 < mean < 1:
        return 1e4
    return min(1e4, max(1.0, mean * (1 - mean) / variance - 1))


def path_shares(rows: DataFrame) -> tuple[DataFrame, int, float]:
    """Shares of good documents from host, path and p of all documents: one row per path; all documents and their share.

    group, n, members (n again), own (sum of p), host_share (shrunk) and strength (of the host's share within its paths).
    """
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("own"))
    paths = stored(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("own").alias("ho"))
    total = hosts.agg(F.sum("hn"), F.sum("ho"), _spread("hn", "ho")).first()
    n, mean = total[0] or 0, (total[1] or 0.0) / max(1, total[0] or 0)
    above = _strength(mean, total[2])
    host_share = (F.col("ho") + F.lit(above * mean)) / (F.col("hn") + F.lit(above))
    hosts = hosts.select(F.col("host").alias("_host"), host_share.alias("host_share"))
    within = _strength(mean, paths.agg(_spread("n", "own")).first()[0])
    paths = paths.join(hosts, F.col("host") == F.col("_host")).select(
        F.concat_ws("\u0001", "host", "path").alias("group"), "n", F.col("n").alias("members"), "own", "host_share", F.lit(within).alias("strength")
    )
    return stored(paths, "shares"), n, mean


def _spread(n: str, own: str) -> Column:
    """Variance of the groups' true shares: each weighted by its documents, without what chance adds."""
    share, weight = F.col(own) / F.col(n), F.col(n)
    mean = F.sum(weight * share) / F.sum(weight)
    return F.sum(weight * share * share) / F.sum(weight) - mean * mean - F.sum(share * (1 - share)) / F.sum(weight)


def judge(docs: DataFrame, classifier: Classifier, host: Column, path: Column) -> DataFrame:
    """The documents with evidence (the classifier's), share (of the path, without the document) and posterior."""

    @F.pandas_udf(T.DoubleType())
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(classifier.evidence(batch)).clip(FLOOR, 1 - FLOOR)

    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))  # noqa: E731  null differs from empty
    docs = docs.drop("evidence", "share", "posterior")
    rows = docs.select(part(host).alias("host"), part(path).alias("path"), evidence("text").alias("p"))
    shares, total, mean = path_shares(rows)
    group = F.concat_ws("\u0001", part(host), part(path)).alias("group")
    # The document travels as one column, whatever its own columns are called.
    rows = join_by_group(docs.select(F.struct("*").alias("doc"), evidence("text").alias("p"), group), shares, "group", "n", total)
    others = F.col("own") - F.col("p") + F.col("strength") * F.col("host_share")
    share = others / (F.col("members") - 1 + F.col("strength"))
    share = F.least(F.greatest(share, F.lit(FLOOR)), F.lit(1 - FLOOR))
    shift = _log_odds(F.col("share")) - math.log(min(max(mean, FLOOR), 1 - FLOOR) / (1 - min(max(mean, FLOOR), 1 - FLOOR)))
    rows = rows.withColumn("share", share)
    return rows.select("doc.*", F.col("p").alias("evidence"), "share", (1 / (1 + F.exp(-_log_odds(F.col("p")) - shift))).alias("posterior"))


def _log_odds(c: Column) -> Column:
    return F.log(c / (1 - c))


def fit_on_labels(spark: SparkSession, sf: str, docs: DataFrame) -> Classifier:
    return fit(labelled(docs, table(spark, sf, "labels"), "quality", 4, 2, SAMPLE))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The source is the host, the language the path below it."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    judged = judge(docs, fit_on_labels(spark, sf, docs), F.col("source"), F.col("lang"))
    return judged.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "evidence",
        "share",
        "posterior",
        (F.col("posterior") >= THRESHOLD).cast("int").alias("keep"),
    )
