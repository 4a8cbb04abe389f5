"""Byte-level BPE by merge replay over the distinct words of a stretch of the corpus.

Texts are cut into segments (see `segments`), segments into words by the vocabulary's pattern; each distinct word is held
once. An inverted index leads from a pair's rank to the positions where the pair stands; merges are replayed from the
lowest rank upwards, each at all its positions at once, and only the two neighbours of a merge get new entries. A merge may
open a pair of a lower rank, so ranks wait in a heap. Words don't touch, so this gives every word the merges it would get
alone.

Defined results: a null text is empty, an empty text has no tokens. Rows with equal ids stay apart. Whole texts are encoded,
however long. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import encode_by_segments, query, stretches, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes of text whose words are replayed together; a longer text is a stretch of its own. Rows sent back at once.
STRETCH, ROWS = 5 << 20, 500
NONE = -1


class Vocabulary:
    """The ranks of a vocabulary file and the pairs that make them."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.base = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[p] for p in self.pairs.tolist()], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, NONE where they don't merge."""
        if not len(self.pairs):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """What each id stands for."""
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _distinct(positions: np.ndarray) -> np.ndarray:
    positions = np.sort(positions)
    return positions[np.append(True, positions[1:] != positions[:-1])] if len(positions) else positions


def replay(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """The token ids of every word, as 4-byte integers."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(sizes)
    # One stretch has far fewer than 2^31 bytes of distinct words, or one text is larger than a row can be.
    token = v.base[np.frombuffer(b"".join(words), dtype=np.uint8)].astype(np.int32)
    n = len(token)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    after[ends[sizes > 0] - 1] = NONE
    before[(ends - sizes)[sizes > 0]] = NONE
    alive = np.ones(n, bool)

    # The inverted index: for each rank the positions of the pair's left token.
    left = np.flatnonzero(after != NONE)
    rank = v.rank(token[left], token[left + 1])
    left, rank = left[rank != NONE], rank[rank != NONE]
    order = np.argsort(rank, kind="stable")
    left, rank = left[order], rank[order]
    found, first = np.unique(rank, return_index=True)
    index = {r: [p] for r, p in zip(found.tolist(), np.split(left, first[1:]))} if len(found) else {}
    waiting = list(index)
    heapify(waiting)

    def enter(positions: np.ndarray) -> None:
        rank = v.rank(token[positions], token[after[positions]])
        positions, rank = positions[rank != NONE], rank[rank != NONE]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, p in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
            if r in index:
                index[r].append(p)
            else:
                index[r] = [p]
                heappush(waiting, r)

    while waiting:
        r = heappop(waiting)
        entries = index.pop(r)
        at = _distinct(entries[0] if len(entries) == 1 else np.concatenate(entries))
        at = at[alive[at]]
        at = at[after[at] != NONE]
        at = at[v.rank(token[at], token[after[at]]) == r]
        right = after[at]
        if len(at) > 1 and (right[:-1] == at[1:]).any():  # a run such as "aaa": from the left, without overlap
            keep, taken = np.ones(len(at), bool), NONE
            for i, (a, b) in enumerate(zip(at.tolist(), right.tolist())):
                keep[i] = a != taken
                if keep[i]:
                    taken = b
            at, right = at[keep], right[keep]
        if not len(at):
            continue
        token[at] = r
        alive[right] = False
        far = after[right]
        after[at] = far
        linked = far != NONE
        before[far[linked]] = at[linked]
        near = before[at]
        near = near[near != NONE]
        enter(_distinct(np.concatenate([near, at[linked]])))

    kept = 4 * np.concatenate([[0], np.cumsum(alive)])
    ids = token[alive].astype(np.int32).tobytes()
    return [ids[a:b] for a, b in zip(kept[ends - sizes].tolist(), kept[ends].tolist())]


class _Words:
    """Ids of segments; words of earlier stretches are looked up while there is room for them."""

    def __init__(self, v: Vocabulary, most: int = 1 << 17):
        self.v, self.most, self.known = v, most, {}

    def __call__(self, parts: list[str]) -> list[bytes]:
        find, known, fresh = self.v.pattern.findall, self.known, {}
        # A blank and ASCII letters are one word.
        split = [[s] if s.isascii() and s[1:].isalpha() and s[0] in _WORD_START else find(s) for s in parts]
        for words in split:
            for w in words:
                if w not in known:
                    fresh[w] = b""
        for w, ids in zip(fresh, replay([w.encode() for w in fresh], self.v)):
            fresh[w] = ids
        if len(known) + len(fresh) <= self.most or not known:
            known.update(fresh)
            get = known.__getitem__
        else:
            get = lambda w: fresh[w] if w in fresh else known[w]
        out = [get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for ws in split]
        if len(known) > self.most:
            known.clear()
        return out


_WORD_START = frozenset(" abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def encode_texts(texts: list[str], v: Vocabulary) -> list[np.ndarray]:
    """Token ids of every text."""
    found = encode_by_segments(pa.array(texts, pa.string()), _Words(v))
    return [np.asarray(x.values) for x in found]


def encode(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`id_column` and ids (array of int) of every text."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    rows = docs.select(id_column, F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(vocabulary(path, pattern))
        for stretch in stretches(batches, "_text", STRETCH):
            ids = encode_by_segments(stretch["_text"], words)
            yield from pa.table({id_column: stretch[id_column], "ids": ids}).to_batches(max_chunksize=ROWS)

    schema = T.StructType([docs.schema[id_column], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(convert, schema)


def decode(encoded: DataFrame, id_column: str = "doc_id", path: str | None = None) -> DataFrame:
    """`id_column`, ids and bytes: what the ids stand for."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf(T.BinaryType())
    def bytes_of(ids: pd.Series) -> pd.Series:
        token = token_bytes(path)
        return ids.map(lambda x: b"".join(map(token.__getitem__, x.tolist())))

    return encoded.select(id_column, "ids", bytes_of("ids").alias("bytes"))


@F.pandas_udf(T.StringType())
def _digest_of_ids(ids: pd.Series) -> pd.Series:
    return ids.map(lambda x: hashlib.sha256(" ".join(map(str, x.tolist())).encode()).hexdigest())


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    decoded = decode(encode(table(spark, sf, "documents")))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _digest_of_ids("ids").alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
