"""Token sequences of bounded length, packed by a grouping genetic algorithm on islands.

A chromosome is a list of bins. Crossover injects whole well-filled bins of one parent into the other, takes out the bins
that hold an injected piece twice, and puts the pieces this displaces back by best fit, longest first. Pieces are dealt out
in blocks of bounded size; each block evolves on several islands, every island a row of its own, and the islands of a block
pass their best chromosome on to the next island between rounds. Pieces of bins that stay poorly filled are pooled over all
blocks and packed again.

Defined results: a null text is empty; every document ends with the id `end`, so an empty one has one token. Documents
longer than a sequence are cut into full pieces, of which the first may be shorter; full pieces fill a sequence each. Rows
with equal ids are packed each on its own. No rows: no pieces. Other columns are ignored.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from random import Random
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.common import encode_by_segments, query, stored, stretches, table
from tidemark.session import shuffle_tasks

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
#: Bytes of text that are encoded together.
STRETCH = 6 << 20
#: Texts whose encodings are held at once; characters of a segment that is kept, at most.
ENCODINGS, KEPT = 64, 256
#: Pieces of a block on average; islands of a block; rounds with migration between them; chromosomes of an island;
#: children per round.
BLOCK, ISLANDS, ROUNDS, CHROMOSOMES, CHILDREN = 2048, 3, 2, 4, 12
#: Bins below this fill are pooled and packed again; bins from this fill on count as well filled in crossover.
POOR, WELL = 0.97, 0.985
#: How often pools are packed again.
POOLS = 2


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


class _Segments:
    """Ids of segments; those met before are looked up, as long as there is room for them.

    They lie in one array and their ids in one string: a worker keeps them between tasks, and an object for each would take
    several times as much.
    """

    def __init__(self, path: str, most: int = 3 << 18):
        self.t, self.most = _tokenizer(path), most
        self.known, self.ids, self.ends = pa.array([], pa.string()), b"", np.zeros(1, dtype=np.int64)
        self.line_end = self.t.encode("\n", add_special_tokens=False).ids

    def __call__(self, parts: list[str]) -> list[bytes]:
        at = pc.fill_null(pc.index_in(pa.array(parts, pa.string()), value_set=self.known), -1).to_numpy()
        found = self._encode(list(dict.fromkeys(parts[i] for i in np.flatnonzero(at < 0).tolist())))
        ids, starts, ends = self.ids, self.ends[at].tolist(), self.ends[np.minimum(at + 1, len(self.known))].tolist()
        out = [ids[a:b] if i >= 0 else found[s] for s, i, a, b in zip(parts, at.tolist(), starts, ends)]
        self._keep(found)
        return out

    def _keep(self, found: dict[str, bytes]) -> None:
        fresh = list(islice((s for s in found if len(s) <= KEPT), self.most - len(self.known)))
        if fresh:
            sizes = [len(found[s]) for s in fresh]
            self.known = pa.concat_arrays([self.known, pa.array(fresh, pa.string())])
            self.ids = b"".join([self.ids, *(found[s] for s in fresh)])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))

    def _encode(self, fresh: list[str]) -> dict[str, bytes]:
        """Words are encoded many at a time: a line end between them is a token of its own."""
        found, words, others = {}, [], []
        for s in fresh:
            core = s.split()
            word = len(core) == 1 and (s == core[0] or s == " " + core[0]) and len(self.line_end) == 1
            (words if word else others).append(s)
        groups = [words[a : a + 200] for a in range(0, len(words), 200)]
        for group, ids in zip(groups, self._ids("\n".join(g) for g in groups)):
            ends = np.append(np.flatnonzero(ids == self.line_end[0]), len(ids)).tolist()
            content, start = ids.tobytes(), 0
            for s, end in zip(group, ends, strict=True):
                found[s] = content[4 * start : 4 * end]
                start = end + 1
        for s, ids in zip(others, self._ids(others)):
            found[s] = ids.tobytes()
        return found

    def _ids(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text. An encoding holds some hundred bytes a token, so only some are held at once."""
        texts = iter(texts)
        while some := list(islice(texts, ENCODINGS)):
            for e in self.t.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(e.ids, dtype=np.int32)


@lru_cache(maxsize=4)
def _segments(path: str) -> _Segments:
    """One for all tasks of a worker."""
    return _Segments(path)


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end: int = 0, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every document."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kinds = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in kinds)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, last = _segments(path), np.array([end], dtype="<u4").tobytes()
        for stretch in stretches(batches, "_text", STRETCH):
            found = encode_by_segments(stretch["_text"], segments)
            offsets, ids = found.offsets.to_numpy(), found.values.to_numpy()
            rows, places = [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                content, n = ids[a:b].astype("<u4").tobytes() + last, b - a + 1
                start, piece = 0, 0
                while start < n:
                    size = (n - start) % capacity or capacity
                    rows.append((piece, start, size, crc32(content[4 * start : 4 * (start + size)])))
                    places.append(i)
                    start, piece = start + size, piece + 1
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            keys = stretch["doc_id"].combine_chunks().take(pa.array(places))
            yield pa.RecordBatch.from_arrays([keys, *columns], schema=pa.schema([("doc_id", keys.type), *((n, c.type) for (n, _), c in zip(kinds, columns))]))
        # The worker goes on to other tasks: it gives back what these texts took.
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).mapInArrow(cut, schema)


def least_bins(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins."""
    return max(-(-sum(lengths) // capacity), sum(2 * n > capacity for n in lengths))


def _place(bins: list[list[int]], room: list[tuple[int, int]], items: list[int], lengths: list[int], capacity: int) -> None:
    """Best fit of `items`, in their order, into `bins`; `room` holds (free, bin) in order."""
    for item in items:
        n = lengths[item]
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(item)
        else:
            free, b = capacity, len(bins)
            bins.append([item])
        insort(room, (free - n, b))


def _fill(bins: list[list[int]], lengths: list[int]) -> list[int]:
    return [sum([lengths[i] for i in b]) for b in bins]


def _pack(bins: list[list[int]], items: list[int], lengths: list[int], capacity: int) -> list[list[int]]:
    fill = _fill(bins, lengths)
    _place(bins, sorted((capacity - f, b) for b, f in enumerate(fill)), items, lengths, capacity)
    return bins


def _fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> float:
    """Mean square of the fill: at equal numbers, full and empty bins are better than even ones."""
    return sum((f / capacity) ** 2 for f in _fill(bins, lengths)) / max(1, len(bins))


def _cross(a: list[list[int]], b: list[list[int]], lengths: list[int], capacity: int, rng: Random) -> list[list[int]]:
    fill = _fill(b, lengths)
    injected = [x for x, f in zip(b, fill) if f >= WELL * capacity and rng.random() < 0.5]
    held = {i for x in injected for i in x}
    child, displaced = [list(x) for x in injected], []
    for x, f in zip(a, _fill(a, lengths)):
        twice = not held.isdisjoint(x)
        # The worst bins are opened as well, so that their pieces can move.
        if twice or (f < POOR * capacity and rng.random() < 0.7):
            displaced += [i for i in x if i not in held]
        else:
            child.append(list(x))
    displaced.sort(key=lambda i: -lengths[i])
    return _pack(child, displaced, lengths, capacity)


def evolve(population: list[list[list[int]]], lengths: list[int], capacity: int, rng: Random) -> list[list[list[int]]]:
    """The island's chromosomes after one round, the best first."""
    goal, n = least_bins(lengths, capacity), len(lengths)
    while len(population) < CHROMOSOMES:
        noise = 0.0 if not population else 0.15
        order = sorted(range(n), key=lambda i: -lengths[i] * (1 - noise * rng.random()))
        population.append(_pack([], order, lengths, capacity))
    ranked = sorted(((len(c), -_fitness(c, lengths, capacity), j, c) for j, c in enumerate(population)))
    for k in range(CHILDREN):
        if ranked[0][0] <= goal:
            break
        first, second = rng.sample(range(len(ranked)), 2)
        first, second = min(first, second), max(first, second)
        child = _cross(ranked[first][3], ranked[second][3], lengths, capacity, rng)
        ranked = sorted([*ranked, (len(child), -_fitness(child, lengths, capacity), len(population) + k, child)])[:CHROMOSOMES]
    return [r[3] for r in ranked]


def _coded(bins: list[list[int]], n: int) -> list[int]:
    """The bin of each piece."""
    out = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            out[i] = b
    return out


def _bins(code) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, b in enumerate(code):
        out.setdefault(int(b), []).append(i)
    return list(out.values())


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """k, bin (block and number, unique) and offset of pieces given by k (unique) and length, all below `capacity`."""
    pieces = stored(pieces.select("k", "length"), "pieces")
    done = []
    for pool in range(POOLS + 1):
        n = pieces.count()
        blocks = max(1, -(-n // block))
        packed = stored(_pack_blocks(pieces, blocks, capacity, pool), "packed")
        if pool == POOLS or blocks == 1:
            return _united([*done, packed])
        # Bins that are filled well stay; the pieces of all others are packed again with those of other blocks.
        done.append(packed.where(F.col("fill") >= POOR * capacity))
        pieces = stored(packed.where(F.col("fill") < POOR * capacity).select("k", "length"), "pieces")
    raise AssertionError


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("k", "bin", "offset")


def _pack_blocks(pieces: DataFrame, blocks: int, capacity: int, salt: int) -> DataFrame:
    """k, length, bin, offset and fill (of the bin), each block packed on its own."""
    tasks = shuffle_tasks(pieces.sparkSession)
    # Blocks have bounded sizes: a third of all pieces can't share one.
    of_block = pieces.groupBy(F.pmod(F.xxhash64("k", F.lit(salt)), F.lit(blocks)).alias("block"))
    rows = of_block.agg(F.sort_array(F.collect_list(F.struct("k", F.col("length").cast("int").alias("n")))).alias("held"))
    rows = rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    rows = rows.withColumn("population", F.array().cast("array<array<int>>"))
    schema = "block long, island int, held array<struct<k:long,n:int>>, population array<array<int>>"

    def evolve_rows(round_: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for r in frame.itertuples(index=False):
                    lengths = [int(h["n"]) for h in r.held]
                    rng = Random(f"{salt}/{round_}/{r.block}/{r.island}")
                    found = evolve([_bins(c) for c in r.population], lengths, capacity, rng)
                    out.append((r.block, r.island, r.held, [_coded(c, len(lengths)) for c in found]))
                yield pd.DataFrame(out, columns=["block", "island", "held", "population"])

        return run

    for round_ in range(ROUNDS):
        if round_:
            # Each island's best chromosome goes to the next island of its block and takes the place of the worst.
            elite = rows.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("population")[0].alias("elite"))
            rows = rows.join(elite, ["block", "island"])
            newcomer = F.concat(F.array("elite"), F.slice("population", 1, CHROMOSOMES - 1))
            rows = rows.select("block", "island", "held", newcomer.alias("population"))
        else:
            rows = rows.select("block", "island", "held", "population")
        rows = stored(rows.repartition(tasks, "block", "island").mapInPandas(evolve_rows(round_), schema), "islands")
    bins = F.array_max(F.col("population")[0])
    best = rows.groupBy("block").agg(F.min_by(F.struct("held", F.col("population")[0].alias("code")), F.struct(bins, "island")).alias("best"))

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, best in zip(frame["block"], frame["best"]):
                held, out = best["held"], []
                for b, items in enumerate(_bins(best["code"])):
                    at, fill = 0, sum(int(held[i]["n"]) for i in items)
                    for i in items:
                        out.append((int(held[i]["k"]), int(held[i]["n"]), (salt << 58) + (int(block) << 20) + b, at, fill))
                        at += int(held[i]["n"])
                yield pd.DataFrame(out, columns=["k", "length", "bin", "offset", "fill"])

    return best.mapInPandas(spread, "k long, length long, bin long, offset long, fill long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = 0, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = pieces_of(docs, capacity, end, vocabulary).withColumn("k", F.monotonically_increasing_id())
    pieces = stored(pieces, "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity)
    full = full.select(*columns, (-1 - F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    packed = pack(pieces.where(F.col("length") < capacity), capacity)
    packed = pieces.join(packed.withColumnRenamed("bin", "sequence_id"), "k")
    return packed.select(*columns, "sequence_id", "offset").union(full)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"))
