"""What the operators of this package share: registry, table access, stored steps, heavy keys, word segments."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: No key outside the list of heavy keys holds more than 1 / HEAVY_SHARE of the rows, so the list has fewer entries.
HEAVY_SHARE = 1000

#: A blank between two characters that are no white space: no pre-token reaches across its left side.
_SPACES = "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n")
#: A text that can't be cut at every blank.
_LOOSE = rf"^ | $|  | \n|\n |[{_SPACES}]"
_TIGHT_BLANK = re.compile(r"(?<=\S) (?=\S)")


def query(name: str, sql: str | None = None):
    """Registers a query of this package; without `sql` the tests hold it against a brute-force version."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string")) % folds


def join_by_group(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int, how: str = "left") -> DataFrame:
    """`rows` joined ("left" or "inner") with one row per group, where one group may hold most rows.

    Groups above 1 / HEAVY_SHARE of `total` rows, fewer than HEAVY_SHARE by that bound, are broadcast; the others meet
    their rows by shuffle, where a row of a heavy group takes part with a key of its own and finds nothing.
    A null key meets nothing. `groups` should be stored, it is read twice; by an inner join, so are `rows`, which
    may hold their group's size themselves (under the name `count`). Column names that begin with `_` are taken.
    """
    facts = [c for c in groups.columns if c not in (key, count)]
    heavy = F.col(count) * HEAVY_SHARE > F.lit(total)
    large = groups.where(heavy).select(F.col(key).alias("_heavy"), F.struct(*facts).alias("_large"))
    small = groups.where(~heavy).select(F.col(key).alias("_light"), F.struct(*facts).alias("_small"))
    if how == "inner":
        if count in rows.columns:
            heavy_rows, light_rows = rows.where(heavy), rows.where(~heavy)
        else:
            heavy_rows, light_rows = rows, rows.join(F.broadcast(large.select("_heavy")), F.col(key) == F.col("_heavy"), "left_anti")
        heavy_rows = heavy_rows.join(F.broadcast(large), F.col(key) == F.col("_heavy")).select(*rows.columns, "_large.*")
        return heavy_rows.union(light_rows.join(small, F.col(key) == F.col("_light")).select(*rows.columns, "_small.*"))
    own = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    rows = rows.join(F.broadcast(large), F.col(key) == F.col("_heavy"), "left")
    # The same on every run of a task, whatever the order of rows.
    spread = F.concat_ws("~", F.lit(""), F.spark_partition_id(), F.xxhash64(*own))
    rows = rows.withColumn(
        "_key", F.when(F.col("_heavy").isNull() & F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(spread)
    )
    small = small.withColumn("_light", F.col("_light").cast("string"))
    rows = rows.join(small, F.col("_key") == F.col("_light"), "left")
    found = [F.coalesce(F.col(f"_large.{c}"), F.col(f"_small.{c}")).alias(c) for c in facts]
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], *found)


def segments(text: str) -> list[str]:
    """The text cut before every blank that stands between two visible characters.

    Any pre-token of the byte-level vocabularies lies within one segment, so segments can be encoded on their own and
    looked up when they repeat.
    """
    if not text:
        return []
    first, *rest = _TIGHT_BLANK.split(text)
    return [first, *[" " + p for p in rest]]


def encode_by_segments(texts: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> pa.ListArray:
    """The ids of every text; `encode` gives the ids (4-byte integers) of distinct segments. `texts` hold no nulls."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    loose = pc.match_substring_regex(texts, _LOOSE).to_numpy(zero_copy_only=False)
    kept, rest = np.flatnonzero(~loose), np.flatnonzero(loose)
    # Most texts can be cut at every blank: all values but a text's first stand for a segment that begins with a blank.
    parts = pc.split_pattern(texts.take(pa.array(kept)), " ")
    cuts = np.asarray(parts.offsets).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    tight = coded.indices.to_numpy().copy()
    strings = coded.dictionary.to_pylist()
    values = [" " + s for s in strings]
    number: dict[str, int] = {}
    firsts = cuts[:-1]
    own = [number.setdefault(strings[i], len(number)) for i in tight[firsts].tolist()]
    tight[firsts] = len(values) + np.array(own, dtype=np.int32)
    cut = [segments(t) for t in texts.take(pa.array(rest)).to_pylist()]
    more = np.array([number.setdefault(s, len(number)) for c in cut for s in c], dtype=np.int32) + len(values)
    ends = cuts[-1] + np.cumsum([0, *map(len, cut)])
    del strings, coded, parts, cut
    found = encode([*values, *number])
    sizes = np.array([len(f) // 4 for f in found], dtype=np.int64)
    ids = np.frombuffer(b"".join(found), dtype=np.int32)
    del found, values, number
    which = np.concatenate([tight, more])
    size = sizes[which]
    until = np.cumsum(size)
    shift = (np.cumsum(sizes) - sizes)[which] - until + size
    offsets = np.concatenate([[0], until])[np.concatenate([cuts, ends[1:]])]
    place = np.arange(until[-1] if len(until) else 0, dtype=np.int32)
    place += np.repeat(shift.astype(np.int32), size)
    del which, until, shift, size
    flat = ids[place]
    out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
    back = np.empty(len(texts), dtype=np.int64)
    back[np.concatenate([kept, rest])] = np.arange(len(texts))
    return out.take(pa.array(back)) if len(rest) else out


def stretches(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """The batches cut and joined into tables of about `most` bytes of text; a longer text is a table of its own."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > most:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i
            size += n
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


#: Words of ASCII digits, letters and all other characters above ASCII, in texts whose letters are lowered.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def lowered(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The texts with A-Z lowered and nothing else changed; a null text becomes empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    # The kernel works byte by byte and leaves bytes above ASCII alone.
    return pc.ascii_lower(pc.fill_null(texts, ""))


def numbered_words(texts: pa.Array, find: Callable[[list[str]], tuple[list[str], np.ndarray]]) -> tuple[list[str], pa.ListArray]:
    """The distinct words of the texts and every text as numbers of words.

    `find` gives the words of distinct segments one after another, and how many each segment has.
    """
    number: dict[str, int] = {}

    def encode(segments: list[str]) -> list[bytes]:
        words, counts = find(segments)
        held = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32).tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        return [held[a:b] for a, b in zip([0, *ends], ends)]

    numbers = encode_by_segments(texts, encode)
    return list(number), numbers


def word_pieces(text: str, most: int) -> Iterator[str]:
    """A text cut into pieces of about `most` characters at characters that belong to no word of WORD."""
    start = 0
    while len(text) - start > most:
        cut = _NO_WORD.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]
