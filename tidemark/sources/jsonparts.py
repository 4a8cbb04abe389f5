"""Elements of JSON documents of any size, read by many tasks.

Spark splits a file at any byte, and JSON can't be read from the middle: whether a comma parts two elements depends on how deep it
lies, whether it stands in a string and whether that string's quote is escaped. So the parts are read twice. The first pass
takes down what each part does to the reader's state, for every state the part may begin with. Those steps are put together
part by part, one row each, which gives the state every part really begins with. The second pass cuts the parts into elements;
an element that lies over a border is put together again by its number. No task holds more than a part's stretch
of text and one element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

QUOTE, ESCAPE, COMMA = 34, 92, 44
OPENING, CLOSING = (123, 91), (125, 93)
#: Objects end with it, so that rows of text are small and Spark finds many places to split a file.
ROW_END = "}"
#: Characters of text that are scanned at once: a scan holds some ten numbers for each.
STRETCH = 1 << 18
#: The name at the end of the text before a value.
NAME = r'("(?:[^"\\]|\\.)*"\s*:)\s*$'


def scan(text: np.ndarray, inside: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """For every byte whether it stands in a string and how it changes the depth, and the state behind the last one.

    `inside`: the text begins in a string; `escaped`: after an odd number of backslashes.
    """
    at = np.arange(len(text))
    slash = text == ESCAPE
    plain = np.maximum.accumulate(np.where(slash, -1, at)) if len(text) else at
    run = at - plain
    odd = (run % 2 == 1) ^ ((plain < 0) & escaped)
    # A byte is escaped by an odd run of backslashes that ends right before it.
    by = np.concatenate([[escaped], odd[:-1]]) if len(text) else odd
    quotes = (text == QUOTE) & ~by
    behind = np.cumsum(quotes) + int(inside)
    held = (behind - quotes) % 2 == 1
    free = ~held & ~quotes
    change = np.isin(text, OPENING).astype(np.int64) - np.isin(text, CLOSING).astype(np.int64)
    if not len(text):
        return held, change, inside, escaped
    return held | quotes, np.where(free, change, 0), bool(behind[-1] % 2), bool(odd[-1])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    """The text of consecutive rows of one part, about STRETCH characters at a time, with the row's other columns."""
    for batch in batches:
        names = [n for n in batch.schema.names if n != "value"]
        keys = batch.select(["file", "at"]).to_pandas()
        new = (keys != keys.shift()).any(axis=1).to_numpy()
        starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            row, held, size = {n: batch.column(n)[a].as_py() for n in names}, [], 0
            for value in batch.column("value").slice(a, b - a):
                value = value.as_py() + ROW_END
                if held and size + len(value) > STRETCH:
                    yield row, "".join(held).encode()
                    held, size = [], 0
                # The reader's state is known at every place, so a long row may be cut anywhere.
                while len(value) > STRETCH:
                    yield row, value[:STRETCH].encode()
                    value = value[STRETCH:]
                held.append(value)
                size += len(value)
            yield row, "".join(held).encode()


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part and state at its begin: the state at its end and the change of depth."""
    found: dict[tuple, dict] = {}
    for row, text in _stretches(batches):
        part = found.setdefault((row["file"], row["at"]), {(i, e): (i, e, 0) for i in (False, True) for e in (False, True)})
        data = np.frombuffer(text, dtype=np.uint8)
        step = {}
        for start, (inside, escaped, depth) in part.items():
            if (inside, escaped) not in step:
                _, change, i, e = scan(data, inside, escaped)
                step[inside, escaped] = (i, e, int(change.sum()))
            i, e, more = step[inside, escaped]
            part[start] = (i, e, depth + more)
    rows = [(*key, *start, *end) for key, part in found.items() for start, end in part.items()]
    names = ["file", "at", "inside", "escaped", "inside_after", "escaped_after", "depth"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64()]
    columns = list(zip(*rows)) or [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names)


def _starts(effects: pd.DataFrame) -> pd.DataFrame:
    """The state every part of a file begins with."""
    inside, escaped, depth, out = False, False, 0, []
    for at, part in effects.sort_values("at").groupby("at", sort=True):
        out.append((part["file"].iloc[0], at, inside, escaped, depth))
        step = part[(part["inside"] == inside) & (part["escaped"] == escaped)].iloc[0]
        inside, escaped, depth = bool(step["inside_after"]), bool(step["escaped_after"]), depth + int(step["depth"])
    return pd.DataFrame(out, columns=["file", "at", "inside", "escaped", "depth"])


def cut(text: bytes, inside: bool, escaped: bool, depth: int, level: int) -> tuple[list[tuple[bool, bytes]], bool, bool, int]:
    """The text cut where elements of `level` begin and end: (is an element, text), and the state behind it."""
    data = np.frombuffer(text, dtype=np.uint8)
    held, change, inside, escaped = scan(data, inside, escaped)
    after = depth + np.cumsum(change)
    opens, closes = (change == 1) & (after == level), (change == -1) & (after == level - 1)
    commas = ~held & (data == COMMA) & (after == level)
    edges = np.flatnonzero(opens | closes | commas)
    out, begin, element = [], 0, depth >= level
    for edge in edges.tolist():
        out.append((element, text[begin:edge]))
        begin, element = edge + 1, not closes[edge]
    out.append((element, text[begin:]))
    return out, inside, escaped, int(after[-1]) if len(after) else depth


def _cutter(level: int):
    def cut_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, segment, group, piece = None, (False, False, 0), 0, 0, 0
        for row, text in _stretches(batches):
            if (row["file"], row["at"]) != key:
                key, state = (row["file"], row["at"]), (row["inside"], row["escaped"], row["depth"])
                segment = group = piece = 0
            found, *state = cut(text, *state, level)
            rows = []
            for n, (element, part) in enumerate(found):
                if n:
                    segment, piece = segment + 1, 0
                    # The text between two groups of elements counts for the group that follows.
                    group += not element
                edge = n == 0 or n == len(found) - 1
                rows.append((*key, segment, piece, group, element, edge, part.decode()))
            piece += 1
            names = ["file", "at", "segment", "piece", "group", "element", "edge", "text"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names)

    return cut_parts


def read_elements(spark: SparkSession, path: str, level: int = 1, glob: str = "*.json") -> DataFrame:
    """file, number, group, text of the elements `level` brackets deep in the documents at `path`, one document per file.

    At level 1 these are the elements of an array, or the members of an object with their names. At level 2 they are
    those of the arrays or objects that the document's members hold; `group` is the name before them, such as `"games":`.
    Numbers grow in the order of a file, with gaps. Elements of blanks only are left out.
    """
    lines = spark.read.option("lineSep", ROW_END).text(path, pathGlobFilter=glob)
    rows = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    schema = "file string, at long, inside boolean, escaped boolean, inside_after boolean, escaped_after boolean, depth long"
    effects = rows.mapInArrow(_effects, schema)
    # One row per part that Spark itself plans by.
    starts = effects.groupBy("file").applyInPandas(_starts, "file string, at long, inside boolean, escaped boolean, depth long")
    starts = stored(starts, "json-starts")
    known = rows.join(F.broadcast(starts), ["file", "at"]).select("value", "file", "at", "inside", "escaped", "depth")
    schema = "file string, at long, segment long, piece long, `group` long, element boolean, edge boolean, text string"
    found = stored(known.mapInArrow(_cutter(level), schema), "json-pieces")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("file", "at").agg(F.max("segment").alias("last"), F.max("group").alias("groups"))
    sizes = sizes.withColumns({"first": F.coalesce(F.sum("last").over(before), F.lit(0)), "base": F.coalesce(F.sum("groups").over(before), F.lit(0))})
    placed = found.join(F.broadcast(sizes), ["file", "at"])
    number = (F.col("first") + F.col("segment")).alias("number")
    placed = placed.select("file", number, (F.col("base") + F.col("group")).alias("group"), "element", "edge", "at", "piece", "text")
    # Only what touches a border of a part, or of a batch of its rows, has further pieces elsewhere.
    single = placed.where(~F.col("edge")).select("file", "number", "group", "element", "text")
    joined = placed.where("edge").groupBy("file", "number").agg(
        F.max("group").alias("group"), F.max("element").alias("element"),
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "piece", "text")))["text"], "").alias("text"),
    )
    segments = single.unionByName(joined)
    heads = segments.where(~F.col("element")).select("file", "group", F.regexp_extract("text", NAME, 1).alias("head"))
    elements = segments.where("element").where(F.trim(F.regexp_replace("text", r"\s", "")) != "")
    out = elements.join(heads, ["file", "group"], "left")
    return out.select("file", "number", F.coalesce("head", F.lit("")).alias("group"), F.trim("text").alias("text"))


def array_lines(spark: SparkSession, path: str, field: str | None = None, glob: str = "*.json") -> DataFrame:
    """file, number, line: the elements of the array of each document as compact JSON, or of the array in one `field`."""
    found = read_elements(spark, path, 2 if field else 1, glob)
    if field:
        named = F.from_json(F.concat(F.lit("{"), F.col("group"), F.lit("0}")), "map<string,string>")
        found = found.where(F.array_contains(F.map_keys(named), field))
    return found.select("file", "number", F.to_json(F.try_parse_json("text")).alias("line"))


def keyed_entries(spark: SparkSession, path: str, entry: str, glob: str = "*.json") -> DataFrame:
    """(id, entry) rows of documents of the form {"id": {...}, ...}, one document per file."""
    member = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), f"map<string, {entry}>")
    return read_elements(spark, path, 1, glob).select(F.explode(member).alias("id", "entry"))
