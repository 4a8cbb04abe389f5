"""License scans by diagonal voting.

Every run of three consecutive words of a document is hashed, and Spark joins the hashes with the places of equal runs in the
templates; equal hashes count only if the words are equal. A document that holds a template has its hits on one diagonal:
place in the document less place in the template. Hits are counted by diagonal, diagonals with enough votes that lie next
to each other (words left out or put in move a copy to the next diagonal) are merged into one span, and the span is
verified: it has to cover nearly all runs of the template (all of them for a short one), among them those that tell the license
from its relatives, within not many more words than the template has.

Templates are a parameter; their runs are broadcast up to GRAMS_BROADCAST of them. Hits are shuffled once, by document.

Defined results: a null or empty text has no words, no places (null) and empty labels; texts below three words have words
only. Texts of any length are taken whole, in pieces that overlap by two words. Rows with equal ids, or without id, are documents
of their own. Phrases may overlap, every place counts. No documents: no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lowered, numbered_words, query, stretches, table, word_pieces

#: Words of a run; votes that a diagonal needs (fewer for a template with fewer runs); diagonals that are merged.
RUN, VOTES, NEAR = 3, 4, 8
#: Share of a template's runs that a span has to cover; templates with fewer runs have to be covered whole.
COVERED, SHORT = 0.8, 20
#: Words of a span for each word of its template, at most.
SPAN = 1.5
#: Bytes of text that are worked on together, runs of a row, runs of all templates that are broadcast.
STRETCH, PIECE, GRAMS_BROADCAST = 8 << 20, 8192, 1 << 20
#: Stands for a document itself, so that documents without hits keep a row.
DOCUMENT = -1
COLUMNS = ["row", "id", "n_words", "start", "hashes", "words"]


@dataclass(frozen=True)
class Template:
    """A text that stands for a license. A span without the words of `needs` isn't one; `base` marks plain phrases."""

    label: str
    text: str
    needs: str = ""
    base: bool = False


# The phrases of the contract, then notices as their licenses give them.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("bsd-2", "under the bsd 2 clause license"),
    Template("bsd-3", "under the bsd 3 clause license"),
    Template("isc", "under the isc license"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at",
        needs="apache license version 2",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        needs="version 3 of the license",
    ),
    Template(
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
        needs="version 2 of the license",
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
        needs="mozilla public license v 2",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
)


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower() if text.isascii() else lowered(pa.array([text]))[0].as_py())


def template_rows(templates: Sequence[Template]) -> list[tuple]:
    """template, label, base, words, runs, least votes of a diagonal, least runs of a span, places of needed runs."""
    out = []
    for number, t in enumerate(templates):
        words = template_words(t.text)
        runs = len(words) - RUN + 1
        if runs < 1:
            raise ValueError(f"a template has {RUN} words at least: {t.text!r}")
        need, needed = template_words(t.needs), []
        if need:
            at = next(i for i in range(len(words)) if words[i : i + len(need)] == need)
            needed = list(range(at, at + len(need) - RUN + 1))
        least = runs if runs < SHORT else math.ceil(COVERED * runs)
        out.append((number, t.label, t.base, len(words), runs, min(VOTES, runs), least, needed))
    return out


def run_hashes(words: Sequence[str], numbers: np.ndarray) -> np.ndarray:
    """For every place the hash of the run that starts there; the last RUN - 1 places have none."""
    own = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)[numbers]
    out = np.zeros(max(0, len(own) - RUN + 1), dtype=np.uint64)
    for i in range(RUN):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[i : i + len(out)]
    return out.view(np.int64)


def template_runs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """template, at, hash and gram of every run of every template, and one row that meets the documents themselves."""
    rows = [(DOCUMENT, 0, DOCUMENT, [])]
    for number, t in enumerate(templates):
        words = template_words(t.text)
        hashes = run_hashes(words, np.arange(len(words))).tolist()
        rows += [(number, i, h, words[i : i + RUN]) for i, h in enumerate(hashes)]
    runs = spark.createDataFrame(rows, "template int, at int, hash long, gram array<string>")
    return F.broadcast(runs) if len(rows) <= GRAMS_BROADCAST else runs


def _find(segments: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of all segments and how many each has."""
    find = re.compile(WORD).findall
    found = [find(s) for s in segments]
    return [w for ws in found for w in ws], np.array([len(ws) for ws in found], dtype=np.int64)


def _pieces(part: pa.Table, texts: pa.Array, first: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows of runs of the texts, whose words are numbered from `first` on, and the number of words of each text."""
    words, lists = numbered_words(texts, _find)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    numbers = np.asarray(lists.values)
    hashes = run_hashes(words, numbers)
    sizes = np.diff(offsets)
    runs = np.maximum(sizes - RUN + 1, 0)
    pieces = -(-runs // PIECE)
    which = np.repeat(np.arange(len(texts)), pieces)
    begin = (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
    length = np.minimum(runs[which] - begin, PIECE)
    start = offsets[which] + begin

    def cut(lengths: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return pa.array(ends.astype(np.int32)), np.arange(ends[-1]) + np.repeat(start - ends[:-1], lengths)

    ends, place = cut(length)
    hashed = pa.ListArray.from_arrays(ends, pa.array(hashes[place]))
    ends, place = cut(length + RUN - 1)
    spelt = pa.ListArray.from_arrays(ends, pa.array(words, type=pa.string()).take(pa.array(numbers[place])))
    row = part.column("row").combine_chunks().take(pa.array(which))
    nobody = pa.nulls(len(which), part.schema.field("id").type)
    columns = [row, nobody, pa.nulls(len(which), pa.int64()), pa.array(begin + first), hashed, spelt]
    return pa.RecordBatch.from_arrays(columns, COLUMNS), sizes


def _documents(part: pa.Table, counts: np.ndarray) -> pa.RecordBatch:
    """One row for each document, with its id and its number of words."""
    n = part.num_rows
    alone = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), pa.array(np.full(n, DOCUMENT)))
    empty = pa.array([[]] * n, type=pa.list_(pa.string()))
    row, ids = (part.column(c).combine_chunks() for c in ("row", "id"))
    return pa.RecordBatch.from_arrays([row, ids, pa.array(counts), pa.array(np.zeros(n, dtype=np.int64)), alone, empty], COLUMNS)


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in stretches(batches, "text", STRETCH):
        texts = lowered(part.column("text"))
        if part.num_rows > 1 or len(texts[0].as_py()) <= STRETCH:
            batch, counts = _pieces(part, texts, 0)
            yield batch
            yield _documents(part, counts)
            continue
        last: list[str] = []
        total = 0
        for piece in word_pieces(texts[0].as_py(), STRETCH):
            batch, counts = _pieces(part, pa.array([" ".join(last) + " " + piece]), total - len(last))
            yield batch
            total += int(counts[0]) - len(last)
            last = [*last, *re.findall(WORD, piece)][-(RUN - 1) :]
        yield _documents(part, np.array([total]))


def hits(docs: DataFrame, templates: Sequence[Template], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, template, at, place: where runs of a template stand in a document. One row of the template DOCUMENT for each
    document has its id and its number of words; `row` tells documents with one id apart."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, n_words long, start long, hashes array<long>, words array<string>"
    pieces = rows.mapInArrow(_hash_texts, schema)
    runs = pieces.select("row", "id", "n_words", "start", "words", F.posexplode("hashes").alias("i", "hash"))
    found = runs.join(template_runs(docs.sparkSession, templates), "hash")
    same = (F.col("template") == DOCUMENT) | (F.slice("words", F.col("i") + 1, F.size("gram")) == F.col("gram"))
    return found.where(same).select("row", "id", "n_words", "template", "at", (F.col("start") + F.col("i")).alias("place"))


def spans(found: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Merged diagonals: row, id, n_words, template and its label, base; covered runs, first and last place, whether the span
    is verified (`fits`), and of base phrases the number of places, the first and the last one."""
    facts = "template int, label string, base boolean, length int, runs int, least_votes int, least_runs int, needed array<int>"
    whole = (DOCUMENT, None, False, 0, 1, 1, 1, [])
    rows = found.sparkSession.createDataFrame([whole, *template_rows(templates)], facts)
    known = F.broadcast(rows) if len(templates) <= GRAMS_BROADCAST else rows
    diagonal = F.col("place") - F.col("at")
    lines = (
        found.repartition("row")
        .groupBy("row", "template", diagonal.alias("diagonal"))
        .agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.collect_list("at").alias("ats"), F.min("place").alias("low"), F.max("place").alias("high"))
        .join(known, "template")
        .where(F.size("ats") >= F.col("least_votes"))
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True))
    bands = lines.withColumn("apart", apart.cast("int")).withColumn("band", F.sum("apart").over(order))
    bands = bands.withColumn("phrase", F.col("base") & (F.size("ats") == F.col("runs")))
    merged = (
        bands.withColumn("at", F.explode("ats"))
        .groupBy("row", "template", "band")
        .agg(
            F.max("id").alias("id"),
            F.max("n_words").alias("n_words"),
            F.collect_set("at").alias("covered"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.count_if(F.col("phrase") & (F.col("at") == 0)).alias("places"),
            F.min(F.when(F.col("phrase"), F.col("low"))).alias("first_place"),
            F.max(F.when(F.col("phrase"), F.col("low"))).alias("last_place"),
        )
        .join(known, "template")
    )
    covered = F.size("covered")
    fits = (
        (covered >= F.col("least_runs"))
        & (F.size(F.array_intersect("covered", "needed")) == F.size("needed"))
        & (F.col("high") + RUN - F.col("low") <= SPAN * F.col("length"))
    )
    return merged.withColumn("fits", F.col("base") | fits).withColumn("share", covered / F.col("runs"))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    The score is the largest share of a template's runs that one span covers.
    """
    kept = F.col("template") != DOCUMENT
    names = F.sort_array(F.collect_set(F.when(kept & F.col("fits"), F.col("label"))))
    base = F.sort_array(F.collect_set(F.when(F.col("places") > 0, F.col("label"))))
    return (
        spans(hits(docs, templates, doc_id, text), templates)
        .groupBy("row")
        .agg(
            F.max("id").alias(doc_id),
            F.max("n_words").alias("n_words"),
            F.sum("places").alias("n_base"),
            F.min("first_place").alias("first_word"),
            F.max("last_place").alias("last_word"),
            F.array_join(base, ",").alias("base_labels"),
            F.array_join(names, ",").alias("labels"),
            F.max(F.when(kept, F.col("share")).otherwise(0.0)).alias("score"),
        )
        .drop("row")
    )


def _sql(templates: Sequence[Template]) -> str:
    def text(value: object) -> str:
        return "'" + value + "'" if isinstance(value, str) else str(value)

    facts = ", ".join("(" + ", ".join(map(text, row)) + ")" for row in template_rows(templates))
    grams = []
    for number, t in enumerate(templates):
        words = template_words(t.text)
        grams += [f"({number}, {i}, '{' '.join(words[i : i + RUN])}')" for i in range(len(words) - RUN + 1)]
    return f"""
WITH facts(template, label, base, length, runs, least_votes, least_runs, needed) AS (VALUES {facts}),
grams(template, spot, gram) AS (VALUES {", ".join(grams)}),
d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), p AS (SELECT doc_id, w, unnest(range(len(w) - 2)) AS place FROM d),
hits AS (
  SELECT doc_id, template, spot, place FROM p JOIN grams ON w[place + 1] || ' ' || w[place + 2] || ' ' || w[place + 3] = gram
), lines AS (
  SELECT doc_id, template, place - spot AS diagonal, list(spot) AS ats, min(place) AS low, max(place) AS high
  FROM hits GROUP BY doc_id, template, diagonal
), kept AS (
  SELECT *, base AND len(ats) = runs AS phrase,
    CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {NEAR} THEN 0 ELSE 1 END AS apart
  FROM lines JOIN facts USING (template) WHERE len(ats) >= least_votes
), bands AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS band FROM kept),
spans AS (
  SELECT doc_id, template, any_value(label) AS label, any_value(base) AS base, list_distinct(flatten(list(ats))) AS covered,
    min(low) AS low, max(high) AS high, any_value(needed) AS needed, any_value(runs) AS runs, any_value(length) AS length,
    any_value(least_runs) AS least_runs, count(*) FILTER (phrase) AS places, min(low) FILTER (phrase) AS first_place,
    max(low) FILTER (phrase) AS last_place
  FROM bands GROUP BY doc_id, template, band
), judged AS (
  SELECT *, len(covered) / CAST(runs AS DOUBLE) AS share, base OR (len(covered) >= least_runs
    AND len(list_filter(needed, lambda x: NOT list_contains(covered, x))) = 0 AND high + {RUN} - low <= {SPAN} * length) AS fits
  FROM spans
), found AS (
  SELECT doc_id, CAST(sum(places) AS BIGINT) AS n_base, min(first_place) AS first_word, max(last_place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (places > 0) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (fits) AS labels, max(share) AS score
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN found USING (doc_id)
"""


@query("op12_licenses", _sql(TEMPLATES))
def op12_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))
