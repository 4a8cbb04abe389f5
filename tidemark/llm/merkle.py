"""Merkle trees over the sections and paragraphs of documents, with DataFrame functions only.

A paragraph ends at a line feed; a section ends at an empty line, or after `section` paragraphs where the text has none. A
paragraph's digest is that of its text, a section's that of its paragraphs' digests, the root that of the sections and of
the text's length. Equal roots mean equal texts; where roots differ, only branches that differ need a look. Beside the tree
a fingerprint holds the hashes of the text's leaves (runs of a few words within a phrase), which tell how much two texts have
in common.

Defined results: a null text is empty and has no leaves. Rows with equal ids are told apart by their text; equal rows follow
each other. The document after the last is the first; a single document follows itself. A null id comes after all others.
No rows: no results. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table

#: Paragraphs of a section where the text has no empty lines.
SECTION = 8
#: A leaf: up to eight words, of which only the last may end a phrase, and what follows it. Marks that end a sentence without a
#: blank end a leaf, and so does the 32nd character of a word. The leaves make up the text.
LEAF = r"(?!\z)(?:[^ \n。！？]{0,32}+(?<![.!?;:,|]) ){0,7}+[^ \n。！？]{0,32}+(?:[。！？]++ ?|\n++| |\z|(?=[^ \n。！？]))"
#: Bits of a leaf's hash.
LEAF_BITS = 48


def leaves(text: Column) -> Column:
    """The hashes of a text's leaves, in order."""
    mask = F.lit((1 << LEAF_BITS) - 1)
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LEAF), F.lit(0))
    return F.transform(found, lambda x: F.xxhash64(x).bitwiseAND(mask))


def sections(text: Column, section: int = SECTION) -> Column:
    """array of struct(digest, paragraphs): a section's digest and those of its paragraphs."""

    def branch(lines: Column) -> Column:
        digests = F.transform(lines, lambda x: F.sha2(x, 256))
        return F.struct(F.sha2(F.array_join(digests, ""), 256).alias("digest"), digests.alias("paragraphs"))

    text = F.coalesce(text, F.lit(""))
    by_empty_line = F.transform(F.split(text, "\n\n"), lambda s: F.split(s, "\n"))
    lines = F.split(text, "\n")
    starts = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / section).cast("int"))
    by_count = F.transform(starts, lambda i: F.slice(lines, i * section + 1, F.lit(section)))
    return F.transform(F.when(F.contains(text, F.lit("\n\n")), by_empty_line).otherwise(by_count), branch)


def root(branches: Column, text: Column) -> Column:
    """The root over the sections' digests and the text's length."""
    joined = F.array_join(F.transform(branches, lambda s: s["digest"]), "")
    return F.sha2(F.concat_ws(":", F.char_length(F.coalesce(text, F.lit(""))).cast("string"), joined), 256)


def fingerprint(root_: Column, leaves_: Column) -> Column:
    """Root and leaves as text."""
    return F.concat(root_, F.lit(":"), F.array_join(F.transform(leaves_, F.hex), ","))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves that both have (Dice), below 1."""
    a, b = F.array_distinct(leaves_a), F.array_distinct(leaves_b)
    shared = 2.0 * F.size(F.array_intersect(a, b)) / F.greatest(F.size(a) + F.size(b), F.lit(1))
    # The same leaves in another order or number are not the same text.
    return F.when(root_a == root_b, 1.0).otherwise(F.least(shared, F.lit(1.0 - 1e-9)))


def differing(a: Column, b: Column) -> Column:
    """Places (section, paragraph), from 0, where two texts' sections differ; equal branches aren't entered."""

    def paragraphs(s: Column, i: Column) -> Column:
        both = F.arrays_zip(s["a"]["paragraphs"].alias("x"), s["b"]["paragraphs"].alias("y"))
        found = F.transform(both, lambda p, j: F.when(~p["x"].eqNullSafe(p["y"]), j))
        return F.transform(F.filter(found, lambda j: j.isNotNull()), lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    same = lambda s: s["a"]["digest"].eqNullSafe(s["b"]["digest"])
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    return F.flatten(F.transform(pairs, lambda s, i: F.when(same(s), none).otherwise(F.coalesce(paragraphs(s, i), none))))


def with_next(docs: DataFrame, rows_per_stretch: int = 50, most: int = 8192) -> DataFrame:
    """doc_id, text and next_text: the text of the document with the next smaller id; after the last comes the first.
    Also root and leaves of both, which are hashed once.

    Ids are cut into stretches of about equal numbers, at most `most`. The first document of a stretch is added to the
    stretch before it, so every neighbour is found within a stretch and texts are shuffled once. The driver sees the
    bounds of the stretches and their first ids.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = min(most, max(2, docs.count() // rows_per_stretch))
    parts = F.array(*[F.lit(i / wanted) for i in range(1, wanted)])
    found = docs.agg(F.percentile_approx("doc_id", parts, 10 * wanted)).first()[0]
    edges = sorted(set(found or []), reverse=True)
    docs = docs.withColumn("stretch", _stretch(F.col("doc_id"), edges))
    tops = {r["stretch"]: r["top"] for r in docs.groupBy("stretch").agg(F.max("doc_id").alias("top")).collect()}
    first, last = min(tops, default=0), max(tops, default=0)
    is_top = F.col("doc_id").isin([t for t in tops.values() if t is not None])
    heads = docs.where(is_top | F.col("doc_id").isNull() if None in tops.values() else is_top)
    heads = heads.groupBy("stretch").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("h"))
    moved = F.when(F.col("stretch") == first, last).otherwise(F.col("stretch") - 1)
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), F.col("h.text").alias("text"), moved.alias("stretch"))
    rows = docs.withColumn("head", F.lit(0)).unionByName(heads.withColumn("head", F.lit(1)))
    text = F.col("text")
    rows = rows.withColumns({"root": root(sections(text), text), "leaves": leaves(text), "hash": F.xxhash64(text)})
    w = Window.partitionBy("stretch").orderBy("head", F.desc_nulls_last("doc_id"), "hash", "text")
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(w) for c in ("text", "root", "leaves")})
    return rows.where("head = 0").drop("head", "stretch", "hash")


def _stretch(number: Column, edges: list[int]) -> Column:
    """How many of the descending `edges` are at least `number`: whole groups of edges first, then within one."""
    if not edges:
        return F.lit(0)
    size = math.isqrt(len(edges)) + 1
    every = F.array(*[F.lit(e).cast("long") for e in edges])
    groups = F.array(*[F.lit(min(edges[i : i + size])).cast("long") for i in range(0, len(edges), size)])
    whole = F.size(F.filter(groups, lambda e: e >= number)) * size
    rest = F.size(F.filter(F.slice(every, whole + 1, F.lit(size)), lambda e: e >= number))
    return F.when(number.isNull(), len(edges) + 1).otherwise(F.least(whole + rest, F.lit(len(edges))))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by the beginning of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


@query("op6_merkle")
def op6_merkle(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_next(table(spark, sf, "documents"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumns(
        {
            "edited_root": root(sections(F.col("edited")), F.col("edited")),
            "edited_leaves": leaves(F.col("edited")),
        }
    )
    own, changed, following = ([F.col(f"{x}root"), F.col(f"{x}leaves")] for x in ("", "edited_", "next_"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(*own).alias("fingerprint"),
        fingerprint(*changed).alias("edited_fingerprint"),
        likeness(*own, *changed).alias("near_edited"),
        likeness(*own, *following).alias("near_next"),
    )
