"""Documents linked by the Jaccard similarity of their word n-grams: a size-aware heavy-light join.

Small sets are light: every subset of a fixed size that a link would have to share is enumerated, and sets that meet in a
subset are linked without a further look. Large sets are heavy: their inverted lists are scanned, the rarest terms first and
only as many as a link must meet, and candidates are verified on whole sets. The boundary lies where enumerating would cost
more than scanning, both counted on the data.

Components don't need all links of a group: a list's members are first held against one of them, the leader, and lists whose
members are already joined drop out; after some rounds with other leaders, all pairs that are left in different components
are verified, or, where they are many, those whose differences from a leader can be near enough. So no link between different
sets is lost, and groups of copies cost as much as they have members. Documents with equal sets are one node.

Terms and sets are known by hashes (64 and 128 bits). Defined results: a document without words has an empty set and is
linked with nothing; with fewer than n words, its whole sequence is its one term. A null text is empty. Rows with equal ids
are documents of their own; their components carry the smallest id. A null id takes part, but a component has its smallest
other id, or null where all are null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import join_by_group, query, stored, stretches, table

WORDS, PERCENT = 5, 75
#: Bytes of text of a stretch, and of the text whose terms make up a bucket (some four million terms).
STRETCH, BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 24 << 20, 64
#: The largest sets for which enumeration is considered, and how often leaders are tried before all pairs that are left.
LIGHT, ROUNDS = 16, 4

#: Odd multipliers, one for each word of a term.
_MIX = [np.uint64(xxhash.xxh3_64_intdigest(b"word %d" % i) | 1) for i in range(64)]


def least_overlap(a: int, b: int, percent: int) -> int:
    """How many terms sets of a and b terms share at least when they are linked."""
    return -(-percent * (a + b) // (100 + percent))


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    return F.ceil((a + b) * percent / (100 + percent))


def sets_of(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted hashes of every text's distinct terms."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = np.asarray(split.offsets).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known], dtype=np.uint64)
    index = coded.indices.to_numpy()
    real = np.array([w != "" for w in known], dtype=bool)[index]
    cuts = np.concatenate([[0], np.cumsum(real)])[offsets]
    h = hashes[index[real]]
    n = max(0, len(h) - words + 1)
    terms = np.zeros(n, dtype=np.uint64)
    for j in range(words):
        terms += h[j : n + j] * _MIX[j]
    terms = _scatter(terms)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= words:
            own = np.sort(terms[a : b - words + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            whole = (h[a:b] * np.array(_MIX[: b - a], dtype=np.uint64)).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(_scatter(np.array([whole], dtype=np.uint64)))
        else:
            out.append(terms[:0])
    return out


def _scatter(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


TERM_BYTES = 7


def shared_terms(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, key (of the set), n (its size), terms that another row has too, rarest first, and how many of them are
    scanned: `prefix` terms, of which linked sets share at least one.

    Terms are packed by stretch of the corpus and bucket of hashes, so that few large rows are shuffled; terms that only one
    row has go no further than their bucket.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        number = 0
        for rows in stretches(batches, "text", STRETCH):
            for a in range(0, rows.num_rows, 1 << 16):
                part = rows.slice(a, 1 << 16).combine_chunks()
                sets = sets_of(part["text"].chunk(0), words)
                sizes = np.array([len(s) for s in sets], dtype="<i4")
                ids = part["doc_id"].to_pandas().astype("Int64")
                known = ids.notna().to_numpy()
                out = [(-1 - first - number, first + number, ids.fillna(0).to_numpy("<i8").tobytes() + known.tobytes(), sizes.tobytes(), b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets))]
                terms = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(len(sets)), sizes).astype("<u2")
                order = np.argsort(terms, kind="stable")
                terms, owner = terms[order], owner[order]
                bounds = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)
                cuts = np.append(np.searchsorted(terms, bounds), len(terms))
                low = terms.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TERM_BYTES]
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    x, y = cuts[b], cuts[b + 1]
                    out.append((b, first + number, low[x:y].tobytes(), owner[x:y].tobytes(), b""))
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "stretch", "a", "b", "c"])

    def meet(bucket: pd.DataFrame) -> pd.DataFrame:
        number = int(bucket["bucket"].iloc[0])
        if number < 0:
            return bucket
        raw = np.frombuffer(b"".join(bucket["a"]), dtype=np.uint8).reshape(-1, TERM_BYTES)
        terms = np.zeros((len(raw), 8), dtype=np.uint8)
        terms[:, :TERM_BYTES] = raw
        terms = terms.view("<u8").ravel()
        owner = np.frombuffer(b"".join(bucket["b"]), dtype="<u2")
        row = np.repeat(np.arange(len(bucket)), [len(x) // 2 for x in bucket["b"]])
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        new = np.append(True, terms[1:] != terms[:-1])
        term = np.cumsum(new) - 1
        count = np.bincount(term)
        shared = count[term] > 1
        order, term = order[shared], term[shared]
        rank = np.cumsum(count > 1) - 1
        count, term = np.minimum(count[term], 65535).astype("<u2"), rank[term].astype("<u4")
        back = np.argsort(row[order], kind="stable")
        order, term, count = order[back], term[back], count[back]
        cuts = np.searchsorted(row[order], np.arange(len(bucket) + 1))
        out = []
        for i, stretch in enumerate(bucket["stretch"]):
            x, y = cuts[i], cuts[i + 1]
            if y > x:
                out.append((number, stretch, term[x:y].tobytes(), owner[order[x:y]].tobytes(), count[x:y].tobytes()))
        return pd.DataFrame(out, columns=["bucket", "stretch", "a", "b", "c"])

    def gather(stretch: pd.DataFrame) -> pd.DataFrame:
        own = stretch[stretch["bucket"] < 0].iloc[0]
        parts = stretch[stretch["bucket"] >= 0]
        sizes, keys = np.frombuffer(own["b"], dtype="<i4"), own["c"]
        n = len(sizes)
        ids, known = np.frombuffer(own["a"][: 8 * n], dtype="<i8"), np.frombuffer(own["a"][8 * n :], dtype=bool)
        lengths = [len(x) // 2 for x in parts["b"]]
        term = np.frombuffer(b"".join(parts["a"]), dtype="<u4").astype(np.int64)
        term += np.repeat(parts["bucket"].to_numpy(dtype=np.int64), lengths) << 32
        owner = np.frombuffer(b"".join(parts["b"]), dtype="<u2")
        count = np.frombuffer(b"".join(parts["c"]), dtype="<u2")
        order = np.lexsort((term, count, owner))
        term, owner = term[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(n + 1))
        held = np.diff(cuts)
        scanned = sizes - (-(-percent * sizes.astype(np.int64) // 100)) + 1 - (sizes - held)
        return pd.DataFrame(
            {
                "doc_id": pd.Series(ids).where(known, None).astype("Int64"),
                "key": [keys[16 * i : 16 * i + 16] if sizes[i] else None for i in range(n)],
                "n": sizes,
                "terms": [term[a:b] for a, b in zip(cuts, cuts[1:])],
                "prefix": np.where(sizes > 0, np.clip(scanned, 0, held), 0).astype(np.int32),
            }
        )

    packed = "bucket long, stretch long, a binary, b binary, c binary"
    dealt = docs.mapInArrow(deal, packed).groupBy("bucket").applyInPandas(meet, packed)
    found = dealt.groupBy("stretch").applyInPandas(gather, "doc_id long, key binary, n int, terms array<long>, prefix int")
    return stored(found, "sets")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it is joined with), for the nodes of edges a, b."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    near = both.groupBy("a", "b").agg(F.lit(1).alias("_once")).drop("_once")
    near = stored(near, "edges")
    roots = near.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
    roots = stored(roots, "roots")
    while True:
        # The smallest root among a node's neighbours, then that root's own root: chains halve with every turn.
        seen = near.join(roots, near["b"] == roots["node"]).select(F.col("a").alias("node"), "root", F.lit(None).cast("long").alias("was"))
        seen = seen.union(roots.select("node", "root", F.col("root").alias("was")))
        least = seen.groupBy("node").agg(F.min("root").alias("near"), F.max("was").alias("was"))
        up = roots.select(F.col("node").alias("near"), F.col("root").alias("up"))
        step = least.join(up, "near", "left").select("node", F.least("near", "up").alias("root"), "was")
        step = stored(step, "roots")
        roots = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return roots


def _light_edges(nodes: DataFrame, most: int, percent: int) -> DataFrame:
    """Links between sets of at most `most` terms, as edges to the smallest node of each subset's sets."""

    def enumerate_subsets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for node, n, terms in zip(frame["node"], frame["n"], frame["terms"]):
                terms = sorted(terms.tolist())
                for m in range(1, most + 1):
                    small, large = min(n, m), max(n, m)
                    if 100 * small < percent * large:
                        continue
                    for subset in combinations(terms, least_overlap(n, m, percent)):
                        key = np.array([small, large, *subset], dtype="<i8").tobytes()
                        out.append((xxhash.xxh3_128_digest(key), node, n, n == m))
            yield pd.DataFrame(out, columns=["subset", "node", "n", "same"])

    rows = nodes.where(F.col("n") <= most).select("node", "n", "terms")
    rows = rows.mapInPandas(enumerate_subsets, "subset binary, node long, n int, same boolean")
    rows = stored(rows.withColumn("subset", F.hex("subset")), "subsets")
    # Sets of one size are linked by any subset; sets of two sizes where both sizes meet.
    met = rows.groupBy("subset").agg(F.min("node").alias("a"), F.count("*").alias("met"), (F.first("same") | (F.min("n") < F.max("n"))).alias("linked"))
    met = stored(met.where((F.col("met") > 1) & F.col("linked")).select("subset", "a", "met"), "subsets")
    found = join_by_group(rows.select("subset", "node"), met, "subset", "met", rows.count())
    return found.where("a < node").select("a", F.col("node").alias("b"))


def _boundary(nodes: DataFrame, lists: DataFrame, percent: int) -> int:
    """The size up to which sets are cheaper to enumerate than to scan, 0 for none."""
    sizes = nodes.where(F.col("n") <= LIGHT).groupBy("n").agg(F.count("*").alias("sets")).collect()
    scans = lists.where(F.col("n") <= LIGHT).groupBy("n").agg(F.sum("length").alias("cost")).collect()
    sets, scan = {r["n"]: r["sets"] for r in sizes}, {r["n"]: r["cost"] for r in scans}
    best, most = 0, 0
    for x in range(1, LIGHT + 1):
        light = lambda n: sum(comb(n, least_overlap(n, m, percent)) for m in range(1, x + 1) if 100 * min(n, m) >= percent * max(n, m))  # noqa: E731, B023
        gain = sum(scan.get(n, 0) - sets.get(n, 0) * light(n) for n in range(1, x + 1))
        if gain > best:
            best, most = gain, x
    return most


def _verify(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b (nodes) that are linked."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("terms").alias("ta"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("terms").alias("tb"))
    rows = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    rows = rows.withColumn("shared", shared)
    return rows.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def _hooked(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels (node, comp) after each component has been hooked to the smallest one that an edge joins it with.

    Nodes of one label are joined; nodes that are joined may keep different labels for a while.
    """
    ends = edges.join(labels.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
    hooks = ends.where("ca <> cb").groupBy(F.greatest("ca", "cb").alias("_from")).agg(F.min(F.least("ca", "cb")).alias("_to"))
    sizes = labels.groupBy(F.col("comp").alias("_from")).agg(F.count("*").alias("size")).join(hooks, "_from")
    sizes = stored(sizes.withColumnRenamed("_from", "comp").withColumnRenamed("_to", "to"), "hooks")
    found = join_by_group(labels, sizes, "comp", "size", labels.count())
    return stored(found.select("node", F.coalesce("to", "comp").alias("comp")), "labels")


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and members (documents of the component) of every row."""
    sets = shared_terms(docs, words, percent)
    nodes = sets.where("prefix > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("terms").alias("terms"), F.first("prefix").alias("prefix"), F.min("doc_id").alias("first"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # Places count from the rarest term; terms that only one row has come first and aren't listed.
    place = (F.col("n") - F.size("terms") + F.col("at")).alias("place")
    lists = nodes.select("node", "n", "terms", "first", F.posexplode(F.slice("terms", F.lit(1), F.col("prefix"))).alias("at", "term"))
    lists = stored(lists.select("node", "n", "first", place, "term"), "lists")
    # Lists of one node tell nothing: equal rows only.
    lengths = lists.groupBy("term").agg(F.count("*").alias("length"), F.min("n").alias("least"))
    lengths = stored(lengths.where("length > 1").withColumn("size", F.col("length")), "lengths")
    listed = lists.count()
    lists = join_by_group(lists, lengths, "term", "length", listed, "inner")
    # A linked set shares a term that is rare enough in both, given the smallest partner on the list.
    smallest = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    lists = lists.where(F.col("place") <= F.col("n") - _least_overlap(F.col("n"), smallest, percent)).drop("least")
    lists = stored(lists.withColumnRenamed("size", "length"), "lists")
    nodes = stored(nodes.join(lists.select("node").distinct(), "node", "left_semi"), "nodes")
    light = _boundary(nodes, lists, percent)
    # A set whose partners all are light needs no scan.
    lists = lists.where(100 * F.col("n") >= percent * (light + 1))
    # Only nodes that share a scanned term with another one have anything to be joined with.
    labels = stored(lists.select("node").distinct().select("node", F.col("node").alias("comp")), "labels")
    links = [stored(_light_edges(nodes, light, percent), "links")] if light else []
    for round_ in range(ROUNDS + 1):
        pairs, last, lists = _candidates(lists, listed, labels, nodes, round_, percent)
        if pairs is not None:
            links.append(stored(_verify(pairs, nodes, percent), "links"))
        if last:
            break
        labels = _hooked(labels, links[-1])
    edges = reduce(DataFrame.union, links) if links else nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    return _result(sets, nodes, components(edges))


def _candidates(
    lists: DataFrame, listed: int, labels: DataFrame, nodes: DataFrame, round_: int, percent: int
) -> tuple[DataFrame | None, bool, DataFrame]:
    """Pairs of nodes with different labels that share a scanned term, whether these are all that can be linked, and the lists
    that still hold different labels: nodes of one label keep a common one, so the other lists are done with. The lengths of
    all lists add up to at most `listed`.

    While all are much more than there are members, a pair for each member and each of its list's leaders; at last those that
    `_apart` leaves.
    """
    rows = stored(lists.select("term", "node", "n", "place", "first", "length").join(labels, "node"), "labelled")
    # The set with the first document is often the one that others are copies of; the other leaders change.
    first = F.coalesce("first", F.lit(2**62))
    orders = [first if not round_ else F.xxhash64("node", F.lit(2 * round_)), F.xxhash64("node", F.lit(2 * round_ + 1))]
    leads = [F.min(F.struct(o.alias("order"), "node", "comp", "n", "place")).alias(f"lead{j}") for j, o in enumerate(orders)]
    by_comp = rows.groupBy("term", "comp").agg(F.count("*").alias("c"), F.max("length").alias("length"), *leads)
    mixed = by_comp.groupBy("term").agg(
        F.sum("c").alias("m"),
        F.sum(F.col("c") * F.col("c")).alias("within"),
        F.max(F.struct("c", "comp"))["comp"].alias("major"),
        F.count("*").alias("parts"),
        F.max("length").alias("length"),
        *[F.min(f"lead{j}").alias(f"lead{j}") for j in range(len(leads))],
    )
    cross = ((F.col("m") * F.col("m") - F.col("within")) / 2).alias("cross")
    mixed = stored(mixed.where("parts > 1").select("term", "length", "m", cross, "major", "lead0", "lead1"), "mixed")
    members, pairs = mixed.agg(F.sum("m"), F.sum("cross")).first()
    if not members:
        return None, True, lists
    rows = stored(join_by_group(rows, mixed.drop("m", "cross"), "term", "length", listed, "inner"), "members")
    last = round_ == ROUNDS or pairs <= members
    if pairs > members and last:
        return _apart(rows, nodes, percent), True, rows
    if last:
        # Every member outside its list's largest component with all members of other components.
        others = rows.where("comp <> major").select("term", *[F.col(c).alias(f"{c}_") for c in ("node", "comp", "n", "place")])
        found = others.join(rows.select("term", "node", "comp", "n", "place"), (others["term"] == rows["term"]) & (F.col("comp_") != F.col("comp")) & _close(percent))
    else:
        lead = F.explode(F.array("lead0", "lead1")).alias("lead")
        found = rows.select("node", "comp", "n", "place", lead)
        found = found.select("*", *[F.col(f"lead.{c}").alias(f"{c}_") for c in ("node", "comp", "n", "place")])
        found = found.where((F.col("comp_") != F.col("comp")) & _close(percent))
    return found.select(F.least("node_", "node").alias("a"), F.greatest("node_", "node").alias("b")).distinct(), last, rows


def _apart(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes on a common list that have different labels and can be linked, found by what sets them apart from a leader.

    Lists with the same leader are one group. Two sets differ in as many terms as their differences from the leader do: what
    most of a group has in common cancels out. So differences of d and e terms must share more terms the larger they are, and a
    link must meet in the first of them, the rarest first. Where they needn't share any, both sets are linked with the
    group's closest to the leader as well, and these links join as much.
    """
    # Linked: whole * (terms that differ) <= rest * (sum of the sizes). A set's excess is whole * difference - rest * size.
    whole, rest = 100 + percent, 100 - percent
    rows = rows.select("term", "node", "comp", "n", "first")
    first = F.min(F.struct(F.coalesce("first", F.lit(2**62)).alias("first"), "node"))
    leads = stored(rows.groupBy("term").agg(first["node"].alias("lead"), F.count("*").alias("m")), "leads")
    rows = join_by_group(rows, leads, "term", "m", rows.count())
    rows = stored(rows.groupBy("lead", "node").agg(F.first("comp").alias("comp"), F.first("n").cast("long").alias("n")), "members")
    total = rows.count()
    known = rows.groupBy("lead").agg(F.count("*").alias("m")).join(nodes.select(F.col("node").alias("lead"), F.col("terms").alias("known")), "lead")
    rows = join_by_group(rows.join(nodes.select("node", "terms"), "node"), stored(known, "leads"), "lead", "m", total)
    # Terms that only one row has come first, then those that the leader hasn't, then its own: the same order in all sets.
    tokens = F.concat(F.array_except("terms", "known"), F.array_except("known", "terms"))
    rows = rows.select("lead", "node", "comp", "n", (F.col("n") - F.size("terms")).alias("alone"), tokens.alias("tokens"))
    rows = rows.withColumn("d", F.col("alone") + F.size("tokens"))
    rows = stored(rows.withColumn("excess", whole * F.col("d") - rest * F.col("n")), "differences")
    center = F.struct("excess", "node", "comp")
    parts = rows.groupBy("lead", "comp").agg(F.count("*").alias("c"), F.min(center).alias("center"), F.max("n").alias("most"))
    parts = stored(parts, "parts")
    groups = parts.groupBy("lead").agg(
        F.sum("c").alias("m"), F.max(F.struct("c", "comp"))["comp"].alias("major"), F.min("center").alias("center"), F.max("most").alias("most")
    )
    groups = stored(groups, "groups")
    others = join_by_group(parts, groups.select("lead", "m", "major"), "lead", "m", total).where("comp <> major")
    groups = groups.join(others.groupBy("lead").agg(F.min("center.excess").alias("others")), "lead")
    rows = join_by_group(rows, stored(groups, "groups"), "lead", "m", total).where("major IS NOT NULL")
    to_center = rows.where((F.col("comp") != F.col("center.comp")) & (F.col("excess") + F.col("center.excess") <= 0))
    # The fewest terms that differences of linked sets share, whatever the partner.
    partner = F.when(F.col("comp") == F.col("major"), F.col("others")).otherwise(F.col("center.excess"))
    least = F.greatest(
        F.lit(1), F.ceil((F.col("excess") + partner) / (2 * whole)), F.ceil((F.col("excess") - rest * F.col("most")) / whole)
    )
    rows = rows.withColumn("least", least.cast("long"))
    scanned = F.greatest(F.lit(0), F.col("d") - F.col("least") - F.col("alone") + 1).cast("int")
    found = rows.select(
        "lead", "node", "comp", "major", "excess", "least", F.size("tokens").alias("size"), F.posexplode(F.slice("tokens", F.lit(1), scanned)).alias("at", "token")
    )
    # How many terms there are from this one on.
    found = stored(found.withColumn("left", F.col("size") - F.col("at")).drop("size", "at"), "prefixes")
    names = ("lead", "token", "node", "comp", "excess", "least", "left")
    one = found.where("comp <> major").select(*[F.col(c).alias(f"{c}_") for c in names])
    shared = F.greatest("least", "least_", F.ceil((F.col("excess") + F.col("excess_")) / (2 * whole)))
    once = (F.col("comp") == F.col("major")) | (F.col("node_") < F.col("node"))
    same = (F.col("lead") == F.col("lead_")) & (F.col("token") == F.col("token_"))
    met = one.join(found, same & (F.col("comp_") != F.col("comp")) & once & (shared <= F.least("left", "left_")))
    pairs = met.select("node", "node_").union(to_center.select("node", "center.node"))
    return pairs.select(F.least("node_", "node").alias("a"), F.greatest("node_", "node").alias("b")).distinct()


def _close(percent: int) -> Column:
    """Whether two members of a list can be linked by their sizes and by the places of the list's term."""
    overlap = _least_overlap(F.col("n"), F.col("n_"), percent)
    sizes = 100 * F.least("n", "n_") >= percent * F.greatest("n", "n_")
    return sizes & (F.col("place") <= F.col("n") - overlap) & (F.col("place_") <= F.col("n_") - overlap)


def _result(sets: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Components carry the smallest document id of all rows whose sets they hold."""
    rows = sets.select("doc_id", F.hex("key").alias("key"), "n", F.xxhash64("doc_id").alias("spread"))
    by_key = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    comp = nodes.select(F.hex("key").alias("key"), "node").join(roots, "node").select("key", F.col("root").alias("comp"))
    by_key = stored(by_key.join(comp, "key", "left").withColumn("comp", F.coalesce(F.col("comp").cast("string"), "key")), "keys")
    by_comp = by_key.groupBy("comp").agg(F.min("first").alias("component_id"), F.sum("copies").alias("members"), F.count("*").alias("keys"))
    # One component may hold most keys, one key most rows.
    by_comp = stored(by_comp, "components")
    of_key = join_by_group(by_key.select("key", "comp", "copies"), by_comp, "comp", "keys", by_key.count()).drop("comp")
    of_key = stored(of_key, "keys")
    found = join_by_group(rows, of_key, "key", "copies", rows.count())
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("members", F.lit(1)).alias("members"),
    )


@query("op4_jaccard")
def op4_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return link(table(spark, sf, "documents"))
