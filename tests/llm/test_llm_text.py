"""Segments, BPE, packing, chat formatting: exact round trips and brute force."""

import base64
import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat_format, packing
from tidemark.llm.common import encode_by_segments, segments, stretches

TEXTS = st.text(alphabet="ab c\n\t's1é.\x1c\x85 日", max_size=14)
DOCS = "doc_id bigint, text string, ids string, piece string, k int, bin int"
EDGE = [
    (1, "The cat sat. " * 40, "x", "y", 1, 1),
    (1, "The cat sat. " * 40, "x", "y", 1, 1),
    (2, None, None, None, None, None),
    (3, "", "", "", 0, 0),
    (None, " lone  blanks \n\n", "x", "y", 1, 1),
    (5, "word " * 9000, "x", "y", 1, 1),
    (6, "日本語 é x", "x", "y", 1, 1),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_lie_within_segments(text):
    find = regex.compile(public_tokenizers.PATTERN).findall
    assert [w for s in segments(text) for w in find(s)] == find(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_texts_are_put_together_from_segments(texts):
    find, number = regex.compile(public_tokenizers.PATTERN).findall, {}

    def encode(parts):
        return [np.array([number.setdefault(w, len(number)) for w in find(p)], dtype=np.int32).tobytes() for p in parts]

    got = encode_by_segments(pa.array(texts, pa.string()), encode).to_pylist()
    assert got == [[number[w] for w in find(t)] for t in texts]


def test_stretches_keep_all_rows():
    batch = pa.record_batch({"t": pa.array(["aaaa", None, "bb", "c" * 20, "", "d"])})
    parts = list(stretches(iter([batch, batch]), "t", 6))
    assert [x for p in parts for x in p["t"].to_pylist()] == 2 * batch["t"].to_pylist() and len(parts) > 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aben -=日'\n1", max_size=30), max_size=6))
def test_replay_equals_the_library(reference, texts):
    v = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert [x.tolist() for x in bpe.encode_texts(texts, v)] == [reference.encode_ordinary(t) for t in texts]


def test_runs_of_one_character(reference):
    v = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["a" * 4999, "-" * 3001, " " * 777, "aab" * 500]
    assert [x.tolist() for x in bpe.encode_texts(texts, v)] == [reference.encode_ordinary(t) for t in texts]


def test_encode_and_decode_rows(spark, edge, reference):
    rows = bpe.decode(bpe.encode(edge)).collect()
    got = sorted((repr(r.doc_id), list(r.ids), bytes(r.bytes).decode()) for r in rows)
    assert got == sorted((repr(e[0]), reference.encode_ordinary(e[1] or ""), e[1] or "") for e in EDGE)
    assert bpe.encode(edge.limit(0)).count() == 0


def check_packing(rows, capacity=2048):
    placed = collections.defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


def test_pieces_and_places(spark, edge):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = packing.pack_documents(edge).collect()
    check_packing(rows)
    want = collections.Counter()
    for doc, text, *_ in EDGE:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cut = len(ids) % 2048 or 2048
        for piece, a in enumerate([0, *range(cut, len(ids), 2048)]):
            b = cut if piece == 0 else a + 2048
            want[doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.pack_documents(edge.limit(0)).count() == 0


def test_few_encodings_are_held_at_once(monkeypatch):
    """An encoding takes some hundred bytes a token: those of a stretch are not all held beside each other."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, held = packing._tokenizer(path), []

    class Spy:
        def __getattr__(self, name):
            return getattr(t, name)

        def encode_batch_fast(self, texts, **options):
            held.append(len(texts))
            return t.encode_batch_fast(texts, **options)

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Spy())
    parts = [f" word{i}" for i in range(30_000)] + [f"two words {i}\n" for i in range(300)] + ["", "\n", " "]
    found = packing._Segments(path)(parts)
    assert max(held) <= 64 and sum(held) >= 450
    for i in (0, 199, 200, 29_999, 30_000, 30_299, 30_300, 30_301, 30_302):
        assert np.frombuffer(found[i], dtype=np.int32).tolist() == t.encode(parts[i], add_special_tokens=False).ids


def test_crossover_keeps_every_piece():
    from random import Random

    rng = Random(1)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    found = packing.evolve([], lengths, 100, rng)
    for bins in found:
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(packing._fill(bins, lengths)) <= 100
    assert [len(b) for b in found] == sorted(len(b) for b in found)
    assert packing._bins(packing._coded(found[0], 300)) and packing.least_bins(lengths, 100) <= len(found[0])


def test_pools_over_several_blocks(spark):
    from random import Random

    rng = Random(2)
    lengths = [rng.randint(1, 2047) for _ in range(900)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "k long, length long")
    rows = packing.pack(pieces, 2048, block=200).collect()
    assert sorted(r.k for r in rows) == list(range(900))
    bins = collections.Counter()
    for r in rows:
        bins[r.bin] += lengths[r.k]
    assert max(bins.values()) <= 2048
    best_fit = packing._pack([], sorted(range(900), key=lambda i: -lengths[i]), lengths, 2048)
    assert len(bins) <= 1.01 * len(best_fit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<s>"]), st.text(alphabet="a\\[]/INST<>s \n", max_size=25)), min_size=1, max_size=4))
def test_formatting_can_be_read_back(turns):
    formatted, spans = chat_format.render(turns, frozenset(["assistant"]))
    assert chat_format.parse(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_masks_meet_spans():
    starts, ends = np.array([0, 2, 2, 4, 6]), np.array([2, 4, 4, 6, 9])
    assert chat_format.mask_tokens(starts, ends, np.array([[2, 4], [4, 4], [7, 8]])).tolist() == [False, True, True, False, True]
    assert chat_format.masked_text("abcdefghi", starts, ends, np.array([False, True, True, False, True])) == "cdghi"


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST] ok [/INST]", 0), (1, 0, "user", "\\[INST] 日本 é", 0), (1, None, None, "first", 0),
        (1, 2, "assistant", None, 0), (1, 2, "assistant", "tie \U0001f600 ", 0), (None, 0, "assistant", " x ", 0), (2, 0, "user", "", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n_turns int")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    said = "\nfirst\nuser\n\\[INST] 日本 é\nassistant\n</s>[INST] ok [/INST]\nassistant\n\nassistant\ntie \U0001f600 \n"
    assert set(out) == {1, 2, None} and out[1].n_turns == 5
    assert out[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    loss = "</s>[INST] ok [/INST]tie \U0001f600 "
    assert (out[1].loss_chars, out[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert (out[None].loss_chars, out[2].loss_chars) == (3, 0)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_known_segments_take_little_room():
    path = public_tokenizers.path(packing.VOCABULARY)
    known, t = packing._Segments(path, most=3000), packing._tokenizer(path)
    parts = [f" word{i:x}" for i in range(2500)] + ["long" * 100, "", "a b"]
    ids = [np.array(t.encode(s, add_special_tokens=False).ids, dtype=np.int32).tobytes() for s in parts]
    # The second time all but the long one are looked up; the third time there is room for some of the new ones only.
    assert known(parts) == ids and known(parts[::-1] + parts) == ids[::-1] + ids
    fresh = [f" more{i:x}" for i in range(2500)]
    assert known(fresh + parts) == [np.array(e.ids, dtype=np.int32).tobytes() for e in t.encode_batch_fast(fresh, add_special_tokens=False)] + ids
    assert len(known.known) == 3000
    assert known.known.nbytes + len(known.ids) + known.ends.nbytes < 48 * 3000
