"""Whole conversations as one formatted text with token ids and a loss mask aligned by offsets.

A conversation is rendered turn after turn: `<s>[INST]role[/INST]text</s>`. Control strings inside roles and texts are
escaped, so the only ones in the output are the template's. The whole rendering is encoded once, with offsets; the sorted
spans of the turns that count are intersected with the tokens' spans by binary search.

Defined results: rows with the same conversation and turn are ordered by role and text; a null turn comes first. A null
role or text is empty. Rows with a null conversation form one conversation whose id is null. No rows: no conversations.
Other columns are ignored. A conversation is one text, so its rows meet in one task; they are sorted by Spark and streamed,
and only one conversation is held at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, pre_tokenizers, processors

from tidemark.llm.common import query, table

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
VOCABULARY = "byte_bpe_50k.json"

FORMATTED = (
    "conv_id long, formatted string, ids array<int>, token_starts array<int>, token_ends array<int>, "
    "loss_mask array<boolean>, n_turns long"
)

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """The text without control strings: a backslash after their first character, other backslashes doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def render(turns: list[tuple[str, str]], trained: frozenset[str]) -> tuple[str, np.ndarray]:
    """The formatted conversation and the sorted spans (begin, end) of the texts that are trained on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        begin = at + len(head)
        if role in trained:
            spans.append((begin, begin + len(body)))
        parts += [head, body, "</s>"]
        at = begin + len(body) + len("</s>")
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn begins at {at}")
    return turns


def mask_tokens(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span. Both lists are sorted; spans don't overlap."""
    if not len(spans) or not len(starts):
        return np.zeros(len(starts), bool)
    # The first span that ends after the token begins is the only one that can be met first.
    first = np.searchsorted(spans[:, 1], starts, side="right")
    inside = first < len(spans)
    begin = spans[np.minimum(first, len(spans) - 1), 0]
    return inside & (begin < ends)


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The characters that masked tokens cover, each once: bytes of one character may lie in several tokens."""
    depth = np.zeros(len(formatted) + 1, dtype=np.int64)
    np.add.at(depth, starts[mask], 1)
    np.add.at(depth, ends[mask], -1)
    covered = np.cumsum(depth[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return "".join(formatted[a:b] for a, b in edges.reshape(-1, 2))


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS])
    return t


def format_conversations(
    conversations: DataFrame, trained: tuple[str, ...] = ("assistant",), vocabulary: str | None = None
) -> DataFrame:
    """conv_id, formatted, ids, token_starts, token_ends, loss_mask and n_turns of every conversation."""
    path, roles = vocabulary or public_tokenizers.path(VOCABULARY), frozenset(trained)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")

    def encode(key, turns: list[tuple[str, str]]) -> tuple:
        formatted, spans = render(turns, roles)
        found = _tokenizer(path).encode(formatted, add_special_tokens=False)
        offsets = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
        mask = mask_tokens(offsets[:, 0], offsets[:, 1], spans)
        return key, formatted, found.ids, offsets[:, 0], offsets[:, 1], mask, len(turns)

    def convert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, turns = None, []
        for frame in frames:
            done = []
            for conv, role, text in zip(frame["conv_id"], frame["role"], frame["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if turns and conv != key:
                    done.append(encode(key, turns))
                    turns = []
                key = conv
                turns.append((role, text))
            if done:
                yield _frame(done)
        if turns:
            yield _frame([encode(key, turns)])

    return rows.mapInPandas(convert, FORMATTED)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in FORMATTED.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output itself says: its turns, and the text under its mask."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                turns = parse(r.formatted)
                starts, ends = np.asarray(r.token_starts, np.int64), np.asarray(r.token_ends, np.int64)
                loss = unescape(masked_text(r.formatted, starts, ends, np.asarray(r.loss_mask, bool)))
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((r.conv_id, len(turns), _sha(said), len(loss), _sha(loss), len(r.formatted), len(r.ids)))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ_BACK.split(", ")])
            yield out.astype({"conv_id": "Int64"})

    return formatted.drop("n_turns").mapInPandas(read, READ_BACK)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


CHALLENGE = "</s>[INST] ok [/INST]"


@query("op7_chat_format")
def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    chats = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-1, 0, "user", CHALLENGE), (-1, 1, "assistant", CHALLENGE)]
    chats = chats.union(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    return read_back(format_conversations(chats))
