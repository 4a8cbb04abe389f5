"""Prompts, model responses, chat history and fine-tuning examples."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cleaning import map_roles
from tidemark.operators.filters import present_content
from tidemark.operators.series import last_n
from tidemark.schemas import ANALYSIS, ANALYSIS_FIELDS
from tidemark.session import shuffle_tasks

SYSTEM_PROMPT = (
    "Rate the tone of a company news article. Reply with one JSON object and nothing else, with the fields "
    "CompanyName, CompanySector, Sentiment (0.00 very negative to 1.00 very positive), PositiveKeywords and "
    "NegativeKeywords (at most five words each, all of them words of the article)."
)
ARTICLE_INTRO = "News article:\n\n"
ARTICLE_REQUEST = "\n\nReturn the analysis of this article as JSON."

# Fixed value: the error of a response that is no JSON.
INVALID_JSON = "Invalid JSON from GPT"

# What a fine-tuning message may hold, and the names of the error counters.
MESSAGE_KEYS = ("role", "content", "name", "function_call", "weight")
MESSAGE_ROLES = ("system", "user", "assistant", "function")
CHAT_ERRORS = (
    "data_type",
    "missing_messages_list",
    "message_missing_key",
    "message_unrecognized_key",
    "unrecognized_role",
    "missing_content",
    "example_missing_assistant_message",
)

# --- prompts and scoring ---------------------------------------------------------------


def instruction(content: str = "content") -> Column:
    return F.concat(F.lit(ARTICLE_INTRO), F.col(content), F.lit(ARTICLE_REQUEST))


def _message(role, content) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_prompts(df: DataFrame, content: str = "content", system: str = SYSTEM_PROMPT) -> DataFrame:
    """Adds `messages`: the system prompt and the wrapped article."""
    return df.withColumn("messages", F.array(_message("system", F.lit(system)), _message("user", instruction(content))))


def with_system_prompt(df: DataFrame, messages: str = "messages", system: str = SYSTEM_PROMPT) -> DataFrame:
    """Puts the system prompt before a message list."""
    return df.withColumn(messages, F.concat(F.array(_message("system", F.lit(system))), F.col(messages)))


def score_articles(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[str], str]],
    key: str = "id",
    content: str = "content",
    tries: int = 1,
    pause: float = 0.0,
) -> DataFrame:
    """Response text of a user's scorer for every article with content: (key, response, error).

    `make_scorer` is called once per task and returns the function from instruction to
    response. An article that fails `tries` times, with `pause` seconds after the first failure and twice as many after
    each further one, keeps its row with the message in `error`. A scorer that
    must not be called too often keeps its own rate. Each use of the result scores again; plans.scoring
    keeps the answers.
    """
    todo = present_content(df, content).select(key, instruction(content).alias("instruction"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()

        def one(text):
            for turn in range(tries):
                try:
                    return scorer(text), None
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                if turn + 1 < tries:
                    time.sleep(pause * 2**turn)
            return None, error

        for pdf in batches:
            results = [one(text) for text in pdf["instruction"]]
            yield pd.DataFrame(
                {key: pdf[key], "response": [r for r, _ in results], "error": [e for _, e in results]}
            )

    return todo.mapInPandas(score, f"{key} {todo.schema[key].dataType.simpleString()}, response string, error string")


# --- responses -------------------------------------------------------------------------


def parse_analysis(df: DataFrame, response: str = "response") -> DataFrame:
    """Adds the fields of a JSON response under their report names.

    A response that is no JSON gives `error` and keeps its text in `raw_response`.
    """
    valid = F.try_parse_json(response).isNotNull()
    parsed = F.when(valid, F.from_json(response, ANALYSIS))
    fields = {new: F.col("_a")[old] for old, new in ANALYSIS_FIELDS.items()}
    return (
        df.withColumns({"_a": parsed, "_bad": ~valid & F.col(response).isNotNull()})
        .withColumns(
            {
                **fields,
                "error": F.when(F.col("_bad"), F.lit(INVALID_JSON)),
                "raw_response": F.when(F.col("_bad"), F.col(response)),
            }
        )
        .drop("_a", "_bad")
    )


def check_analysis(df: DataFrame, content: str = "content", most: int = 5) -> DataFrame:
    """Adds a flag per rule the prompt asks for: score range, two decimals, keyword count, keywords in the text."""
    score = F.col("sentiment").try_cast("double")

    def few(c):
        return F.coalesce(F.size(c) <= most, F.lit(True))

    def in_text(c):
        return F.coalesce(F.forall(c, lambda w: F.col(content).contains(w)), F.lit(True))

    return df.withColumns(
        {
            "score_in_range": F.coalesce(score.between(0, 1), F.lit(False)),
            "score_two_decimals": F.coalesce(F.abs(score - F.bround(score, 2)) < 1e-9, F.lit(False)),
            "few_keywords": few("positiveKeywords") & few("negativeKeywords"),
            "keywords_in_text": in_text("positiveKeywords") & in_text("negativeKeywords"),
        }
    )


# --- chat history ----------------------------------------------------------------------


def nested_messages(df: DataFrame, keys: Sequence[str] = ("conv_id",), order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """One row per key with its messages in time order. Bound the rows per key first (last_n)."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col(role).alias("role"), F.col(content).alias("content"))))
    messages = F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return df.groupBy(*keys).agg(messages.alias("messages"))


#: Bytes of text of a piece of a conversation.
PIECE_BYTES = 1 << 20


def message_pieces(
    df: DataFrame, keys: Sequence[str] = ("conv_id",), order: str = "turn", role: str = "role", content: str = "text", max_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Conversations of any length as pieces: the keys, `first` (order of the piece's first message) and its messages.

    Rows are sorted over all tasks, so a conversation that holds most rows lies in many of them; a task walks its rows once and
    ends a piece where the conversation ends, or where it would pass `max_bytes`. Pieces in the order of
    `first` are the conversation, as nested_messages gives it. A longer message is a piece of its own.
    """
    rows = df.select(*keys, F.col(order).alias("_at"), F.col(role).alias("_role"), F.col(content).alias("_content"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keys]
    schema = ", ".join([*kinds, f"first {rows.schema['_at'].dataType.simpleString()}", "messages array<struct<role: string, content: string>>"])
    sorted_rows = rows.repartitionByRange(shuffle_tasks(df.sparkSession), *rows.columns).sortWithinPartitions(*rows.columns)
    names = [*keys, "first", "messages"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.schema([])
        key, first, messages, size = None, None, [], 0
        for batch in batches:
            kept, done = batch.schema, []
            for row in batch.to_pylist():
                mine = tuple(row[k] for k in keys)
                more = len((row["_content"] or "").encode()) + len((row["_role"] or "").encode())
                if messages and (mine != key or size + more > max_bytes):
                    done.append((*key, first, messages))
                    messages, size = [], 0
                if not messages:
                    key, first = mine, row["_at"]
                messages.append({"role": row["_role"], "content": row["_content"]})
                size += more
            yield _batch(done, kept)
        if messages:
            yield _batch([(*key, first, messages)], kept)

    def _batch(done: list[tuple], kept: pa.Schema) -> pa.RecordBatch:
        message = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))
        types = [*[kept.field(k).type for k in keys], kept.field("_at").type, message]
        columns = list(zip(*done)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names)

    return sorted_rows.mapInArrow(walk, schema)


def recent_context(df: DataFrame, n: int = 5, key: str = "conv_id", order: str = "turn", speaker: str = "speaker", message: str = "message") -> DataFrame:
    """The last n entries of every conversation as chat messages; unknown speakers are left out afterwards."""
    return nested_messages(map_roles(last_n(df, n, [key], [order]), speaker), [key], order, "role", message)


def keyed_entries(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """Rows as (id text, entry struct): the rows of a keyed document."""
    return df.select(F.col(id_col).cast("string").alias("id"), F.struct(*cols).alias("entry"))


# --- fine-tuning examples --------------------------------------------------------------


def _example_errors() -> dict[str, Column]:
    """Error counts of one example, per counter; `_x` is the parsed example, `_m` its messages."""
    is_dict = F.coalesce(F.schema_of_variant("_x").startswith("OBJECT"), F.lit(False))
    has_messages = F.coalesce(F.size("_m") > 0, F.lit(False))

    def field(m, name, kind="string"):
        return F.try_variant_get(m, f"$.{name}", kind)

    def keys(m):
        return F.map_keys(F.try_variant_get(m, "$", "map<string,variant>"))

    def empty(m, name):
        text = field(m, name)
        return F.coalesce(text.isin("", "[]", "{}", "0", "false"), F.lit(True))

    def no_content(m):
        is_text = F.coalesce(F.schema_of_variant(field(m, "content", "variant")) == "STRING", F.lit(False))
        return (empty(m, "content") & empty(m, "function_call")) | ~is_text

    def count(rule):
        return F.when(has_messages, F.size(F.filter("_m", rule))).otherwise(0)

    def known_role(m):
        return F.coalesce(field(m, "role").isin(*MESSAGE_ROLES), F.lit(False))

    allowed = F.array(*[F.lit(k) for k in MESSAGE_KEYS])
    required = F.array(F.lit("role"), F.lit("content"))
    from_assistant = F.exists("_m", lambda m: F.coalesce(field(m, "role") == "assistant", F.lit(False)))
    return {
        "data_type": (~is_dict).cast("int"),
        "missing_messages_list": (is_dict & ~has_messages).cast("int"),
        "message_missing_key": count(lambda m: F.size(F.array_except(required, keys(m))) > 0),
        "message_unrecognized_key": count(lambda m: F.size(F.array_except(keys(m), allowed)) > 0),
        "unrecognized_role": count(lambda m: ~known_role(m)),
        "missing_content": count(no_content),
        "example_missing_assistant_message": F.when(has_messages, (~from_assistant).cast("int")).otherwise(0),
    }


def validate_chat(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Error counts (error, n) over all examples (JSON text); only errors that occur."""
    parsed = df.select(F.try_parse_json(raw).alias("_x")).withColumn(
        "_m", F.try_variant_get("_x", "$.messages", "array<variant>")
    )
    counts = _example_errors()
    totals = parsed.select(*[c.alias(name) for name, c in counts.items()]).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in CHAT_ERRORS]
    )
    return totals.unpivot([], list(CHAT_ERRORS), "error", "n").where("n > 0")


def to_jsonl(df: DataFrame, field: str = "games", doc: str = "doc") -> DataFrame:
    """One JSON text per element of the array `field` of each JSON document."""
    elements = F.from_json(F.col(doc), f"{field} ARRAY<STRING>")[field]
    return df.select(F.explode(elements).alias("line"))


#: Lines of a part that one task walks; lines of a block above which it is none.
LINES_PER_PART, LINES_PER_BLOCK = 65_536, 1_000_000


def reassemble_blocks(lines: DataFrame, file: str = "file", line_no: str = "line_no", line: str = "line", max_lines: int = LINES_PER_BLOCK) -> DataFrame:
    """JSON documents written over several lines: one row (file, start line, JSON text) per block.

    A line "{" opens a block (again, if one is open), the next line "}" closes it; lines
    outside and blocks that are no JSON are skipped. So are blocks of more than `max_lines` lines before any of them is
    collected: a stray "{" may stand far before the next "}". Files are cut every 65,536 line
    numbers; only the first and last marker of each part is passed on to other parts.
    """
    kind = F.when(F.trim(line) == "{", 1).when(F.trim(line) == "}", 2)
    marker = F.when(kind.isNotNull(), F.struct(F.col(line_no).alias("at"), kind.alias("kind")))
    rows = lines.withColumns({"_mark": marker, "_part": F.floor(F.col(line_no) / LINES_PER_PART)})
    parts = rows.groupBy(file, "_part").agg(F.min("_mark").alias("_first"), F.max("_mark").alias("_last"))

    def latest(col, by, order, upto):
        """The last marker before a row in the given order (backwards: the next marker after it)."""
        return F.last(col, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, upto))

    carried = parts.select(
        file,
        "_part",
        latest("_last", [file], F.col("_part").asc(), -1).alias("_before"),
        latest("_first", [file], F.col("_part").desc(), -1).alias("_after"),
    )
    opened = latest("_mark", [file, "_part"], F.col(line_no).asc(), 0)
    closed = latest("_mark", [file, "_part"], F.col(line_no).desc(), -1)
    in_block = (
        rows.withColumns({"_open": opened, "_close": closed})
        .join(carried, [file, "_part"], "left")
        .withColumns({"_open": F.coalesce("_open", "_before"), "_close": F.coalesce("_close", "_after")})
        .where("_open.kind = 1 AND _close.kind = 2")
        .where(F.col("_close.at") - F.col("_open.at") <= max_lines)
        .withColumn("start", F.col("_open.at"))
    )
    text = F.array_join(F.sort_array(F.collect_list(F.struct(F.col(line_no).alias("at"), F.col(line).alias("text"))))["text"], "\n")
    return (
        in_block.groupBy(file, "start")
        .agg(F.concat(text, F.lit("\n}")).alias("_doc"))
        .withColumn("_v", F.try_parse_json("_doc"))
        .where(F.col("_v").isNotNull())
        .select(file, "start", F.to_json("_v").alias("json"))
    )
