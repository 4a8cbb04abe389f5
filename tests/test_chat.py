import json

import pytest

from tidemark.operators import chat


def errors(spark, *examples):
    df = spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in examples], "raw string")
    return {r.error: r.n for r in chat.validate_chat(df).collect()}


def messages(*ms):
    return {"messages": list(ms)}


GOOD = {"role": "assistant", "content": "fine"}


@pytest.mark.parametrize(
    "example, expected",
    [
        (messages({"role": "user", "content": "q"}, GOOD), {}),
        ("[1]", {"data_type": 1}),
        ("3", {"data_type": 1}),
        ({}, {"missing_messages_list": 1}),
        ({"messages": []}, {"missing_messages_list": 1}),
        (messages({"role": "user"}, GOOD), {"message_missing_key": 1, "missing_content": 1}),
        (messages({"content": "x"}, GOOD), {"message_missing_key": 1, "unrecognized_role": 1}),
        (messages({"role": "user", "content": "x", "score": 1}, GOOD), {"message_unrecognized_key": 1}),
        (messages({"role": "guest", "content": "x"}, GOOD), {"unrecognized_role": 1}),
        (messages({"role": "user", "content": ""}, GOOD), {"missing_content": 1}),
        (messages({"role": "user", "content": 5}, GOOD), {"missing_content": 1}),
        (messages({"role": "function", "content": None, "function_call": "f"}, GOOD), {"missing_content": 1}),
        (messages({"role": "user", "content": "x"}), {"example_missing_assistant_message": 1}),
        (messages({"role": "user", "content": "x", "weight": 1, "name": "n", "function_call": "f"}, GOOD), {}),
    ],
)
def test_each_error(spark, example, expected):
    assert errors(spark, example) == expected


def test_errors_add_up(spark):
    assert errors(spark, "[]", "[]", messages({"role": "x"}, {"role": "y"})) == {
        "data_type": 2,
        "message_missing_key": 2,
        "unrecognized_role": 2,
        "missing_content": 2,
        "example_missing_assistant_message": 1,
    }


def test_recent_context_maps_roles_after_taking_the_last(spark):
    history = [(1, i, s, f"m{i}") for i, s in enumerate(["user", "gpt", "user", "other", "llama", "user"])]
    df = spark.createDataFrame(history, "conv_id int, turn int, speaker string, message string").repartition(3)
    (row,) = chat.recent_context(df, 4).collect()
    assert [(m.role, m.content) for m in row.messages] == [("user", "m2"), ("assistant", "m4"), ("user", "m5")]


def test_responses(spark):
    answers = [
        (1, json.dumps({"CompanyName": "A", "Sentiment": 0.75, "PositiveKeywords": ["up"], "NegativeKeywords": [], "extra": 1}), "goes up"),
        (2, "{broken", "x"),
        (3, json.dumps({"Sentiment": "1.234", "PositiveKeywords": list("abcdef")}), "abcdef"),
        (4, json.dumps({"Sentiment": "0.5", "PositiveKeywords": ["absent"]}), "text"),
    ]
    df = spark.createDataFrame(answers, "id int, response string, content string")
    out = {r.id: r for r in chat.check_analysis(chat.parse_analysis(df)).collect()}
    assert (out[1].companyName, out[1].sentiment, out[1].error) == ("A", "0.75", None)
    assert (out[2].error, out[2].raw_response, out[2].sentiment) == ("Invalid JSON from GPT", "{broken", None)
    flags = {i: (r.score_in_range, r.score_two_decimals, r.few_keywords, r.keywords_in_text) for i, r in out.items()}
    assert flags == {1: (True, True, True, True), 2: (False, False, True, True), 3: (False, False, False, True), 4: (True, True, True, False)}


def test_scoring_keeps_failed_articles(spark):
    def make():
        def score(text):
            if "bad" in text:
                raise RuntimeError("no answer")
            return text[len(chat.ARTICLE_INTRO) : -len(chat.ARTICLE_REQUEST)].upper()

        return score

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, ""), (4, None)], "id int, content string")
    out = {r.id: (r.response, r.error) for r in chat.score_articles(df, make).collect()}
    assert out == {1: ("GOOD", None), 2: (None, "RuntimeError: no answer")}


def test_prompts(spark):
    df = spark.createDataFrame([("body",)], "content string")
    system, user = chat.build_prompts(df).first().messages
    assert system.role == "system" and user.role == "user" and user.content == chat.ARTICLE_INTRO + "body" + chat.ARTICLE_REQUEST
    more = chat.with_system_prompt(chat.build_prompts(df), system="be kind").first().messages
    assert [m.role for m in more] == ["system", "system", "user"] and more[0].content == "be kind"


def test_json_lines_keep_text(spark):
    df = spark.createDataFrame([(json.dumps({"games": [{"a": "ü"}, {"b": [1, 2]}]}, ensure_ascii=False),)], "doc string")
    assert [json.loads(r.line) for r in chat.to_jsonl(df).collect()] == [{"a": "ü"}, {"b": [1, 2]}]


def direct_blocks(lines):
    out, block, start = [], None, None
    for no, line in enumerate(lines):
        if line.strip() == "{":
            block, start = "{", no
        elif line.strip() == "}" and block is not None:
            try:
                out.append((start, json.loads(block + "}")))
            except ValueError:
                pass
            block = None
        elif block is not None:
            block += line + "\n"
    return out


@pytest.mark.parametrize("part", [3, 65_536])
def test_blocks(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "LINES_PER_PART", part)
    files = {
        "a": ["before", "{", '"x": 1,', '"y": "two"', "}", "between", " { ", '"x": ', "3", " }", "}"],
        "b": ["{", "lost", "{", '"k": [1,', "2]", "}", "{", "bad", "}", "{", '"open": 1'],
        "c": ["}", "nothing", "{", "}"],
        "d": ["{"] + ['"long":'] + [""] * 20 + ["5", "}"],
    }
    rows = [(f, i, line) for f, lines in files.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, line string").repartition(4)
    mine = sorted((r.file, r.start, json.loads(r.json)) for r in chat.reassemble_blocks(df).collect())
    assert mine == sorted((f, no, doc) for f, lines in files.items() for no, doc in direct_blocks(lines))
    short = sorted((r.file, r.start) for r in chat.reassemble_blocks(df, max_lines=10).collect())
    assert short == sorted((f, no) for f, lines in files.items() for no, _ in direct_blocks(lines) if f != "d")
