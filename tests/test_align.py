from parlance.model import DatasetSpec
from parlance.operators import align, blocks, checks
from parlance.sources.catalog import parse_entry, resolve
import pytest

TURNS = "array<struct<role string, content string>>"
TAGGED = "array<struct<`from` string, value string>>"
CHAT = DatasetSpec(formatting="openai", messages="messages", role_tag="role", content_tag="content", user_tag="user",
                   assistant_tag="assistant", observation_tag="tool", function_tag="function", system_tag="system", tools="tools")


def plain(turns):
    return [(t["role"], t["content"]) for t in turns]


def test_alpaca_joins_prompt_and_query_by_newline(spark):
    df = spark.createDataFrame(
        [("Solve the math problem.", "3 + 4", "The answer is 7.", None), ("a", "", None, [["q", "r"]]), ("a", None, "", None)],
        "instruction string, input string, output string, history array<array<string>>",
    )
    rows = align.align(df, DatasetSpec(history="history")).collect()
    assert plain(rows[0]["_prompt"]) == [("user", "Solve the math problem.\n3 + 4")]
    assert plain(rows[0]["_response"]) == [("assistant", "The answer is 7.")]
    assert rows[0]["_system"] == "" and rows[0]["_tools"] == "" and rows[0]["_images"] is None
    assert plain(rows[1]["_prompt"]) == [("user", "q"), ("assistant", "r"), ("user", "a")]
    assert rows[1]["_response"] == []  # no answer: unsupervised
    assert plain(rows[2]["_response"]) == [("assistant", "")]  # an empty answer is still an answer


def test_kto_marks_the_class_by_the_empty_answer(spark):
    df = spark.createDataFrame([("q", "good", True), ("q", "bad", False)], "instruction string, output string, tag boolean")
    rows = align.align(df, DatasetSpec(query=None, kto_tag="tag")).collect()
    assert [t["content"] for t in rows[0]["_response"]] == ["good", ""]
    assert [t["content"] for t in rows[1]["_response"]] == ["", "bad"]


def test_sharegpt_system_parity_and_broken_rows(spark):
    df = spark.createDataFrame([
        (1, [("system", "S"), ("human", "Solve"), ("gpt", "7")]), (2, [("human", "a"), ("human", "b")]),
        (3, [("human", "a")]), (4, [("human", "a"), ("function_call", "f"), ("observation", "o"), ("gpt", "z")]),
    ], f"id int, conversations {TAGGED}")
    rows = {r["id"]: r for r in align.align(df, DatasetSpec(formatting="sharegpt"), ["id"]).collect()}
    assert rows[1]["_system"] == "S" and plain(rows[1]["_prompt"]) == [("user", "Solve")]
    assert rows[2]["_prompt"] == [] and rows[2]["_response"] == [] and rows[3]["_prompt"] == []
    assert plain(rows[4]["_prompt"]) == [("user", "a"), ("function", "f"), ("observation", "o")]
    aligned = align.align(df, DatasetSpec(formatting="sharegpt"), ["id"])
    assert sorted(r["id"] for r in checks.drop_invalid(aligned, "sft").collect()) == [1, 4]


def test_openai_tool_outputs_merge_and_late_ones_are_lost(spark):
    messages = ("array<struct<role string, content string, tool_calls array<struct<function struct<name string, arguments string>>>>>")
    df = spark.createDataFrame([(
        [("system", "S", None), ("user", "hi", None), ("assistant", None, [(("f", '{"x": 1}'),)]), ("tool", "r1", None),
         ("tool", "r2", None), ("assistant", "done", None), ("tool", "late", None)], "[]"), ([("user", "a", None), ("assistant", "b", None)], "")],
        f"messages {messages}, tools string")
    first, second = align.align(df, CHAT).collect()
    assert plain(first["_prompt"])[1:] == [
        ("function", '[{"name": "f", "arguments": "{\\"x\\": 1}"}]'), ("observation", "r1\n</tool_response>\n<tool_response>\nr2")]
    assert plain(first["_response"]) == [("assistant", "done")]
    assert first["_system"] == "S\n"
    assert second["_system"] == "detailed thinking off"


def test_catalog_maps_replace_defaults():
    spec = parse_entry({"file_name": "x.json", "columns": {"prompt": "text"}})
    assert spec.prompt == "text" and spec.query is None and spec.response is None
    assert parse_entry({"file_name": "x.json"}).response == "output"
    with pytest.raises(ValueError):
        resolve({"a": {"file_name": "x", "ranking": True}}, "a", "sft")
    assert resolve({"a": {"file_name": "x", "ranking": True}}, "a", "rm").ranking


def test_converter_registry():
    align.register_converter("mine", lambda df, spec, keep=(): df)
    with pytest.raises(ValueError):
        align.register_converter("mine", lambda df, spec, keep=(): df)


def test_blocks_media_prefixes_and_calls(spark):
    df = spark.createDataFrame([(
        [("system", "S"), ("human", "q <image> and <image>"), ("function_call", '{"name":"f","arguments":{"x":1}}'), ("odd", "x"),
         ("function_call", "{no"), ("observation", "<image>!"), ("gpt", "end")], ["p1", "p2", "p3"])],
        f"conversations {TAGGED}, images array<string>")
    out = blocks.to_blocks_sharegpt(df)
    row = out.collect()[0]
    assert [m["role"] for m in row["messages"]] == ["system", "user", "assistant", "tool", "assistant"]
    assert [(b["type"], b["value"]) for b in row["messages"][1]["content"]] == [
        ("text", "q "), ("image_url", "p1"), ("text", " and "), ("image_url", "p2")]
    assert row["messages"][3]["content"][0]["value"] == "p3" and row["media_error"] is None
    assert [m["loss_weight"] for m in row["messages"]] == [0, 0, 1, 0, 1]
    assert sorted(r["cut"] for r in blocks.expand_prefixes(out).collect()) == [3, 5]
    chat = blocks.to_chat_rows(out).collect()[0]
    assert chat["chat"][2]["tool_calls"][0]["name"] == "f" and not chat["call_error"]
    two = spark.createDataFrame([("<image>", ["a", "b"]), ("<image><image>", ["a"])], "text string, images array<string>")
    errors = [r["media_error"] for r in blocks.split_media_blocks(two).collect()]
    assert errors[0].startswith("Fewer <image>") and errors[1].startswith("More <image>")


def test_alpaca_blocks_join_with_nothing_between(spark):
    df = spark.createDataFrame([("a", "b", "c")], "instruction string, input string, output string")
    row = blocks.to_blocks_alpaca(df).collect()[0]["messages"]
    assert row[0]["content"][0]["value"] == "ab" and [m["loss_weight"] for m in row] == [0.0, 1.0]


def test_role_assertion_fails_the_job(spark):
    df = spark.createDataFrame([([("system", "a"), ("user", "b")],)], f"messages {TURNS}")
    with pytest.raises(Exception, match="system/user/assistant"):
        checks.assert_roles(df).collect()
