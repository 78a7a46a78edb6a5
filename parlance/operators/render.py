"""Dialogues to text: templates as a table, tool lists, tool calls, thoughts, few-shot prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.hashing import draw
from parlance.functions.ranks import rank_by_hash
from parlance.functions.text import json_string, let, spaced_json
from parlance.model import TURNS

# Prompt texts and marks of the two tool layouts.
DEFAULT_TOOL_HEAD = "You have access to the following tools:\n"
DEFAULT_TOOL_TAIL = (
    "Use the following format if using a tool:\n```\nAction: tool name (one of [{names}])\n"
    "Action Input: the input to the tool, in a JSON format representing the kwargs "
    '(e.g. ```{"input": "hello world", "num_beams": 5}```)\n```\n'
)
TAGGED_TOOL_HEAD = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TAGGED_TOOL_TAIL = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments within "
    '<tool_call></tool_call> XML tags:\n<tool_call>\n{"name": <function-name>, '
    '"arguments": <args-json-object>}\n</tool_call>'
)
ACTION_CALL = r"(?s)Action:\s*([a-zA-Z0-9_]+)\s*Action Input:\s*(.+?)(?=\s*Action:|\s*$)"
TAGGED_CALL = r"(?s)<tool_call>(.+?)</tool_call>(?=\s*<tool_call>|\s*$)"
THOUGHT_WORDS = ("<think>\n", "\n</think>\n\n")

_TOOL_SCHEMA = (
    "array<struct<type:string,function:{f},name:string,description:string,parameters:{p}>>"
)
_PARAMS = (
    "struct<properties:map<string,struct<type:string,description:string,enum:array<string>,"
    "items:struct<type:string>>>,required:array<string>>"
)
TOOL_SCHEMA = _TOOL_SCHEMA.format(f=f"struct<name:string,description:string,parameters:{_PARAMS}>", p=_PARAMS)


def fill_slot(slot: Column, name: str, value: Column) -> Column:
    """The first ``{{name}}`` of a slot replaced by a value."""
    mark = "{{" + name + "}}"
    at = F.locate(mark, slot)
    filled = F.concat(
        F.substr(slot, F.lit(1), F.greatest(at - 1, F.lit(0))), value, F.substr(slot, at + len(mark))
    )
    return F.when(at > 0, filled).otherwise(slot)


def render(df: DataFrame, templates: DataFrame, messages: str = "messages", system: str = "_system",
           tool_text: str | None = None) -> DataFrame:
    """``segments``: one text per turn. The template of a row is the one named in its ``template`` column.

    Template columns: template, prefix, system, user, assistant, observation, function, default_system.
    The first turn carries prefix, system text and tool text.
    """
    slots = ("prefix", "system", "user", "assistant", "observation", "function", "default_system")
    named = templates.select("template", *[F.col(s).alias(f"_t_{s}") for s in slots])
    rows = df.join(named, "template")
    sys_text = F.when(F.coalesce(F.col(system), F.lit("")) != "", F.col(system)).otherwise(
        F.coalesce("_t_default_system", F.lit(""))
    )
    tools = F.coalesce(F.col(tool_text), F.lit("")) if tool_text else F.lit("")
    tools = F.when(sys_text == "", F.ltrim(tools, F.lit("\n"))).otherwise(tools)
    head = F.concat(
        F.coalesce("_t_prefix", F.lit("")),
        F.when(F.concat(sys_text, tools) != "", fill_slot(F.col("_t_system"), "content", F.concat(sys_text, tools)))
        .otherwise(F.lit("")),
    )
    rows = rows.withColumn("_head", head)

    def segment(m: Column, i: Column) -> Column:
        slot = F.when(m["role"] == "user", F.col("_t_user"))
        for role in ("assistant", "observation", "function"):
            slot = slot.when(m["role"] == role, F.col(f"_t_{role}"))
        slot = slot.otherwise(F.raise_error(F.concat(F.lit("unexpected role: "), m["role"])))
        text = fill_slot(slot, "content", m["content"])
        text = F.when(m["role"] == "user", fill_slot(text, "idx", F.floor(i / 2).cast("string"))).otherwise(text)
        return F.concat(F.when(i == 0, F.col("_head")).otherwise(F.lit("")), text)

    rows = rows.withColumn("segments", F.transform(messages, segment))
    return rows.drop("_head", *[f"_t_{s}" for s in slots])


def render_tools(df: DataFrame, tools: str = "_tools", layout: str = "default", out: str = "tool_text") -> DataFrame:
    """A JSON tool list as prompt text."""
    if layout == "default":
        parsed = F.from_json(F.col(tools), TOOL_SCHEMA)

        def flat(t: Column) -> Column:
            inner = t["type"] == "function"
            return F.struct(
                F.when(inner, t["function"]["name"]).otherwise(t["name"]).alias("name"),
                F.when(inner, t["function"]["description"]).otherwise(t["description"]).alias("description"),
                F.when(inner, t["function"]["parameters"]).otherwise(t["parameters"]).alias("parameters"),
            )

        def argument(required: Column):
            def line(e: Column) -> Column:
                p = e["value"]
                return F.concat(
                    F.lit("  - "), e["key"], F.lit(" ("), F.coalesce(p["type"], F.lit("")),
                    F.when(F.array_contains(required, e["key"]), F.lit(", required")).otherwise(F.lit("")),
                    F.lit("): "), F.coalesce(p["description"], F.lit("")),
                    F.when(
                        F.size(p["enum"]) > 0,
                        F.concat(F.lit(", should be one of ["), F.array_join(p["enum"], ", "), F.lit("]")),
                    ).otherwise(F.lit("")),
                    F.when(
                        p["items"].isNotNull(),
                        F.concat(F.lit(", where each item should be "), F.coalesce(p["items"]["type"], F.lit(""))),
                    ).otherwise(F.lit("")),
                    F.lit("\n"),
                )
            return line

        def tool(t: Column) -> Column:
            required = F.coalesce(t["parameters"]["required"], F.array().cast("array<string>"))
            entries = F.map_entries(t["parameters"]["properties"])
            args = F.array_join(F.transform(entries, argument(required)), "")
            return F.concat(
                F.lit("> Tool Name: "), t["name"], F.lit("\nTool Description: "),
                F.coalesce(t["description"], F.lit("")), F.lit("\nTool Args:\n"), args, F.lit("\n"),
            )

        flat_tools = F.transform(parsed, flat)
        names = F.array_join(F.transform(flat_tools, lambda t: t["name"]), ", ")
        before, after = DEFAULT_TOOL_TAIL.split("{names}")
        text = F.concat(
            F.lit(DEFAULT_TOOL_HEAD), F.array_join(F.transform(flat_tools, tool), ""),
            F.lit(before), names, F.lit(after),
        )
    elif layout == "tagged":
        items = F.from_json(F.col(tools), "array<string>")

        def line(t: Column) -> Column:
            wrapped = F.when(F.get_json_object(t, "$.type") == "function", t).otherwise(
                F.concat(F.lit('{"type":"function","function":'), t, F.lit("}"))
            )
            return F.concat(F.lit("\n"), spaced_json(wrapped))

        text = F.concat(
            F.lit(TAGGED_TOOL_HEAD), F.array_join(F.transform(items, line), ""), F.lit(TAGGED_TOOL_TAIL)
        )
    else:
        raise ValueError(f"unknown tool layout {layout!r}")
    return df.withColumn(out, F.when(F.col(tools) != "", text))


def _calls(text: Column) -> Column:
    """Call list of a function turn: name and arguments as spaced JSON."""
    items = F.from_json(text, "array<struct<name:string,arguments:string>>")
    typed = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    one = F.array(F.try_parse_json(text))
    variants = F.coalesce(typed, one)

    def fix(c: Column, v: Column) -> Column:
        quoted = F.schema_of_variant(F.try_variant_get(v, "$.arguments", "variant")) == "STRING"
        return F.struct(
            c["name"].alias("name"),
            F.when(quoted, json_string(c["arguments"])).otherwise(spaced_json(c["arguments"])).alias("arguments"),
        )

    return F.zip_with(items, variants, fix)


def calls_text(calls: Column, layout: str) -> Column:
    if layout == "default":
        each = lambda c: F.concat(F.lit("Action: "), c["name"], F.lit("\nAction Input: "), c["arguments"])
    elif layout == "tagged":
        each = lambda c: F.concat(
            F.lit('<tool_call>\n{"name": '), json_string(c["name"]), F.lit(', "arguments": '), c["arguments"],
            F.lit("}\n</tool_call>"),
        )
    else:
        raise ValueError(f"unknown tool layout {layout!r}")
    return F.array_join(F.transform(calls, each), "\n")


def render_calls(df: DataFrame, content: str = "content", layout: str = "default", out: str = "call_text",
                 thought: Sequence[str] = THOUGHT_WORDS) -> DataFrame:
    """A function turn (JSON call or list, optionally after a thought span) as call text; bad JSON gives null."""
    span = F.regexp_extract(F.col(content), f"(?s)({_quote(thought[0])}.*?{_quote(thought[1])})", 1)
    df = df.withColumn("_span", span).withColumn(
        "_json", F.when(F.col("_span") != "", F.replace(F.col(content), F.col("_span"), F.lit(""))).otherwise(F.col(content))
    )
    good = F.try_parse_json("_json").isNotNull()
    text = F.concat(F.col("_span"), calls_text(_calls(F.col("_json")), layout))
    return df.withColumn(out, F.when(good, text)).drop("_span", "_json")


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def extract_calls(df: DataFrame, content: str = "content", layout: str = "default", out: str = "calls") -> DataFrame:
    """Tool calls of generated text; null where there is no call or one is unreadable (the text stays as it is)."""
    text = F.col(content)
    if layout == "default":
        names = F.regexp_extract_all(text, F.lit(ACTION_CALL), F.lit(1))
        inputs = F.transform(
            F.regexp_extract_all(text, F.lit(ACTION_CALL), F.lit(2)),
            lambda x: F.btrim(F.btrim(F.btrim(x, F.lit(" \t\r\n")), F.lit('"')), F.lit("`")),
        )
        found = F.zip_with(names, inputs, lambda n, a: F.struct(n.alias("name"), a.alias("arguments")))
        fine = F.forall(found, lambda c: F.try_parse_json(c["arguments"]).isNotNull())
        calls = F.transform(
            found,
            lambda c: F.struct(c["name"].alias("name"), spaced_json(F.to_json(F.try_parse_json(c["arguments"]))).alias("arguments")),
        )
    elif layout == "tagged":
        found = F.transform(
            F.regexp_extract_all(text, F.lit(TAGGED_CALL), F.lit(1)), lambda x: F.try_parse_json(F.btrim(x, F.lit(" \t\r\n")))
        )
        fine = F.forall(
            found,
            lambda v: F.coalesce(
                F.try_variant_get(v, "$.name", "string").isNotNull()
                & F.try_variant_get(v, "$.arguments", "variant").isNotNull(), F.lit(False)
            ),
        )
        calls = F.transform(
            found,
            lambda v: F.struct(
                F.try_variant_get(v, "$.name", "string").alias("name"),
                spaced_json(F.to_json(F.try_variant_get(v, "$.arguments", "variant"))).alias("arguments"),
            ),
        )
    else:
        raise ValueError(f"unknown tool layout {layout!r}")
    return df.withColumn(out, F.when((F.size(found) > 0) & fine, calls))


def strip_thought(text: Column, words: Sequence[str] = THOUGHT_WORDS) -> Column:
    pattern = f"(?s){_quote(words[0])}(.*?){_quote(words[1])}"
    return F.ltrim(F.regexp_replace(text, pattern, ""), F.lit("\n"))


def thoughts(df: DataFrame, mode: str = "history", enable_thinking: bool = False, messages: str = "messages",
             words: Sequence[str] = THOUGHT_WORDS) -> DataFrame:
    """Thought spans stripped from answers; an empty thought goes where a kept answer has none.

    ``mode``: ``all``, ``history`` (the last answer keeps its thought) or ``none``. The empty thought lands in
    ``trail`` of the prompt turn (no loss) or in ``lead`` of the answer (``enable_thinking``).
    """
    answer = lambda i: i % 2 == 1
    strip = {
        "all": lambda i, n: answer(i),
        "history": lambda i, n: answer(i) & (i < n - 2),
        "none": lambda i, n: F.lit(False),
    }[mode]
    blank = F.lit(words[0] + words[1])
    cleaned = let(F.col(messages), lambda ms: F.transform(
        ms,
        lambda m, i: F.struct(
            m["role"].alias("role"),
            F.when(strip(i, F.size(ms)), strip_thought(m["content"], words)).otherwise(m["content"]).alias("content"),
        ),
    ))

    def bare(m: Column) -> Column:
        return ~m["content"].contains(words[0].strip()) & ~m["content"].contains(words[1].strip())

    def place(ms: Column, m: Column, i: Column) -> Column:
        n = F.size(ms)
        own = answer(i) & bare(m)
        nxt = F.get(ms, i + 1)
        before = ~answer(i) & (i + 1 < n) & F.coalesce(bare(nxt), F.lit(False))
        if mode == "history":
            own, before = own & (i == n - 1), before & (i == n - 2)
        return F.struct(
            m["role"].alias("role"), m["content"].alias("content"),
            F.when(own & F.lit(enable_thinking), blank).otherwise(F.lit("")).alias("lead"),
            F.when(before & F.lit(not enable_thinking), blank).otherwise(F.lit("")).alias("trail"),
        )

    return df.withColumn(messages, let(cleaned, lambda ms: F.transform(ms, lambda m, i: place(ms, m, i))))


def neutralise(df: DataFrame, tokens: Sequence[str], column: str = "text") -> DataFrame:
    """Control-token strings broken by a zero-width space after their first character, longest first."""
    text = F.col(column)
    for token in sorted((t for t in tokens if len(t) >= 2), key=len, reverse=True):
        text = F.replace(text, F.lit(token), F.lit(token[0] + "​" + token[1:]))
    return df.withColumn(column, text)


# The multiple-choice prompt in two languages.
MCQ_TEMPLATES = {
    "en": ("The following are multiple choice questions (with answers) about {subject}.\n\n", "\nAnswer:"),
    "zh": ("以下是中国关于{subject}考试的单项选择题，请选出其中的正确答案。\n\n", "\n答案："),
}
CHOICES = ("A", "B", "C", "D")


def mcq_prompt(df: DataFrame, language: str = "en") -> Column:
    lines = [F.concat(F.lit(f"\n{c}. "), F.col(c)) for c in CHOICES if c in df.columns]
    return F.concat(F.col("question"), *lines, F.lit(MCQ_TEMPLATES[language][1]))


def fewshot(df: DataFrame, examples: DataFrame, k: int, key: str, example_key: str, seed: int = 0,
            language: str = "en", subject: str = "subject") -> DataFrame:
    """Multiple-choice dialogue: k examples of the subject (hash order), then the target; header first."""
    ex = examples.withColumn("_h", draw(seed, F.col(example_key)))
    ex = rank_by_hash(ex, "_h", [subject], [example_key], out="_o").where(F.col("_o") < k)
    shots = ex.select(
        subject, "_o", F.array(
            F.struct(F.lit("user").alias("role"), mcq_prompt(examples, language).alias("content")),
            F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")),
        ).alias("_pair"),
    ).groupBy(subject).agg(F.array_sort(F.collect_list(F.struct("_o", "_pair"))).alias("_s"))
    shots = shots.select(subject, F.flatten(F.transform("_s", lambda s: s["_pair"])).alias("_shots"))
    own = F.array(
        F.struct(F.lit("user").alias("role"), mcq_prompt(df, language).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")),
    )
    empty = F.array().cast(TURNS)
    rows = df.join(shots, subject, "left").withColumn("messages", F.concat(F.coalesce("_shots", empty), own.cast(TURNS)))
    head, tail = MCQ_TEMPLATES[language][0].split("{subject}")
    header = F.concat(F.lit(head), F.col(subject), F.lit(tail))
    return rows.withColumn(
        "messages",
        F.transform(
            "messages",
            lambda m, i: m.withField("content", F.when(i == 0, F.concat(header, m["content"])).otherwise(m["content"])),
        ),
    ).drop("_shots")
