"""Raw instruction, chat and preference tables to one canonical dialogue row.

Output columns: ``_prompt``, ``_response`` (arrays of turns), ``_system``, ``_tools``
(text), ``_images``, ``_videos``, ``_audios`` (path arrays or null). Columns named
in ``keep`` travel along; every other source column is dropped. All expressions
run inside the JVM, so the same functions serve batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import spaced_json
from parlance.model import TURNS, DatasetSpec

# Separators and default texts of the chat layout.
TOOL_RESPONSE_JOIN = "\n</tool_response>\n<tool_response>\n"
SHORT_SYSTEM = "detailed thinking off"
LONG_SYSTEM = "detailed thinking on"


def turn(role, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.cast("string").alias("content"))


def no_turns() -> Column:
    return F.array().cast(TURNS)


def _col(df: DataFrame, name: str | None, default=None) -> Column:
    return F.col(name) if name and name in df.columns else F.lit(default).cast("string")


def _media(df: DataFrame, name: str | None) -> Column:
    """A single path becomes a list; an empty list becomes null."""
    if not name or name not in df.columns:
        return F.lit(None).cast("array<string>")
    kind = df.schema[name].dataType.simpleString()
    listed = F.array(F.col(name)) if kind == "string" else F.col(name)
    return F.when(F.col(name).isNotNull() & (F.size(listed) > 0), listed)


def _canonical(df: DataFrame, spec: DatasetSpec, keep: Sequence[str], prompt: Column, response: Column,
               system: Column, tools: Column) -> DataFrame:
    return df.select(
        *keep,
        prompt.cast(TURNS).alias("_prompt"),
        response.cast(TURNS).alias("_response"),
        system.alias("_system"),
        tools.alias("_tools"),
        _media(df, spec.images).alias("_images"),
        _media(df, spec.videos).alias("_videos"),
        _media(df, spec.audios).alias("_audios"),
    )


def _kto(tag: Column, answers: Column) -> Column:
    """The empty answer marks the class: last for a desired answer, first for an undesired one."""
    blank = F.array(turn("assistant", F.lit("")))
    return F.when(tag, F.concat(answers, blank)).otherwise(F.concat(blank, answers))


def align_alpaca(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    past = no_turns()
    if spec.history and spec.history in df.columns:
        past = F.coalesce(
            F.flatten(F.transform(spec.history, lambda h: F.array(turn("user", h[0]), turn("assistant", h[1])))),
            no_turns(),
        )
    asked = F.filter(F.array(_col(df, spec.prompt), _col(df, spec.query)), lambda x: x.isNotNull() & (x != ""))
    prompt = F.concat(past, F.array(turn("user", F.array_join(asked, "\n"))))

    answer = _col(df, spec.response)
    plain = (
        F.when(answer.isNotNull(), F.array(turn("assistant", answer))).otherwise(no_turns())
        if spec.response else no_turns()
    )
    response = plain
    if spec.ranking and spec.chosen and spec.rejected:
        chosen, rejected = _col(df, spec.chosen), _col(df, spec.rejected)
        response = F.when(
            chosen.isNotNull() & rejected.isNotNull(),
            F.array(turn("assistant", chosen), turn("assistant", rejected)),
        ).otherwise(plain)
    if spec.kto_tag:
        tag = F.col(spec.kto_tag)
        response = F.when(tag.isNotNull(), _kto(tag, F.array(turn("assistant", answer)))).otherwise(response)

    system = _col(df, spec.system) if spec.system else F.lit("")
    tools = _col(df, spec.tools) if spec.tools else F.lit("")
    return _canonical(df, spec, keep, prompt, response, system, tools)


def _system_split(df: DataFrame, spec: DatasetSpec) -> tuple[Column, Column, Column]:
    """(body messages, system text, whether the first message was the system turn)."""
    raw = F.col(spec.messages)
    if spec.system_tag:
        leads = (F.size(raw) > 0) & (F.get(raw, F.lit(0))[spec.role_tag] == spec.system_tag)
        leads = F.coalesce(leads, F.lit(False))
    else:
        leads = F.lit(False)
    body = F.when(leads, F.slice(raw, F.lit(2), F.greatest(F.size(raw), F.lit(1)))).otherwise(raw)
    given = _col(df, spec.system) if spec.system else F.lit("")
    text = F.when(leads, F.get(raw, F.lit(0))[spec.content_tag]).otherwise(given)
    return body, text, leads


def _role_map(spec: DatasetSpec) -> Column:
    pairs = (
        (spec.user_tag, "user"), (spec.assistant_tag, "assistant"), (spec.observation_tag, "observation"),
        (spec.function_tag, "function"), (spec.system_tag, "system"),
    )
    named = [F.lit(x) for tag, role in pairs if tag for x in (tag, role)]
    return F.create_map(*named)


def alternates(messages: Column, odd: Sequence[str], even: Sequence[str], role: str = "role") -> Column:
    """Whether roles at positions 0,2,.. are in ``odd`` and at 1,3,.. in ``even``."""
    placed = F.transform(
        messages,
        lambda m, i: F.when(i % 2 == 0, m[role].isin(list(odd))).otherwise(m[role].isin(list(even))),
    )
    return F.forall(placed, lambda ok: F.coalesce(ok, F.lit(False)))


def _split_answer(df: DataFrame, spec: DatasetSpec, good: Column, aligned: Column) -> tuple[Column, Column]:
    head = F.slice(aligned, F.lit(1), F.greatest(F.size(aligned) - 1, F.lit(0)))
    last = F.slice(aligned, F.greatest(F.size(aligned), F.lit(1)), F.lit(1))
    prompt, response = head, last
    if spec.ranking and spec.chosen and spec.rejected:
        roles = _role_map(spec)
        two = F.array(*[
            turn(F.element_at(roles, F.col(name)[spec.role_tag]), F.col(name)[spec.content_tag])
            for name in (spec.chosen, spec.rejected)
        ])
        paired = F.col(spec.chosen).isNotNull() & F.col(spec.rejected).isNotNull()
        prompt = F.when(paired, aligned).otherwise(prompt)
        response = F.when(paired, two).otherwise(response)
    if spec.kto_tag:
        tag = F.col(spec.kto_tag)
        prompt = F.when(tag.isNotNull(), head).otherwise(prompt)
        response = F.when(tag.isNotNull(), _kto(tag, last)).otherwise(response)
    return F.when(good, prompt).otherwise(no_turns()), F.when(good, response).otherwise(no_turns())


def align_sharegpt(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Broken rows (wrong alternation or parity) keep their place with empty turn arrays."""
    body, system, _ = _system_split(df, spec)
    roles = _role_map(spec)
    odd = [t for t in (spec.user_tag, spec.observation_tag) if t]
    even = [t for t in (spec.assistant_tag, spec.function_tag) if t]
    df = df.withColumn("_body", F.coalesce(body, F.filter(F.col(spec.messages), lambda m: F.lit(False))))
    placed = alternates(F.col("_body"), odd, even, spec.role_tag)
    parity = F.size("_body") % 2 == (1 if spec.ranking else 0)
    aligned = F.transform("_body", lambda m: turn(F.element_at(roles, m[spec.role_tag]), m[spec.content_tag]))
    good = F.coalesce(placed & parity, F.lit(False))
    prompt, response = _split_answer(df, spec, good, aligned)
    tools = _col(df, spec.tools) if spec.tools else F.lit("")
    return _canonical(df, spec, keep, prompt, response, system, tools)


def align_openai(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Tool calls become one function turn; consecutive tool outputs become one observation turn.

    Outputs after the last other turn are not flushed: they are lost, as the rule demands.
    """
    body, system, _ = _system_split(df, spec)
    message_type = df.schema[spec.messages].dataType.elementType
    df = df.withColumn("_body", body)

    def as_turn(m: Column) -> Column:
        role, content = m[spec.role_tag], m[spec.content_tag]
        if "tool_calls" in message_type.names:
            called = spaced_json(F.to_json(F.transform(m["tool_calls"], lambda t: t["function"])))
            calls = role.isin(spec.assistant_tag, spec.function_tag) & (F.size(m["tool_calls"]) > 0)
            content = F.when(calls, called).otherwise(content)
            role = F.when(calls, F.lit(spec.function_tag)).otherwise(role)
        return F.struct(role.alias("role"), content.alias("content"))

    roles = _role_map(spec)
    start = F.struct(no_turns().alias("done"), F.array().cast("array<string>").alias("held"))

    def step(state: Column, m: Column) -> Column:
        flushed = F.when(
            F.size(state["held"]) > 0,
            F.concat(state["done"], F.array(turn("observation", F.array_join(state["held"], TOOL_RESPONSE_JOIN)))),
        ).otherwise(state["done"])
        holds = m["role"] == F.lit(spec.observation_tag)
        return F.when(
            holds,
            F.struct(state["done"].alias("done"), F.concat(state["held"], F.array(m["content"])).alias("held")),
        ).otherwise(
            F.struct(
                F.concat(flushed, F.array(turn(F.element_at(roles, m["role"]), m["content"]))).alias("done"),
                F.array().cast("array<string>").alias("held"),
            )
        )

    df = df.withColumn("_aligned", F.aggregate(F.transform("_body", as_turn), start, step, lambda s: s["done"]))
    placed = alternates(F.col("_aligned"), ("user", "observation"), ("assistant", "function"))
    parity = F.size("_aligned") % 2 == (1 if spec.ranking else 0)
    good = F.coalesce(placed & parity, F.lit(False))
    prompt, response = _split_answer(df, spec, good, F.col("_aligned"))

    tools = F.lit("")
    if spec.tools and spec.tools in df.columns:
        kind = df.schema[spec.tools].dataType.simpleString()
        tools = F.col(spec.tools) if kind == "string" else F.to_json(spec.tools)
    no_tools = F.coalesce(tools, F.lit("")) == ""
    no_system = F.coalesce(system, F.lit("")) == ""
    settled = system.contains(LONG_SYSTEM) | system.contains(SHORT_SYSTEM)
    system = (
        F.when(no_system & no_tools, F.lit(SHORT_SYSTEM))
        .when(no_system, system)
        .when(no_tools & settled, system)
        .when(no_tools, F.concat(system, F.lit("\n" + SHORT_SYSTEM)))
        .otherwise(F.concat(system, F.lit("\n")))
    )
    return _canonical(df, spec, keep, prompt, response, system, tools)


Converter = Callable[..., DataFrame]
_CONVERTERS: dict[str, Converter] = {
    "alpaca": align_alpaca,
    "sharegpt": align_sharegpt,
    "openai": align_openai,
}


def register_converter(name: str, converter: Converter) -> None:
    """Add a table layout: a function (DataFrame, DatasetSpec, keep) -> canonical DataFrame."""
    if name in _CONVERTERS:
        raise ValueError(f"converter {name!r} is already registered")
    _CONVERTERS[name] = converter


def align(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    if spec.formatting not in _CONVERTERS:
        raise ValueError(f"no converter {spec.formatting!r}; known: {sorted(_CONVERTERS)}")
    return _CONVERTERS[spec.formatting](df, spec, keep)


def dealias(df: DataFrame, plan: str, tools: str, aliases: str) -> DataFrame:
    """Alias tool names back to real names, in the plan and the tool list.

    ``plan`` and ``tools`` are arrays of structs with a ``name`` member; ``aliases`` is a map real -> alias.
    A plan name outside the map becomes ``unaliased:<name>``; ``alias_error`` flags an unknown tool name.
    """
    back = F.map_from_entries(
        F.transform(
            F.map_entries(F.coalesce(F.col(aliases), F.create_map().cast("map<string,string>"))),
            lambda e: F.struct(e["value"], e["key"]),
        )
    )
    df = df.withColumn("_back", back)
    has_map = F.size("_back") > 0

    def real(name: Column) -> Column:
        known = F.element_at(F.col("_back"), name)
        return F.when(name.isNull() | ~has_map, name).otherwise(F.coalesce(known, F.concat(F.lit("unaliased:"), name)))

    unknown = has_map & F.exists(
        tools, lambda t: t["name"].isNull() | ~F.array_contains(F.map_keys("_back"), F.coalesce(t["name"], F.lit("")))
    )
    return (
        df.withColumn("alias_error", F.coalesce(unknown, F.lit(False)))
        .withColumn(plan, F.transform(plan, lambda t: t.withField("name", real(t["name"]))))
        .withColumn(tools, F.transform(tools, lambda t: t.withField("name", real(t["name"]))))
        .drop("_back")
    )
