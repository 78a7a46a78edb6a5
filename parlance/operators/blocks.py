"""Typed-block messages: conversion, media tags, prefix expansion, chat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import count_of, let
from parlance.model import BLOCK, MEDIA, MESSAGE

_MARK = "\u0001"
_TAGS = "(" + "|".join(tag for tag, _, _ in MEDIA) + ")"
# Chat tags to message roles of the typed-block layout.
BLOCK_ROLES = {
    "system": "system",
    "human": "user",
    "gpt": "assistant",
    "observation": "tool",
    "function_call": "assistant",
}


def _blocks(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value"))


def _message(role, content: Column, weight) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    weight = F.lit(float(weight)) if isinstance(weight, (int, float)) else weight
    return F.struct(
        role.alias("role"), content.cast(f"array<{BLOCK}>").alias("content"), weight.cast("double").alias("loss_weight")
    )


def media_lists(df: DataFrame) -> dict[str, Column]:
    """Per tag, the row's path list (empty when the column is absent or null)."""
    empty = F.array().cast("array<string>")
    return {tag: F.coalesce(F.col(c), empty) if c in df.columns else empty for tag, _, c in MEDIA}


def media_blocks(text: Column, lists: dict[str, Column], used: dict[str, Column]) -> Column:
    """Text split at media tags, each tag taking the next path after the ``used`` ones."""
    marked = F.regexp_replace(text, _TAGS, f"{_MARK}$1{_MARK}")

    def cut_up(segments: Column) -> Column:
        def block(seg: Column, i: Column) -> Column:
            out = _blocks("text", seg)
            for tag, kind, _ in MEDIA:
                before = F.size(F.filter(F.slice(segments, F.lit(1), i), lambda s: s == tag))
                out = F.when(seg == tag, _blocks(kind, F.get(lists[tag], used[tag] + before))).otherwise(out)
            return out

        return F.filter(F.transform(segments, block), lambda b: (b["type"] != "text") | (b["value"] != ""))

    cut = let(F.split(marked, _MARK), cut_up)
    return F.when(text.rlike(_TAGS), cut).otherwise(F.array(_blocks("text", text)))


def media_error(tag_counts: dict[str, Column], lists: dict[str, Column]) -> Column:
    """The first mismatch between tags and files, or null."""
    rules = []
    for tag, _, _ in MEDIA:
        more = tag_counts[tag] > F.size(lists[tag])
        rules.append(F.when(more, F.lit(f"More {tag} tags than provided media files.")))
    for tag, _, _ in MEDIA:
        spare = F.size(lists[tag]) - tag_counts[tag]
        rules.append(
            F.when(spare > 0, F.concat(F.lit(f"Fewer {tag} tags than provided media files ("), spare, F.lit(" unused).")))
        )
    return F.coalesce(*rules)


def split_media_blocks(df: DataFrame, text: str = "text", out: str = "blocks") -> DataFrame:
    lists = media_lists(df)
    none = {tag: F.lit(0) for tag, _, _ in MEDIA}
    counts = {tag: count_of(F.col(text), tag) for tag, _, _ in MEDIA}
    return df.withColumn(out, media_blocks(F.col(text), lists, none)).withColumn(
        "media_error", media_error(counts, lists)
    )


def _present(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def to_blocks_alpaca(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Instruction and input joined with nothing between; only the output carries loss."""
    lists = media_lists(df)
    system, output = _present(df, "system"), _present(df, "output")
    instruction, given = _present(df, "instruction"), _present(df, "input")
    asked = F.concat(F.coalesce(instruction, F.lit("")), F.coalesce(given, F.lit("")))
    has_user = instruction.isNotNull() | given.isNotNull()
    none = {tag: F.lit(0) for tag, _, _ in MEDIA}
    counts = {tag: F.when(has_user, count_of(asked, tag)).otherwise(0) for tag, _, _ in MEDIA}
    parts = F.array(
        F.when(system.isNotNull(), _message("system", F.array(_blocks("text", system)), 0.0)),
        F.when(has_user, _message("user", media_blocks(asked, lists, none), 0.0)),
        F.when(output.isNotNull(), _message("assistant", F.array(_blocks("text", output)), 1.0)),
    )
    return df.select(*keep, F.array_compact(parts).alias("messages"), media_error(counts, lists).alias("media_error"))


def _call_items(text: Column) -> Column:
    """JSON text to its list of calls (a single object is a list of one); null if it is not JSON."""
    parsed = F.try_parse_json(text)
    many = F.try_variant_get(parsed, "$", "array<variant>")
    return F.when(F.schema_of_variant(parsed).startswith("ARRAY"), many).when(
        parsed.isNotNull(), F.array(parsed)
    )


def _offsets(texts: Column, lists_tags: Sequence[str]) -> Column:
    """Per message, how many tags of each medium came before it."""
    zero = F.struct(
        F.array().cast("array<array<int>>").alias("seen"), F.array(*[F.lit(0) for _ in lists_tags]).alias("sum")
    )

    def step(state: Column, text: Column) -> Column:
        here = F.array(*[count_of(F.coalesce(text, F.lit("")), tag) for tag in lists_tags])
        return F.struct(
            F.concat(state["seen"], F.array(state["sum"])).alias("seen"),
            F.zip_with(state["sum"], here, lambda a, b: a + b).alias("sum"),
        )

    return F.aggregate(texts, zero, step)


def _convert(df: DataFrame, messages: Column, role_key: str, content_key: str, roles: dict[str, str] | None,
             call_tag: str, trained: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """(typed messages, tags used per medium) of one message list."""
    lists = media_lists(df)
    tags = [tag for tag, _, _ in MEDIA]
    known = F.filter(messages, lambda m: m[role_key].isin(list(roles))) if roles else messages
    usable = F.filter(
        known, lambda m: (m[role_key] != call_tag) | F.coalesce(F.try_parse_json(m[content_key]).isNotNull(), F.lit(False))
    )
    plain = F.transform(usable, lambda m: F.when(m[role_key] != call_tag, m[content_key]).otherwise(F.lit("")))
    offsets = _offsets(plain, tags)
    role_map = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv]) if roles else None

    def convert(m: Column, i: Column, state: Column) -> Column:
        used = {tag: F.get(F.get(state["seen"], i), F.lit(k)) for k, tag in enumerate(tags)}
        role = F.element_at(role_map, m[role_key]) if roles else m[role_key]
        calls = F.transform(_call_items(m[content_key]), lambda v: _blocks("tool_call", F.to_json(v)))
        weight = F.when(m[role_key].isin(list(trained)), 1.0).otherwise(0.0)
        content = F.when(m[role_key] == call_tag, calls).otherwise(media_blocks(m[content_key], lists, used))
        return _message(role, content, weight)

    counts = {tag: F.get(offsets["sum"], F.lit(k)) for k, tag in enumerate(tags)}
    return let(offsets, lambda state: F.transform(usable, lambda m, i: convert(m, i, state))), counts


def _valid_json(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.when(F.col(name) != "", F.to_json(F.try_parse_json(name)))


def to_blocks_sharegpt(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Unknown tags and unreadable call turns are skipped; answers and calls carry loss."""
    empty = F.filter("conversations", lambda m: F.lit(False))
    messages, counts = _convert(
        df, F.coalesce("conversations", empty), "from", "value", BLOCK_ROLES, "function_call", ("gpt", "function_call")
    )
    return df.select(
        *keep, messages.alias("messages"), _valid_json(df, "tools").alias("tools"),
        media_error(counts, media_lists(df)).alias("media_error"),
    )


def to_blocks_pair(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Both sides read the same media lists from their start."""
    outs, errors = [], []
    for side in ("chosen", "rejected"):
        messages, counts = _convert(df, F.col(side), "role", "content", None, "tool", ("assistant",))
        outs.append(messages.alias(f"{side}_messages"))
        errors.append(media_error(counts, media_lists(df)))
    return df.select(
        *keep, *outs, _valid_json(df, "tools").alias("tools"), F.coalesce(*errors).alias("media_error")
    )


def expand_prefixes(df: DataFrame, messages: str = "messages") -> DataFrame:
    """One row per supervised assistant turn, ending there; a row with none stays whole (cut is null)."""
    size = F.size(messages)
    supervised = F.filter(
        F.transform(
            messages,
            lambda m, i: F.when(
                (m["role"] == "assistant") & (F.coalesce(m["loss_weight"], F.lit(1.0)) > 1e-6), i + 1
            ),
        ),
        lambda i: i.isNotNull(),
    )
    cuts = F.when(F.coalesce(F.size(supervised), F.lit(0)) > 0, supervised).otherwise(
        F.array(F.lit(None).cast("int"))
    )
    return df.withColumn("cut", F.explode(cuts)).withColumn(
        messages, F.when(F.col("cut").isNotNull(), F.slice(messages, F.lit(1), F.coalesce("cut", size))).otherwise(F.col(messages))
    )


def to_chat_rows(df: DataFrame, messages: str = "messages", media: bool = False) -> DataFrame:
    """Role/content chat messages with reasoning text and tool calls apart; ``call_error`` flags a bad call."""

    def joined(content: Column, kind: str) -> Column:
        return F.array_join(F.transform(F.filter(content, lambda b: b["type"] == kind), lambda b: b["value"]), "")

    def calls(content: Column) -> Column:
        return F.transform(
            F.filter(content, lambda b: b["type"] == "tool_call"),
            lambda b: F.struct(
                F.try_variant_get(F.try_parse_json(b["value"]), "$.name", "string").alias("name"),
                F.to_json(F.try_variant_get(F.try_parse_json(b["value"]), "$.arguments", "variant")).alias("arguments"),
            ),
        )

    def chat(m: Column) -> Column:
        content = m["content"]
        body = joined(content, "text")
        if media:
            body = F.transform(
                F.filter(content, lambda b: ~b["type"].isin("reasoning", "tool_call")),
                lambda b: F.struct(F.regexp_replace(b["type"], "_url$", "").alias("type"), b["value"].alias("value")),
            )
        reasoning = joined(content, "reasoning")
        called = calls(content)
        return F.struct(
            m["role"].alias("role"), body.alias("content"),
            F.when(reasoning != "", reasoning).alias("reasoning_content"),
            F.when(F.size(called) > 0, called).alias("tool_calls"),
        )

    rows = df.withColumn("chat", F.transform(messages, chat))
    bad = F.exists(
        "chat",
        lambda m: F.coalesce(
            F.exists(m["tool_calls"], lambda c: c["name"].isNull() | c["arguments"].isNull()), F.lit(False)
        ),
    )
    return rows.withColumn("call_error", bad)
