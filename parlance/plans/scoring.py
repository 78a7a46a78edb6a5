"""Plan parsing against a tool contract, strict and compatible scores.

A contract is a small table (tool, kind, arguments_schema); it is folded into one map value, so parsing and
scoring are row-local: no shuffle, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.hashing import draw
from parlance.functions.text import let
from parlance.plans.openjson import leaf_udf, schema_udf
from parlance.plans.rules import DEFAULT_RULES, PlanRules

TASK = "struct<kind:string,instruction:string,name:string,arguments:string>"
TASKS = f"array<{TASK}>"
MAX_TOOLS = 10_000


def contract_map(contract: DataFrame) -> Column:
    """tool -> (kind, schema) as one value; a contract above ``MAX_TOOLS`` tools is refused."""
    entry = F.struct(F.col("tool"), F.struct(F.col("kind").alias("kind"), F.col("arguments_schema").alias("schema")))
    bounded = contract.limit(MAX_TOOLS + 1).agg(
        F.when(F.count(F.lit(1)) > MAX_TOOLS, F.raise_error(F.lit("contract too large")).cast("boolean")).alias("_b"),
        F.map_from_entries(F.collect_list(entry)).alias("m"),
    )
    return bounded.where(F.col("_b").isNull()).select("m").scalar()


def array_text(raw: Column) -> Column:
    """Text from the first "[" to the last "]"."""
    start = F.instr(raw, "[")
    back = F.instr(F.reverse(raw), "]")
    end = F.length(raw) - back + 1
    return F.when((start > 0) & (back > 0) & (end >= start), F.substr(raw, start, end - start + 1)).when(
        (start > 0) & (back == 0) & (F.trim(raw) == "["), F.lit("[")
    )


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _task_of(x: Column) -> Column:
    """Fields of one decoded item with its shape error (null when the shape is right)."""
    get = lambda name: F.try_variant_get(x, f"$.{name}", "variant")
    text = lambda name: F.when(_is(get(name), "STRING"), F.try_variant_get(x, f"$.{name}", "string"))
    keys = F.coalesce(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")), F.array().cast("array<string>"))
    kind = text("kind")

    def shape(names: Sequence[str]) -> Column:
        wanted = F.array(*[F.lit(n) for n in names])
        missing = F.array_sort(F.array_except(wanted, keys))
        extra = F.array_sort(F.array_except(keys, wanted))
        return F.when(F.size(missing) > 0, F.concat(F.lit("missing keys "), F.to_json(missing))).when(
            F.size(extra) > 0, F.concat(F.lit("unexpected keys "), F.to_json(extra))
        )

    empty = lambda name: F.when(F.coalesce(text(name), F.lit("")) == "", F.lit(f"{name} must be a non-empty string"))
    reply = F.coalesce(shape(("kind", "instruction")), empty("instruction"))
    call = F.coalesce(
        shape(("kind", "instruction", "name", "arguments")), empty("instruction"), empty("name"),
        F.when(~_is(get("arguments"), "OBJECT"), F.lit("arguments must be an object")),
    )
    error = (
        F.when(~_is(x, "OBJECT"), F.lit("must be an object"))
        .when(kind == "reply", reply)
        .when(kind.isin("query", "action"), call)
        .otherwise(F.lit("invalid kind"))
    )
    return F.struct(
        kind.alias("kind"), text("instruction").alias("instruction"),
        F.when(kind != "reply", text("name")).alias("name"),
        F.when(kind != "reply", F.to_json(get("arguments"))).alias("arguments"), error.alias("shape_error"),
    )


def parse_plans(df: DataFrame, contract: DataFrame, raw: str = "output", rules: PlanRules = DEFAULT_RULES) -> DataFrame:
    """Adds ``tasks``, ``valid_json``, ``contract_valid``, ``parse_error``, ``contract_error``.

    The first bad task decides: a shape error leaves no tasks, a contract error leaves the tasks before it.
    """
    text = array_text(F.col(raw))
    df = df.withColumn("_text", text).withColumn("_v", F.try_parse_json("_text"))
    items = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array().cast("array<variant>"))
    df = df.withColumn("_t", F.transform(items, _task_of)).withColumn("_c", contract_map(contract))
    tools = lambda field: F.transform("_t", lambda t: F.element_at("_c", F.coalesce(t["name"], F.lit("")))[field])
    df = df.withColumn("_kinds", tools("kind")).withColumn("_schemas", tools("schema"))
    checked = schema_udf(rules.selectors)(
        F.transform("_t", lambda t: t["name"]), F.transform("_t", lambda t: t["arguments"]), F.col("_schemas")
    )
    df = df.withColumn("_se", checked)

    def full(t: Column, i: Column) -> Column:
        kind, schema_error = F.get("_kinds", i), F.get("_se", i)
        broken = F.when(t["kind"] == "reply", F.lit(None).cast("string")).when(
            kind.isNull(), F.concat(F.lit("unknown tool "), t["name"])
        ).when(
            kind != t["kind"], F.concat(F.lit("kind "), t["kind"], F.lit(" does not match contract "), kind, F.lit(" for "), t["name"])
        ).when(schema_error.isNotNull(), F.concat(t["name"], F.lit(" arguments: "), schema_error))
        contract_error = F.when(t["shape_error"].isNull(), broken)
        return F.struct(
            i.alias("i"), t["shape_error"].alias("shape"), contract_error.alias("contract"),
        )

    df = df.withColumn("_errors", F.filter(
        F.transform("_t", full), lambda e: e["shape"].isNotNull() | e["contract"].isNotNull()
    )).withColumn("_first", F.get("_errors", F.lit(0)))
    plain = F.transform("_t", lambda t: F.struct(t["kind"], t["instruction"], t["name"], t["arguments"])).cast(TASKS)
    none = F.array().cast(TASKS)
    readable = F.col("_v").isNotNull()
    error = F.concat(
        F.lit("task["), F.col("_first.i"), F.lit("]: "), F.coalesce(F.col("_first.shape"), F.col("_first.contract"))
    )
    tasks = F.when(~readable, none).when(F.col("_first").isNull(), plain).when(
        F.col("_first.shape").isNotNull(), none
    ).otherwise(F.slice(plain, F.lit(1), F.coalesce(F.col("_first.i"), F.lit(0))))
    return (
        df.withColumn("tasks", tasks)
        .withColumn("valid_json", readable)
        .withColumn("contract_valid", readable & F.col("_first").isNull())
        .withColumn("contract_error", F.coalesce(readable & F.col("_first.contract").isNotNull(), F.lit(False)))
        .withColumn(
            "parse_error",
            F.when(F.col("_text").isNull(), F.lit("missing JSON array")).when(~readable, F.lit("JSON decode error")).otherwise(error),
        )
        .drop("_text", "_v", "_t", "_c", "_kinds", "_schemas", "_se", "_errors", "_first")
    )


# ---- argument comparison ----------------------------------------------------------------------------

def _renamed(leaves: Column, name: Column, rules: PlanRules) -> Column:
    """Leaves with the old selector of a tool renamed to the contract's, or dropped when both are there."""
    out = leaves
    for tool, (old, new) in rules.selectors.items():
        has_new = F.exists(leaves, lambda x: x["path"] == new)
        moved = F.filter(
            F.transform(leaves, lambda x: F.when((x["path"] == old) & ~has_new, x.withField("path", F.lit(new))).otherwise(x)),
            lambda x: x["path"] != old,
        )
        out = F.when(F.coalesce(name == tool, F.lit(False)), moved).otherwise(out)
    return out


def _range_ok(bounds: Column, value: Column) -> Column:
    tests = {
        "min": lambda b: value >= b, "gte": lambda b: value >= b, "gt": lambda b: value > b,
        "max": lambda b: value <= b, "lte": lambda b: value <= b, "lt": lambda b: value < b,
    }
    ok = value.isNotNull()
    for word, test in tests.items():
        bound = F.element_at(bounds, word)
        ok = ok & (bound.isNull() | test(bound))
    return F.coalesce(ok, F.lit(False))


def _leaf_errors(expected: Column, actual: Column, rules: PlanRules, directional: Column, strict_unit: bool,
                 default_repeat: bool) -> Column:
    """Paths of expected leaves the actual leaves do not meet."""

    def bad(e: Column) -> Column:
        def against(found: Column) -> Column:
            a = F.get(found, F.lit(0))
            directed = e["path"].isin(list(rules.direction_paths)) & (e["kind"] == "number") & directional
            sign = (a["kind"] == "number") & (F.signum(e["num"]) == F.signum(a["num"]))
            if strict_unit:
                sign = sign & a["num"].between(-1, 1)
            same = F.when(e["kind"] == "number", (a["kind"] == "number") & (e["num"] == a["num"])).otherwise(
                (a["kind"] == "value") & (e["text"] == a["text"])
            )
            met = (
                F.when(e["kind"] == "badrange", F.lit(False))
                .when(e["kind"] == "range", (a["kind"] == "number") & _range_ok(e["bounds"], a["num"]))
                .when(e["kind"] == "object", a["kind"] == "object")
                .when(directed, sign)
                .otherwise(same)
            )
            absent = F.lit(False)
            if default_repeat:
                absent = (e["path"].rlike("(^|\\.)repeat$")) & (e["kind"] == "number") & (e["num"] == 1)
            return F.when(F.size(found) == 0, ~absent).otherwise(~F.coalesce(met, F.lit(False)))

        return let(F.filter(actual, lambda x: x["path"] == e["path"]), against)

    return F.transform(F.filter(expected, bad), lambda e: e["path"])


def _leaf_columns(df: DataFrame, expected: str) -> DataFrame:
    texts = lambda c: F.transform(c, lambda t: t["arguments"])
    return df.withColumn("_el", leaf_udf(True)(texts(expected))).withColumn("_al", leaf_udf(False)(texts("tasks")))


def _checked(expected: Column, skipped: Sequence[str]) -> Column:
    """Whether a case has arguments the score compares."""
    return F.exists(
        expected,
        lambda t: ~F.coalesce(t["name"].isin(list(skipped)), F.lit(False)) & (t["kind"] != "reply")
        & ~F.coalesce(t["arguments"], F.lit("{}")).rlike(r"^\s*(\{\s*\})?\s*$"),
    )


def score_strict(df: DataFrame, contract: DataFrame, expected: str = "expected", raw: str = "output",
                 forbidden: str = "forbidden_functions", error: str | None = "error",
                 rules: PlanRules = DEFAULT_RULES) -> DataFrame:
    """Strict score: reason by precedence backend error, JSON, schema or contract, forbidden, count, kind, name, parameter.

    A frame that already went through ``parse_plans`` is scored as it is.
    """
    if "tasks" not in df.columns:
        df = parse_plans(df, contract, raw, rules)
    df = _leaf_columns(df, expected)
    want, got = F.col(expected), F.col("tasks")
    failed = F.col(error).isNotNull() if error and error in df.columns else F.lit(False)
    names = F.array_compact(F.transform(want, lambda t: t["name"]))
    calls = F.filter(
        F.array_compact(F.transform(got, lambda t: t["name"])),
        lambda n: F.array_contains(F.coalesce(F.col(forbidden), F.array().cast("array<string>")), n) & ~F.array_contains(names, n),
    )
    df = df.withColumn("_calls", calls)
    count_ok = F.size(want) == F.size(got)
    kinds = lambda c: F.transform(c, lambda t: F.coalesce(t["kind"], F.lit("")))
    called = lambda c: F.transform(c, lambda t: F.coalesce(t["name"], F.lit("")))
    df = df.withColumn("_count", count_ok).withColumn("_kind", count_ok & (kinds(want) == kinds(got))).withColumn(
        "_name", count_ok & (called(want) == called(got))
    )

    def compare(t: Column, i: Column) -> Column:
        skip = F.coalesce(t["name"].isin(list(rules.skipped_tools)), F.lit(False)) | (t["kind"] == "reply") | t["name"].isNull()
        e = _renamed(F.get("_el", i), t["name"], rules)
        a = _renamed(F.get("_al", i), t["name"], rules)
        errors = F.transform(
            _leaf_errors(e, a, rules, F.lit(True), False, True), lambda p: F.concat(F.lit("task["), i, F.lit("]."), p)
        )
        none = F.array().cast("array<string>")
        return F.struct(
            F.when(skip, F.lit(0)).otherwise(F.size(e)).alias("checked"), F.when(skip, none).otherwise(errors).alias("errors")
        )

    aligned = F.col("_count") & F.col("_kind") & F.col("_name")
    df = df.withColumn("_cmp", F.when(aligned & F.col("contract_valid"), F.transform(want, compare)))
    errors = F.coalesce(F.flatten(F.transform("_cmp", lambda c: c["errors"])), F.array().cast("array<string>"))
    checked = F.when(
        aligned, F.aggregate("_cmp", F.lit(0), lambda n, c: n + c["checked"])
    ).otherwise(_checked(want, rules.skipped_tools).cast("int"))
    has = _checked(want, rules.skipped_tools)
    df = df.withColumn("parameter_errors", errors)
    match = (
        F.when(failed | ~F.col("valid_json"), F.lit(None).cast("boolean"))
        .when(~F.col("contract_valid"), F.when(has, F.lit(False)))
        .when(checked > 0, aligned & (F.size("parameter_errors") == 0))
    )
    df = df.withColumn("parameter_match", match)
    fine = F.col("contract_valid") & ~failed
    reason = (
        F.when(failed, "backend_error")
        .when(~F.col("valid_json"), "invalid_json")
        .when(~F.col("contract_valid"), F.when(F.col("contract_error"), "contract_violation").otherwise("invalid_task_schema"))
        .when(F.size("_calls") > 0, "forbidden_tool")
        .when(~F.col("_count"), "task_count_mismatch")
        .when(~F.col("_kind"), "task_kind_mismatch")
        .when(~F.col("_name"), "task_name_mismatch")
        .when(F.col("parameter_match") == F.lit(False), "task_parameter_mismatch")
        .otherwise("passed")
    )
    steps = F.size(F.filter(
        F.zip_with(want, got, lambda e, a: (e["kind"] == a["kind"]) & e["name"].eqNullSafe(a["name"])), lambda ok: ok
    ))
    return (
        df.withColumn("reason", reason)
        .withColumn("strict_pass", F.col("reason") == "passed")
        .withColumn("valid_json", F.col("valid_json") & ~failed)
        .withColumn("contract_valid", fine)
        .withColumn("task_count_match", fine & F.col("_count"))
        .withColumn("ordered_kind_name_match", fine & F.col("_kind") & F.col("_name"))
        .withColumn("forbidden_tool_violation", fine & (F.size("_calls") > 0))
        .withColumn("expected_step_count", F.size(want))
        .withColumn("predicted_step_count", F.when(failed, 0).otherwise(F.size(got)))
        .withColumn("aligned_kind_name_matches", F.when(failed, 0).otherwise(F.coalesce(steps, F.lit(0))))
        .drop("_el", "_al", "_calls", "_count", "_kind", "_name", "_cmp")
    )


#: A partial alignment: argument matches, which slots hold a call, and which call. Compared in this order.
ALIGNMENT = "struct<score:int,used:array<int>,picks:array<int>>"


def align_slots(slots: Column, calls: Column, matches: Column, blocked: Column) -> Column:
    """Per expected slot the index of its call, -1 for none; null when no alignment exists.

    All calls are taken in order, one a slot. A tool slot takes a call of its name; a reply slot (empty name) stays empty, or takes a
    call that is not blocked when there is a block list. Most argument matches win, then the earliest slots used.

    A fold over the slots holds, for each number of calls taken so far, the best alignment that took them. What
    comes later is open to all of these alike, so a worse one can be dropped.
    """
    count = F.size(calls)
    none = F.lit(None).cast(ALIGNMENT)
    empty = F.array().cast("array<int>")

    def longer(before: Column, points: Column, pick: Column) -> Column:
        return F.struct(
            (before["score"] + points).alias("score"), F.array_append(before["used"], (pick >= 0).cast("int")).alias("used"),
            F.array_append(before["picks"], pick).alias("picks"),
        ).cast(ALIGNMENT)

    def step(best: Column, slot: Column) -> Column:
        reply = slot["name"] == ""

        def after(taken: Column) -> Column:
            call, stays, comes = F.get(calls, taken - 1), F.get(best, taken), F.get(best, taken - 1)
            fits = F.when(reply, (F.size(blocked) > 0) & ~F.array_contains(blocked, call)).otherwise(slot["name"] == call)
            points = F.when(~reply & F.coalesce(F.get(slot["match"], taken - 1), F.lit(False)), 1).otherwise(0)
            return F.greatest(
                F.when(reply & stays.isNotNull(), longer(stays, F.lit(0), F.lit(-1))).otherwise(none),
                F.when(comes.isNotNull() & fits, longer(comes, points, taken - 1)).otherwise(none),
            )

        return F.transform(F.sequence(F.lit(0), count), after)

    start = F.struct(F.lit(0).alias("score"), empty.alias("used"), empty.alias("picks")).cast(ALIGNMENT)
    zipped = F.zip_with(slots, matches, lambda name, match: F.struct(name.alias("name"), match.alias("match")))
    return F.aggregate(
        zipped, F.concat(F.array(start), F.array_repeat(none, count)), step, lambda best: F.get(best, count)["picks"]
    )


def _plain(name: Column) -> Column:
    return F.regexp_replace(F.btrim(F.lower(F.coalesce(name, F.lit("")))), r"\s+", "_")


def score_compatible(df: DataFrame, contract: DataFrame, expected: str = "expected", raw: str = "output",
                     forbidden: str = "forbidden_functions", error: str | None = "error",
                     rules: PlanRules = DEFAULT_RULES) -> DataFrame:
    """Compatible score: tool calls aligned to expected slots, exempt fields ignored, forbidden calls budgeted."""
    parsed = df if "tasks" in df.columns else parse_plans(df, contract, raw, rules)
    parsed = _leaf_columns(parsed, expected)
    want = F.col(expected)
    calls = F.filter(F.arrays_zip(F.col("tasks").alias("t"), F.col("_al").alias("l")), lambda z: z["t"]["kind"] != "reply")
    parsed = parsed.withColumn("_tools", calls).withColumn(
        "_slots", F.transform(want, lambda t: F.when(t["name"].isNotNull(), _plain(t["name"])).otherwise(F.lit("")))
    ).withColumn("_got", F.transform("_tools", lambda z: _plain(z["t"]["name"])))
    blocked = F.transform(F.coalesce(F.col(forbidden), F.array().cast("array<string>")), _plain)
    acts = F.array(*[_plain(F.lit(t)) for t in rules.action_tools])
    parsed = parsed.withColumn("_raw_block", blocked).withColumn("_scope", F.arrays_overlap("_raw_block", acts))
    parsed = parsed.withColumn(
        "_block", F.when(F.col("_scope"), F.array_union("_raw_block", acts)).otherwise(F.array_distinct("_raw_block"))
    ).withColumn("_want_names", F.filter("_slots", lambda s: s != ""))
    parsed = parsed.withColumn(
        "_effective", F.when(F.col("_scope"), F.array_except("_block", "_want_names")).otherwise(F.col("_block"))
    )

    def errors_of(i: Column, z: Column, t: Column) -> Column:
        e = _renamed(F.get("_el", i), t["name"], rules)
        for tool, paths in rules.exempt.items():
            kept = F.filter(e, lambda x: ~x["path"].isin(list(paths)) | (x["kind"] == "range"))
            # an object left without members is no longer expected
            full = F.filter(kept, lambda x: (x["kind"] != "object") | F.exists(
                kept, lambda y: y["path"].startswith(F.concat(x["path"], F.lit(".")))
            ))
            e = F.when(F.coalesce(t["name"] == tool, F.lit(False)), full).otherwise(e)
        a = _renamed(z["l"], z["t"]["name"], rules)
        tool, action = rules.directional
        walks = F.exists(F.get("_el", i), lambda x: (x["path"] == "action") & (x["text"] == f'"{action}"'))
        directed = F.coalesce((t["name"] == tool) & walks, F.lit(False))
        skip = t["name"].isNull() | t["name"].isin(list(rules.skipped_tools))
        return F.when(skip, F.array().cast("array<string>")).otherwise(
            _leaf_errors(e, a, rules, directed, True, False)
        )

    matrix = F.transform(want, lambda t, i: F.transform("_tools", lambda z: F.size(errors_of(i, z, t)) == 0))
    parsed = parsed.withColumn("_match", matrix).withColumn(
        "_align", align_slots(F.col("_slots"), F.col("_got"), F.col("_match"), F.col("_block"))
    )
    # calls beyond the expected ones of their name are violations when forbidden, or when nothing is allowed extra
    surplus = F.filter(
        F.transform("_got", lambda g, i: F.struct(
            g.alias("g"), (F.size(F.filter(F.slice("_got", F.lit(1), i + 1), lambda x: x == g))
                           > F.size(F.filter("_want_names", lambda x: x == g))).alias("over"),
        )),
        lambda x: x["over"],
    )
    parsed = parsed.withColumn("_forbidden", F.exists(
        surplus, lambda x: (F.size("_raw_block") == 0) | F.array_contains("_effective", x["g"])
    ))
    failed = F.col(error).isNotNull() if error and error in df.columns else F.lit(False)
    valid = F.col("contract_valid") & ~failed
    used = F.transform("_slots", lambda s, i: (s != "") & (F.get("_align", i) >= 0))
    bad = F.exists(
        F.transform("_slots", lambda s, i: F.get(used, i) & ~F.get(F.get("_match", i), F.get("_align", i))), lambda x: x
    )
    compared = F.exists(F.transform(want, lambda t, i: F.get(used, i) & ~t["name"].isin(list(rules.skipped_tools))), lambda x: x)
    parsed = parsed.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn("_cmp", F.coalesce(compared, F.lit(False)))
    reason = (
        F.when(failed, "backend_error")
        .when(~F.col("contract_valid"), "parser_rejected")
        .when(F.col("_forbidden"), "forbidden_tool")
        .when(F.col("_align").isNull(), "tool_sequence_mismatch")
        .when(F.col("_bad"), "parameter_mismatch")
        .otherwise("passed")
    )
    slots = F.size(F.filter(want, lambda t: t["kind"] == "reply"))
    return (
        parsed.withColumn("compatible_reason", reason)
        .withColumn("compatible_pass", F.col("compatible_reason") == "passed")
        .withColumn("parser_valid", valid)
        .withColumn("tool_sequence_match", valid & F.col("_align").isNotNull() & ~F.col("_forbidden"))
        .withColumn("compatible_parameter_match", F.when(valid & F.col("_cmp"), ~F.col("_bad")))
        .withColumn("compatible_forbidden", valid & F.col("_forbidden"))
        .withColumn("reply_slots", slots)
        .withColumn("expected_tool_count", F.size(want) - slots)
        .withColumn("predicted_tool_count", F.when(failed, 0).otherwise(F.size("_got")))
        .drop("_el", "_al", "_tools", "_slots", "_got", "_raw_block", "_scope", "_block", "_want_names", "_effective",
              "_match", "_align", "_forbidden", "_bad", "_cmp")
    )


def strict_extra(df: DataFrame, expected: str = "expected", out: str = "extra_errors") -> DataFrame:
    """Exact checks beyond the score: step, degree, city containment, query type, on calls paired by position."""
    calls = lambda c: F.filter(c, lambda t: t["kind"] != "reply")
    value = lambda t, path: F.get_json_object(t["arguments"], path)
    city = lambda c: F.trim(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("市"), F.lit("")))

    def check(e: Column, a: Column) -> Column:
        parts = []
        for name in ("step", "degree"):
            want, got = value(e, f"$.parameters.{name}"), value(a, f"$.parameters.{name}")
            parts.append(F.when((e["name"] == "HumanAction") & want.isNotNull() & ~want.eqNullSafe(got), F.lit(name)))
        want, got = city(value(e, "$.city")), city(value(a, "$.city"))
        off = (want != "") & ((got == "") | ~(got.contains(want) | want.contains(got)))
        parts.append(F.when((e["name"] == "get_weather") & off, F.lit("city")))
        kind, got_kind = value(e, "$.query_type"), value(a, "$.query_type")
        parts.append(F.when((e["name"] == "get_weather") & kind.isNotNull() & ~kind.eqNullSafe(got_kind), F.lit("query_type")))
        return F.array_compact(F.array(*parts))

    paired = F.filter(
        F.zip_with(calls(expected), calls("tasks"), lambda e, a: F.when(e.isNotNull() & a.isNotNull(), check(e, a))),
        lambda x: x.isNotNull(),
    )
    return df.withColumn(out, F.flatten(paired))


def adjust_plan(df: DataFrame, tasks: str = "tasks", repeated: Sequence[str] = ("RobotGesture", "RobotDance")) -> DataFrame:
    """Coordinates dropped; a call repeated n times becomes n calls with repeat 1."""
    fields = "map<string,variant>"

    def grow(t: Column) -> Column:
        given = F.try_variant_get(F.try_parse_json(t["arguments"]), "$", fields)
        kept = F.map_filter(given, lambda k, v: ~k.isin("latitude", "longitude"))
        n = F.try_variant_get(F.try_parse_json(t["arguments"]), "$.repeat", "int")
        many = F.coalesce(t["name"].isin(list(repeated)) & (n > 1), F.lit(False))
        once = F.map_concat(
            F.map_filter(kept, lambda k, v: k != "repeat"), F.create_map(F.lit("repeat"), F.parse_json(F.lit("1")))
        )
        arguments = F.when(t["arguments"].isNull(), t["arguments"]).when(many, F.to_json(once)).otherwise(F.to_json(kept))
        return F.array_repeat(t.withField("arguments", arguments), F.when(many, n).otherwise(F.lit(1)))

    return df.withColumn(tasks, F.flatten(F.transform(tasks, grow)))


def merged_replies(tasks: Column, is_reply) -> Column:
    """Neighbouring reply items collapsed to the first of them."""
    return F.filter(
        F.transform(tasks, lambda t, i: F.when(
            (i > 0) & is_reply(t) & F.coalesce(is_reply(F.get(tasks, i - 1)), F.lit(False)), F.lit(None)
        ).otherwise(t)),
        lambda t: t.isNotNull(),
    )


def plan_signature(df: DataFrame, tasks: str = "tasks", out: str = "signature") -> DataFrame:
    """Plan shape: tool with its selector, movement by sign, adjacent replies merged."""
    value = lambda t, path: F.coalesce(F.get_json_object(t["arguments"], path), F.lit(""))

    def part(t: Column) -> Column:
        signs = F.concat_ws(",", *[
            F.when(
                F.get_json_object(t["arguments"], f"$.parameters.{k}").isNotNull(),
                F.concat(F.lit(f"{k}="), F.signum(F.get_json_object(t["arguments"], f"$.parameters.{k}").cast("double")).cast("int")),
            ) for k in ("x", "y", "yaw")
        ])
        chosen = F.coalesce(F.get_json_object(t["arguments"], "$.gesture"), F.get_json_object(t["arguments"], "$.dance"), F.lit(""))
        return (
            F.when(t["kind"] == "reply", F.lit("reply"))
            .when(t["name"] == "HumanAction", F.concat_ws("|", t["name"], value(t, "$.action"), signs))
            .when(t["name"].isin("RobotGesture", "RobotDance"), F.concat_ws("|", t["name"], chosen))
            .when(t["name"] == "robot_status", F.concat_ws("|", t["name"], value(t, "$.query")))
            .when(t["name"] == "get_weather", F.concat_ws("|", t["name"], value(t, "$.query_type")))
            .otherwise(t["name"])
        )

    df = df.withColumn("_p", F.transform(tasks, part))
    merged = F.filter(
        F.transform("_p", lambda p, i: F.when((i > 0) & (p == "reply") & (F.get("_p", i - 1) == "reply"), F.lit(None)).otherwise(p)),
        lambda p: p.isNotNull(),
    )
    return df.withColumn(out, F.array_join(merged, ";")).drop("_p")


def signature_seen(df: DataFrame, train: DataFrame, column: str = "signature", out: str = "signature_seen") -> DataFrame:
    counts = train.groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, column, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def project_cases(df: DataFrame, rules: PlanRules = DEFAULT_RULES) -> DataFrame:
    """Source cases with nested intents to expected tasks, polarity, forbidden set and atom ids.

    ``intents``: array of struct(tool, action, params JSON, source_atom_id, source_atom_ids, negative).
    """
    reply_text = F.when(F.coalesce("source_query_zh", F.lit("")) != "", F.col("source_query_zh")).otherwise(F.col("query")) \
        if "source_query_zh" in df.columns else F.col("query")

    def task(t: Column) -> Column:
        kind = F.when(t["tool"].isin(list(rules.action_tools)), "action").when(
            t["tool"].isin(list(rules.query_tools)), "query"
        ).otherwise("reply")
        params = F.coalesce(F.try_variant_get(F.try_parse_json(t["params"]), "$", "map<string,variant>"),
                            F.create_map().cast("map<string,variant>"))
        named = lambda k: F.create_map(F.lit(k), F.parse_json(F.to_json(t["action"].cast("variant"))))
        inner = F.map_filter(params, lambda k, v: k != "action")
        moved = F.when(F.size(inner) > 0, F.map_concat(
            named("action"), F.create_map(F.lit("parameters"), F.parse_json(F.to_json(inner)))
        )).otherwise(named("action"))
        arguments = F.when(t["tool"] == "HumanAction", F.to_json(moved))
        for tool, (_, new) in rules.selectors.items():
            swapped = F.map_concat(F.map_filter(params, lambda k, v: k != new), named(new))
            arguments = arguments.when((t["tool"] == tool) & t["action"].isNotNull(), F.to_json(swapped))
        arguments = arguments.otherwise(F.to_json(params))
        return F.struct(
            kind.alias("kind"), F.when(kind == "reply", reply_text).otherwise(F.col("query")).alias("instruction"),
            F.when(kind != "reply", t["tool"]).alias("name"), F.when(kind != "reply", arguments).alias("arguments"),
        )

    strings = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    inner = F.flatten(F.transform("intents", lambda t: F.concat(strings(t["source_atom_ids"]), strings(F.array(t["source_atom_id"])))))
    negative = F.coalesce(F.col("negative"), F.lit(False)) | F.exists("intents", lambda t: F.coalesce(t["negative"], F.lit(False)))
    return (
        df.withColumn("expected", F.transform("intents", task))
        .withColumn("polarity", F.when(negative, "negative").otherwise("positive"))
        .withColumn("forbidden_functions", F.array_distinct(strings(F.col("forbidden_functions"))))
        .withColumn("source_atom_ids", F.array_sort(F.array_distinct(F.concat(strings(F.col("source_atom_ids")), inner))))
        .withColumn("difficulty", F.coalesce("difficulty", F.lit("unknown")))
    )


SCORE_COLUMNS = ("reason", "strict_pass", "valid_json", "contract_valid", "task_count_match", "ordered_kind_name_match",
                 "parameter_match", "forbidden_tool_violation", "expected_step_count", "predicted_step_count",
                 "aligned_kind_name_matches")


def rescore(results: DataFrame, cases: DataFrame, contract: DataFrame, rules: PlanRules = DEFAULT_RULES) -> DataFrame:
    """Stored outputs scored with the current rules; all other stored fields are kept."""
    stored = results.drop(*SCORE_COLUMNS, "compatible_reason", "compatible_pass")
    joined = stored.join(cases.select("case_id", "expected", "forbidden_functions"), "case_id")
    return score_compatible(score_strict(joined, contract, rules=rules), contract, rules=rules)


# ---- generation --------------------------------------------------------------------------------------

MAX_RUNS = 10_000


def pending(cases: DataFrame, contracts: Sequence[str], variants: Sequence[str], done: DataFrame | None = None,
            seed: int = 0) -> DataFrame:
    """The schedule contract x variant x case without completed records.

    Contracts and variants are short driver lists (checked), fanned out per case; no table is crossed with another.
    """
    if len(set(contracts)) != len(contracts) or len(set(variants)) != len(variants):
        raise ValueError("duplicate contract or variant")
    if len(contracts) * len(variants) > MAX_RUNS:
        raise ValueError("too many contract and variant pairs for one schedule")
    pairs = F.array(*[
        F.struct(F.lit(c).alias("contract"), F.lit(v).alias("variant")) for c in contracts for v in variants
    ])
    rows = cases.select("*", F.explode(pairs).alias("_r")).select(*cases.columns, "_r.*")
    rows = rows.withColumn("record_id", draw(seed, F.col("contract"), F.col("variant"), F.col("case_id")))
    return rows if done is None else rows.join(done.select("record_id").distinct(), "record_id", "left_anti")


def generate(df: DataFrame, backend, prompt: str = "query") -> DataFrame:
    """Outputs of a pluggable backend: an object with ``generate(list of prompts) -> list of texts``, one call per batch."""

    @F.pandas_udf("struct<output:string,error:string>")
    def run(prompts: pd.Series) -> pd.DataFrame:
        try:
            texts, error = list(backend.generate(prompts.tolist())), None
        except Exception:  # noqa: BLE001 - a failed request is a result row
            texts, error = [None] * len(prompts), "backend: request failed"
        return pd.DataFrame({"output": texts, "error": [error] * len(prompts)})

    return df.withColumn("_g", run(prompt)).select("*", "_g.*").drop("_g")
