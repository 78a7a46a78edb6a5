"""Training rows from atoms: sampling of cases and pairs, plan compilation, rendering, augmentation, slot variants."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parlance.functions.hashing import draw, draw_int, draw_uniform, smallest_md5
from parlance.functions.ranks import join_null_safe
from parlance.functions.ranks import rank_by_int
from parlance.functions.text import json_string, norm_text
from parlance.operators.sampling import shuffled
from parlance.plans.openjson import mask_tools, rename_arguments
from parlance.plans.scoring import TASKS, contract_map
from parlance.session import ensure_checkpoint_dir

# Replies for a tool that is not on offer.
UNAVAILABLE = {"zh": "说明当前无法处理：{}", "en": "Explain that this can't be handled right now: {}"}
VARIANTS = ("masked", "drop_used", "drop_unused")


# ---- cases from a pool -----------------------------------------------------------------------------

@dataclass(frozen=True)
class CasePool:
    """Atoms ranked once by part and cell, with the cells of each part; draws look up a few places in it."""

    atoms: DataFrame  # (id, part, cell, topic, flip, place)
    cells: DataFrame  # (part, cell, cell_no, size, cells)


def case_pool(atoms: DataFrame, seed=0) -> CasePool:
    """``atoms``: (id, part, cell, topic, flip) with part positive, negative or relation."""
    ensure_checkpoint_dir(atoms.sparkSession)
    pool = shuffled(atoms.select("id", "part", "cell", "topic", "flip"), "id", seed, ["part", "cell"], out="place").checkpoint()
    sizes = pool.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("size"))
    cells = shuffled(sizes.withColumn("_k", F.concat_ws("|", "part", "cell")), "_k", seed, ["part"], out="cell_no")
    counts = sizes.groupBy("part").agg(F.count(F.lit(1)).alias("cells"))
    return CasePool(pool, cells.join(counts, "part").select("part", "cell", "cell_no", "size", "cells").checkpoint())


#: Picks of each slot that are drawn for every try; the others are drawn for the tries these leave unfilled.
FEW_PICKS = 3


def _filled(pool: CasePool, tries: DataFrame, level: int, seed, neg_rate: float, rel_rate: float, picks: int, few: int) -> DataFrame:
    """(case_no, _s) of the tries filled by the first ``few`` picks of each slot: later picks of a filled slot change nothing."""
    drawn_picks = F.array(*[F.lit(slot * picks + k) for slot in range(level) for k in range(few)])
    grid = tries.select("case_no", F.explode(drawn_picks).alias("pick"))
    u = draw_uniform(f"{seed}:part", F.col("case_no"), F.col("pick"))
    part = F.when(u < rel_rate, "relation").when(u < rel_rate + neg_rate, "negative").otherwise("positive")
    grid = grid.withColumn("part", part).join(pool.cells.groupBy("part").agg(F.max("cells").alias("cells")), "part")
    grid = grid.withColumn("cell_no", F.pmod(draw_int(f"{seed}:cell", F.col("case_no"), F.col("pick")), "cells"))
    grid = grid.join(pool.cells.select("part", "cell", "cell_no", "size"), ["part", "cell_no"])
    grid = grid.withColumn("place", F.pmod(draw_int(f"{seed}:row", F.col("case_no"), F.col("pick")), "size"))
    drawn = grid.select("case_no", "pick", "part", "cell", "place").join(pool.atoms, ["part", "cell", "place"])
    lists = drawn.groupBy("case_no").agg(F.array_sort(F.collect_list(F.struct("pick", "id", "topic", "flip", "part"))).alias("_p"))

    start = F.struct(
        F.array().cast("array<string>").alias("ids"), F.array().cast("array<string>").alias("topics"),
        F.array().cast("array<string>").alias("flips"), F.array().cast("array<int>").alias("slots"),
    )

    def step(s: Column, p: Column) -> Column:
        slot = F.floor(p["pick"] / picks).cast("int")
        free = ~F.array_contains(s["slots"], slot) & ~F.array_contains(s["topics"], p["topic"])
        free = free & ((p["part"] != "negative") | ~F.array_contains(s["flips"], F.coalesce(p["flip"], F.lit(""))))
        flips = F.when(p["part"] == "negative", F.array_append(s["flips"], F.coalesce(p["flip"], F.lit("")))).otherwise(s["flips"])
        return F.when(free, F.struct(
            F.array_append(s["ids"], p["id"].cast("string")).alias("ids"), F.array_append(s["topics"], p["topic"]).alias("topics"),
            flips.alias("flips"), F.array_append(s["slots"], slot).alias("slots"),
        )).otherwise(s)

    return lists.select("case_no", F.aggregate("_p", start, step).alias("_s")).where(F.size("_s.ids") == level)


def _candidates(pool: CasePool, level: int, first: int, last: int, seed, neg_rate: float, rel_rate: float, picks: int) -> DataFrame:
    """(case_no, ids, topics, flips) of the tries from ``first`` to ``last`` that can be filled, one for each combination."""
    tries = pool.atoms.sparkSession.range(first, last).select(F.col("id").alias("case_no"))
    rule = (level, seed, neg_rate, rel_rate, picks)
    cases = _filled(pool, tries, *rule, min(FEW_PICKS, picks))
    if picks > FEW_PICKS:
        cases = cases.checkpoint()
        cases = cases.unionByName(_filled(pool, tries.join(cases.select("case_no"), "case_no", "left_anti"), *rule, picks))
    best = cases.groupBy(F.col("_s.ids").alias("ids")).agg(
        F.min(F.struct("case_no", F.col("_s.topics").alias("topics"), F.col("_s.flips").alias("flips"))).alias("_f")
    )
    return best.select(F.col("_f.case_no").alias("case_no"), "ids", F.col("_f.topics").alias("topics"), F.col("_f.flips").alias("flips"))


def compose_cases(atoms: DataFrame | CasePool, level: int, n: int, seed=0, neg_rate: float = 0.3, rel_rate: float = 0.0,
                  picks: int = 20, tries: int = 20) -> DataFrame:
    """n distinct cases of ``level`` slots: no topic and no flip twice, no repeated combination; and ``missing``.

    A try draws ``picks`` hashed picks for each slot (part by rate, cell evenly, then a row of the cell); an ordered fold keeps
    the first pick that fits. Tries that cannot be filled or repeat a combination are made up for by further ones, drawn for as
    long as cases are missing and at most ``tries`` * n in all; the earliest tries stay. ``missing`` is by how much the
    result then falls short of n, the same in every row. Cases may be empty of rows only if no try fits at all.
    """
    pool = atoms if isinstance(atoms, CasePool) else case_pool(atoms, seed)
    ensure_checkpoint_dir(pool.atoms.sparkSession)
    made = min(2 * n, tries * n)
    kept = _candidates(pool, level, 0, made, seed, neg_rate, rel_rate, picks).checkpoint()
    found = kept.count()
    while found < n and made < tries * n:
        more = min(2 * made, tries * n)  # as many again, so the rounds are few
        new = _candidates(pool, level, made, more, seed, neg_rate, rel_rate, picks).join(kept.select("ids"), "ids", "left_anti")
        kept, made = kept.unionByName(new).checkpoint(), more
        found = kept.count()
    numbered = rank_by_int(kept, "case_no", out="_o").where(F.col("_o") < n)
    return numbered.select(
        "case_no", F.lit(level).alias("level"), "ids", "topics", "flips", F.lit(max(n - found, 0)).cast("long").alias("missing")
    )


def level_count(level_one: int, share: float, other_levels: int) -> int:
    """Rows per further level, when level one holds ``share`` of all rows."""
    return round(level_one * (1 - share) / share / other_levels)


def sample_pairs(atoms: DataFrame, n: int, seed=0, tries: int = 20, op: str = "pair") -> DataFrame:
    """n pairs (a, b): a drawn from the pool, b half of the time of a's tool, never of its topic or value.

    ``atoms``: (id, tool, topic, value). b is the first of ``tries`` hashed picks that fits.
    """
    everyone = shuffled(atoms, "id", f"{seed}:all", out="place")
    same = shuffled(atoms, "id", f"{seed}:tool", ["tool"], out="place")
    total = atoms.agg(F.count(F.lit(1))).scalar()
    per_tool = atoms.groupBy("tool").agg(F.count(F.lit(1)).alias("size"))
    units = atoms.sparkSession.range(n).select(F.col("id").alias("unit"))
    units = units.withColumn("place", F.pmod(draw_int(f"{seed}:a", F.col("unit")), F.greatest(total, F.lit(1))))
    a = units.join(everyone.select("place", F.col("id").alias("a"), F.col("tool"), F.col("topic").alias("a_topic"), F.col("value").alias("a_value")), "place").drop("place")
    a = a.join(per_tool, "tool").withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    own = draw_uniform(f"{seed}:half", F.col("unit"), F.col("pick")) < 0.5
    roll = draw_int(f"{seed}:b", F.col("unit"), F.col("pick"))
    a = a.withColumn("_own", own).withColumn(
        "place", F.pmod(roll, F.when(F.col("_own"), F.col("size")).otherwise(F.greatest(total, F.lit(1))))
    )
    fields = [F.col("id").alias("b"), F.col("topic").alias("b_topic"), F.col("value").alias("b_value"), "place"]
    mine = a.where("_own").join(same.select("tool", *fields), ["tool", "place"])
    other = a.where(~F.col("_own")).join(everyone.select(*fields), "place")
    both = mine.unionByName(other).where((F.col("a_topic") != F.col("b_topic")) & (F.col("a_value") != F.col("b_value")))
    best = both.groupBy("unit").agg(F.min(F.struct("pick", "a", "b")).alias("_f"))
    return best.select("unit", F.lit(op).alias("op"), F.col("_f.a").alias("a"), F.col("_f.b").alias("b"))


def challenge_grid(atoms: DataFrame, plan: dict, seed=0, ops: Sequence[str] = ("only", "correct", "before")) -> DataFrame:
    """Specs by category and language: singles dealt over tools or flips, multi-intent cases by level, relation pairs.

    ``plan``: e.g. {"zh": {"pos": 60, "neg": 42, "multi": 80, "max_level": 5, "rel": 40}}.
    ``atoms``: (id, part, cell, topic, flip, tool, value). ``missing``: by how many cases a level falls short of its plan. The pool is
    ranked for the cases once. A relation unit without a fitting partner drops out.
    """
    out, pool = None, None

    def add(rows: DataFrame) -> None:
        nonlocal out
        rows = rows if "missing" in rows.columns else rows.withColumn("missing", F.lit(0).cast("long"))
        out = rows if out is None else out.unionByName(rows)

    for language, want in plan.items():
        for part, by, category in (("positive", "tool", "single_positive"), ("negative", "flip", "single_negative")):
            count = want.get("pos" if part == "positive" else "neg", 0)
            rows = atoms.where(F.col("part") == part)
            if not count:
                continue
            groups = rows.select(by).distinct()
            groups = shuffled(groups.withColumn("_k", F.col(by)), "_k", f"{seed}:{language}", out="group_no")
            n_groups = groups.agg(F.count(F.lit(1))).scalar()
            ranked = shuffled(rows, "id", f"{seed}:{language}:{part}", [by], out="place")
            sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("size"))
            specs = atoms.sparkSession.range(count).select(F.col("id").alias("k"))
            specs = specs.withColumn("group_no", F.pmod("k", F.greatest(n_groups, F.lit(1))))
            specs = specs.join(groups.select(by, "group_no"), "group_no").join(sizes, by)
            specs = specs.withColumn("place", F.pmod(draw_int(f"{seed}:{language}:{category}", F.col("k")), "size"))
            got = specs.join(ranked.select(by, "place", "id"), [by, "place"])
            add(got.select(
                F.lit(category).alias("category"), F.lit(language).alias("language"), "k",
                F.array(F.col("id").cast("string")).alias("ids"), F.array(F.col(by)).alias("tags"),
            ))
        levels = want.get("max_level", 0)
        for level in range(2, levels + 2) if want.get("multi") else ():
            share = want["multi"] // levels + (1 if level - 2 < want["multi"] % levels else 0)
            if share:
                pool = pool or case_pool(atoms, seed)
                cases = compose_cases(pool, level, share, f"{seed}:{language}")
                add(cases.select(
                    F.lit("multi_intent").alias("category"), F.lit(language).alias("language"),
                    F.col("case_no").alias("k"), "ids", F.array(F.lit(f"L{level}")).alias("tags"), "missing",
                ))
        if want.get("rel"):
            pairs = sample_pairs(atoms.where(F.col("part") == "positive"), want["rel"], f"{seed}:{language}:rel")
            op = F.get(F.array(*[F.lit(o) for o in sorted(ops)]), F.pmod("unit", F.lit(len(ops))).cast("int"))
            add(pairs.select(
                F.lit("relation").alias("category"), F.lit(language).alias("language"), F.col("unit").alias("k"),
                F.array(F.col("a").cast("string"), F.col("b").cast("string")).alias("ids"), F.array(op).alias("tags"),
            ))
    return out


def relation_labels(units: DataFrame, ops: DataFrame, verdict: str | None = None, text: str = "query") -> DataFrame:
    """Expected letters of a relation unit, their labels, and the verdict's reason.

    ``ops``: (op, letters) with "A*" for A repeated n times. ``units``: (op, a, b, n, order_no, query). First unit per normalised text.
    """
    first = units.groupBy(F.sha2(norm_text(F.col(text)), 256).alias("_k")).agg(
        F.min(F.struct("order_no", *[F.col(c) for c in units.columns if c != "order_no"])).alias("_u")
    ).select("_u.*")
    joined = first.join(ops.select("op", "letters"), "op")
    letters = F.flatten(F.transform(
        "letters", lambda x: F.when(x == "A*", F.array_repeat(F.lit("A"), F.col("n").cast("int"))).otherwise(F.array(x))
    ))
    out = joined.withColumn("expect", letters).withColumn(
        "labels", F.transform("expect", lambda x: F.when(x == "A", F.col("a")).otherwise(F.col("b")))
    ).drop("letters")
    if verdict:
        got = F.transform(F.col(verdict), lambda x: F.upper(F.trim(x)))
        text_of = F.array_join(got, "")
        out = out.withColumn("reason", F.when(F.col(verdict).isNull(), F.lit("judge missing")).when(
            got != F.col("expect"), F.concat(F.lit("judge "), F.when(text_of == "", F.lit("-")).otherwise(text_of))
        ))
    return out


# ---- plans and rows ----------------------------------------------------------------------------------

def compile_plans(cases: DataFrame, atoms: DataFrame, contract: DataFrame, case: str = "case_no", ids: str = "ids",
                  language: str = "en") -> DataFrame:
    """One task per atom in order, with lineage, semantic id and ``compile_error``.

    ``atoms``: (id, kind, instruction, expected_function, expected_params, query, flip, negative_sample).
    """
    picked = cases.select(case, F.posexplode(ids).alias("i", "_id"))
    rows = picked.join(atoms.withColumn("_aid", F.col("id").cast("string")), F.col("_id") == F.col("_aid"), "left")
    rows = rows.withColumn("_c", contract_map(contract))
    entry = F.element_at("_c", F.coalesce("expected_function", F.lit("")))
    reply = F.col("kind") == "reply"
    error = F.when(F.col("kind").isNull(), "missing planner_target").when(
        reply & F.col("expected_function").isNotNull(), "reply_has_executable_step"
    ).when(~reply & F.col("expected_function").isNull(), "call_missing_executable_step").when(
        ~reply & entry.isNull(), "unknown_tool"
    ).when(~reply & (entry["kind"] != F.col("kind")), "planner_target_kind_mismatch")
    instruction = F.rtrim(F.trim("instruction"), F.lit("。.！!"))
    task = F.struct(
        F.col("kind").alias("kind"), instruction.alias("instruction"),
        F.when(~reply, F.col("expected_function")).alias("name"), F.when(~reply, F.coalesce("expected_params", F.lit("{}"))).alias("arguments"),
    )
    part = F.struct(
        "i", task.alias("task"), F.col("_id").alias("source_atom_id"), error.alias("error"), F.col("query").alias("query"),
        F.col("flip").alias("flip"), F.coalesce("negative_sample", F.lit(False)).alias("negative"),
    )
    plans = rows.groupBy(case).agg(F.array_sort(F.collect_list(part)).alias("_p"))
    slots = F.transform("_p", lambda p: F.concat_ws(
        ",", F.when(p["task"]["name"].isNotNull(), F.concat(F.lit('"arguments":'), p["task"]["arguments"])),
        F.concat(F.lit('"kind":'), json_string(p["task"]["kind"])),
        F.when(p["task"]["name"].isNotNull(), F.concat(F.lit('"name":'), json_string(p["task"]["name"]))),
    ))
    payload = F.concat(
        F.lit('{"atom_ids":'), F.to_json(F.transform("_p", lambda p: p["source_atom_id"])),
        F.lit(',"schema":"semantic-program/v1","slots":['),
        F.array_join(F.transform(slots, lambda s: F.concat(F.lit("{"), s, F.lit("}"))), ","), F.lit("]}"),
    )
    return plans.select(
        case, F.transform("_p", lambda p: p["task"]).cast(TASKS).alias("tasks"),
        F.transform("_p", lambda p: F.struct(p["source_atom_id"].alias("source_atom_id"), p["i"].alias("task_index"))).alias("lineage"),
        F.transform("_p", lambda p: p["query"]).alias("source_queries"),
        F.array_compact(F.transform("_p", lambda p: F.when(p["negative"], p["flip"]))).alias("flips"),
        F.exists("_p", lambda p: p["negative"]).alias("negative"),
        F.concat(F.lit("sha256:"), F.sha2(payload, 256)).alias("semantic_id"),
        F.get(F.filter(F.transform("_p", lambda p: p["error"]), lambda e: e.isNotNull()), F.lit(0)).alias("compile_error"),
        F.lit(language).alias("language"),
    )


def facets(tasks: Column) -> tuple[Column, Column]:
    kinds = F.array_sort(F.array_distinct(F.transform(tasks, lambda t: t["kind"])))
    tools = F.array_sort(F.array_distinct(F.array_compact(F.transform(tasks, lambda t: t["name"]))))
    return kinds, tools


def task_json(tasks: Column) -> Column:
    """The plan as target text."""
    each = F.transform(tasks, lambda t: F.concat(
        F.lit('{"kind": '), json_string(t["kind"]), F.lit(', "instruction": '), json_string(t["instruction"]),
        F.when(t["name"].isNotNull(), F.concat(F.lit(', "name": '), json_string(t["name"]), F.lit(', "arguments": '), t["arguments"])).otherwise(F.lit("")),
        F.lit("}"),
    ))
    return F.concat(F.lit("["), F.array_join(each, ", "), F.lit("]"))


def render_rows(plans: DataFrame, query: str = "query", system: str = "", tools: str | None = None) -> DataFrame:
    """Training rows: system, user (JSON of tools and instruction) and assistant messages, with row facets."""
    kinds, names = facets(F.col("tasks"))
    offered = F.col(tools) if tools else F.lit("[]")
    user = F.concat(F.lit('{"tools": '), offered, F.lit(', "instruction": '), json_string(F.col(query)), F.lit("}"))
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    actions = F.array_sort(F.array_distinct(F.array_compact(F.transform(
        "tasks", lambda t: F.coalesce(*[
            F.when(t["name"] == tool, F.get_json_object(t["arguments"], f"$.{key}"))
            for tool, key in (("HumanAction", "action"), ("RobotGesture", "gesture"), ("RobotDance", "dance"))
        ]),
    ))))
    return plans.withColumn("messages", F.array(
        say("system", F.lit(system)), say("user", user), say("assistant", task_json(F.col("tasks")))
    )).withColumn("level", F.size("tasks")).withColumn(
        "polarity", F.when(F.col("negative"), "negative").otherwise("positive")
    ).withColumn("kinds", kinds).withColumn("tools_used", names).withColumn("actions", actions)


# ---- augmentation ------------------------------------------------------------------------------------

def drop_used(df: DataFrame, seed=0, key: str = "example_id") -> DataFrame:
    """One called tool taken off offer; its calls become replies, polarity negative. Rows without a call drop out.

    Columns: tools (array of struct(name, kind, description, arguments_schema)), tasks, language.
    """
    _, called = facets(F.col("tasks"))
    rows = df.withColumn("_called", called).where(F.size("_called") > 0)
    pick = F.get(F.array_sort(F.transform(
        "_called", lambda n: F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key), n).cast("binary")).alias("h"), n.alias("n"))
    )), F.lit(0))["n"]
    rows = rows.withColumn("_gone", pick)
    texts = {lang: t.split("{}") for lang, t in UNAVAILABLE.items()}
    wording = F.when(F.col("language") == "zh", F.lit(texts["zh"][0])).otherwise(F.lit(texts["en"][0]))

    def swap(t: Column) -> Column:
        reply = F.struct(
            F.lit("reply").alias("kind"), F.concat(wording, t["instruction"]).alias("instruction"),
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        )
        return F.when(F.coalesce(t["name"] == F.col("_gone"), F.lit(False)), reply).otherwise(t)

    return rows.withColumn("tasks", F.transform("tasks", swap).cast(TASKS)).withColumn(
        "tools", F.filter("tools", lambda t: t["name"] != F.col("_gone"))
    ).withColumn("polarity", F.lit("negative")).withColumn("dropped_tools", F.array("_gone")).drop("_called", "_gone")


def drop_unused(df: DataFrame, seed=0, key: str = "example_id") -> DataFrame:
    """A hashed subset of the tools not called taken off offer; at least one tool stays."""
    _, called = facets(F.col("tasks"))
    unused = F.array_except(F.transform("tools", lambda t: t["name"]), called)
    most = F.least(F.size("_unused"), F.size("tools") - 1)
    rows = df.withColumn("_unused", unused).withColumn("_most", most).where(F.col("_most") >= 1)
    count = 1 + F.pmod(draw_int(f"{seed}:count", F.col(key)), F.col("_most").cast("long"))
    ordered = F.transform(F.array_sort(F.transform(
        "_unused", lambda n: F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key), n).cast("binary")).alias("h"), n.alias("n"))
    )), lambda s: s["n"])
    rows = rows.withColumn("dropped_tools", F.slice(ordered, F.lit(1), count.cast("int")))
    return rows.withColumn(
        "tools", F.filter("tools", lambda t: ~F.array_contains("dropped_tools", t["name"]))
    ).drop("_unused", "_most")


def names_a_tool(df: DataFrame, texts: Sequence[str]) -> Column:
    """Whether any text, tool description or task instruction names a tool on offer."""
    bodies = F.concat(
        F.array(*[F.coalesce(F.col(c), F.lit("")) for c in texts]) if texts else F.array().cast("array<string>"),
        F.transform("tools", lambda t: F.coalesce(t["description"], F.lit(""))), F.transform("tasks", lambda t: t["instruction"]),
    )
    return F.exists(bodies, lambda b: F.exists("tools", lambda t: b.contains(t["name"])))


def mask_names(df: DataFrame, seed=0, key: str = "example_id", texts: Sequence[str] = ("instruction", "system")) -> DataFrame:
    """Tool and argument names replaced by hashed ones in schemas, descriptions and calls; values stay.

    Rows whose texts name a real tool drop out: a renamed tool would no longer be recognisable there.
    """
    rows = df.where(~names_a_tool(df, [c for c in texts if c in df.columns]))
    rows = rows.withColumn("_m", mask_tools(draw(seed, F.col(key)), F.col("tools")))
    rows = rows.withColumn("_names", F.map_from_arrays(
        F.transform("tools", lambda t: t["name"]), F.transform("_m", lambda m: m["name"])
    )).withColumn("_renames", F.map_from_arrays(
        F.transform("tools", lambda t: t["name"]), F.transform("_m", lambda m: m["renames"])
    ))
    arguments = rename_arguments(
        F.transform("tasks", lambda t: t["arguments"]),
        F.transform("tasks", lambda t: F.element_at("_renames", F.coalesce(t["name"], F.lit("")))),
    )
    rows = rows.withColumn("_a", arguments)
    tasks = F.transform("tasks", lambda t, i: F.when(t["kind"] == "reply", t).otherwise(F.struct(
        t["kind"].alias("kind"), t["instruction"].alias("instruction"), F.element_at("_names", t["name"]).alias("name"),
        F.get("_a", i).alias("arguments"),
    )))
    return rows.withColumn("tasks", tasks.cast(TASKS)).withColumn(
        "tools", F.transform("_m", lambda m: F.struct(*[m[c].alias(c) for c in ("name", "kind", "description", "arguments_schema")]))
    ).withColumn("tool_map", F.col("_names")).drop("_m", "_a", "_names", "_renames")


def shuffle_tools(df: DataFrame, seed=0, key: str = "example_id") -> DataFrame:
    ordered = F.array_sort(F.transform("tools", lambda t: F.struct(
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key), t["name"]).cast("binary")).alias("h"), t.alias("t")
    )))
    return df.withColumn("tools", F.transform(ordered, lambda s: s["t"]))


def valid_against_tools(tasks: Column, tools: Column) -> Column:
    """Whether each call names an offered tool of its kind (argument schemas are checked by ``parse_plans``)."""
    return F.forall(tasks, lambda t: (t["kind"] == "reply") | F.exists(
        tools, lambda o: (o["name"] == t["name"]) & (o["kind"] == t["kind"])
    ))


def augment(df: DataFrame, rates: dict[str, float], seed=0, key: str = "example_id") -> DataFrame:
    """Variants of real-named rows, each gated by its rate, with shuffled tools and recomputed facets."""
    out = None
    for variant in VARIANTS:
        rate = rates.get(variant, 0.0)
        if rate <= 0:
            continue
        rows = df.where(F.coalesce("tool_naming", F.lit("real")) == "real")
        rows = rows.where(draw_uniform(f"{seed}:{variant}:rate", F.col(key)) < rate)
        tag = f"{seed}:{variant}"
        if variant == "masked":
            rows = mask_names(rows, tag, key).drop("tool_map").withColumn("dropped_tools", F.array().cast("array<string>"))
        elif variant == "drop_used":
            rows = drop_used(rows, tag, key)
        else:
            rows = drop_unused(rows, tag, key)
        rows = shuffle_tools(rows, tag, key)
        kinds, names = facets(F.col("tasks"))
        rows = rows.withColumn("variant", F.lit(variant)).withColumn("kinds", kinds).withColumn("tools_used", names)
        rows = rows.withColumn("tool_naming", F.lit("masked" if variant == "masked" else "real"))
        rows = rows.withColumn("valid", valid_against_tools(F.col("tasks"), F.col("tools")))
        rows = rows.withColumn(key, F.concat_ws("_", F.col(key), F.lit(variant)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no variant has a rate above zero")
    return out


# ---- slot variants ------------------------------------------------------------------------------------

#: Atoms of a slot that meet its values in one task.
VARIANT_ROWS = 16_384


def slot_variants(atoms: DataFrame, values: DataFrame, part: str, n: int, seed=0, key: str = "id", text: str = "query",
                  value: str = "value") -> DataFrame:
    """Up to n texts per atom with its slot value replaced by other values of a split, those of the smallest hash of atom and value.

    ``atoms``: (id, query, slot, value); the value must occur exactly once. ``values``: (slot, part, surface): a bounded
    list per slot and split. Blocks of a slot's atoms meet its list once, so no list is carried by each atom.
    """
    once = (F.length(text) - F.length(F.replace(F.col(text), F.col(value), F.lit("")))) == F.length(value)
    usable = atoms.where(once & (F.length(value) > 0))
    usable = usable.select("slot", *[c for c in usable.columns if c != "slot"])
    columns = usable.columns
    lists = values.where(F.col("part") == part).groupBy("slot").agg(F.collect_set("surface").alias("_v"))
    blocks = usable.groupBy("slot").agg(F.ceil(F.count(F.lit(1)) / VARIANT_ROWS).cast("int").alias("_n"))
    heads = usable.withColumn("_head", F.concat_ws(":", F.lit(f"{seed}:{part}"), F.col(key), F.lit("")))
    dealt = heads.join(blocks, "slot").withColumn(
        "_b", F.pmod(F.xxhash64("_head"), F.col("_n").cast("long")).cast("int")
    ).drop("_n")
    copies = lists.join(blocks, "slot").withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select("slot", "_b", "_v")
    at, head = columns.index(value), len(columns)

    def pick(rows: pa.Table, listed: pa.Table) -> pa.Table:
        tails = listed.column("_v")[0].as_py() if len(listed) else []
        own = [v.encode() for v in rows.column(at).to_pylist()]
        picks = smallest_md5([h.encode() for h in rows.column(head).to_pylist()], [t.encode() for t in tails], n, own)
        taken = rows.take(pa.array([i for i, p in enumerate(picks) for _ in p], pa.int64())).select(columns)
        return taken.append_column("new_value", pa.array([tails[j] for p in picks for j in p], pa.string()))

    kinds = StructType([*dealt.select(*columns).schema.fields, StructField("new_value", StringType())])
    rows = dealt.groupBy("slot", "_b").cogroup(copies.groupBy("slot", "_b")).applyInArrow(pick, kinds)
    swapped = F.overlay(F.col(text), F.col("new_value"), F.position(F.col(value), F.col(text)), F.length(value))
    return rows.withColumn("new_text", swapped).select(*columns, "new_text", "new_value").withColumn("part", F.lit(part))


def surfaces_present(df: DataFrame, query: str = "query", slots: str = "slot_values") -> DataFrame:
    """``surfaces_ok``: each slot value shows one of its surfaces; cities by exact case, others ignoring case.

    ``slot_values``: array of struct(slot, surfaces).
    """
    text, lowered = F.col(query), F.lower(query)

    def shown(s: Column) -> Column:
        exact = F.exists(s["surfaces"], lambda x: text.contains(x))
        loose = F.exists(s["surfaces"], lambda x: lowered.contains(F.lower(x)))
        return (F.size(s["surfaces"]) <= 0) | F.when(s["slot"] == "city", exact).otherwise(loose)

    return df.withColumn("surfaces_ok", F.forall(F.coalesce(F.col(slots), F.array().cast("array<struct<slot:string,surfaces:array<string>>>")), shown))
