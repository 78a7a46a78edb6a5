"""Rule screening: every row gets the list of rules it breaks. Rules are data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import norm_text
from parlance.plans.scoring import merged_replies

# Marks of rejected wordings.
LEAK = r"一口气说完|没有标点|语气词|错别字|同音字|重复的词|口语噪声|说话人|不同场景"
QUOTES = r"[「」『』《》“”\"]"
ABILITY = r"能不能|可不可以|能否|会不会|(能|可以)[^，。！？,.!?]{0,14}[吗嘛么]"
NICKNAMES = r"小(助|宝|智|艾|爱|度|护士|帮手|家伙|机灵|伙子|展)|助手"
ADDRESS = r"机器人|" + NICKNAMES
ADDRESS_EN = r"(?i)\brobot\b|" + NICKNAMES
HAN = r"[\x{4e00}-\x{9fff}]"
MOVE_KEYS = ("x", "y", "yaw")

WORDING_RULES = (("prompt leak", LEAK), ("quotes", QUOTES), ("address term", ADDRESS))


def issues(*rules: tuple[str, Column]) -> Column:
    """Names of the broken rules, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules]))


def screen(df: DataFrame, text: str, required: Sequence[str] = (), patterns: Sequence[tuple[str, str]] = WORDING_RULES,
           extra: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """``issues``: empty required fields, pattern rules on the text, further conditions."""
    empty = F.lit(False)
    for c in (text, *required):
        empty = empty | (F.coalesce(F.col(c), F.lit("")) == "")
    rules = [("empty field", empty)] + [(name, F.col(text).rlike(p)) for name, p in patterns] + list(extra)
    return df.withColumn("issues", issues(*rules))


def screen_pool(df: DataFrame, text: str, order: str, **kw) -> DataFrame:
    """Screening plus ``duplicate``: a later clean copy of a clean row's normalised text.

    The first clean row of a text is found by a grouped minimum, so a hot text is merged before the shuffle.
    """
    rows = screen(df, text, **kw).withColumn("_norm", F.sha2(norm_text(F.col(text)), 256))
    clean = F.size("issues") == 0
    first = rows.where(clean).groupBy("_norm").agg(F.min(order).alias("_first"))
    later = rows.join(first, "_norm", "left").withColumn("_dup", F.coalesce(F.col(order) > F.col("_first"), F.lit(False)))
    return later.withColumn(
        "issues", F.when(F.col("_dup"), F.concat("issues", F.array(F.lit("duplicate")))).otherwise(F.col("issues"))
    ).drop("_norm", "_first", "_dup")


def screen_rewrites(df: DataFrame, rules: DataFrame, query: str = "query", source: str = "source_query",
                    variant: str = "variant") -> DataFrame:
    """Rewrites against the rule row of their variant.

    Rule columns (nullable): marker (required pattern), ability (whether an ability question is wanted), keeps (the
    source label must stay or go), count_word, name_pattern. Row columns: derived and label (texts), count_word.
    """
    named = rules.select(F.col("variant").alias("_v"), *[F.col(c).alias(f"_r_{c}") for c in ("marker", "ability", "keeps", "name_pattern")])
    rows = df.join(named, F.col(variant) == F.col("_v"), "left")
    text = F.col(query)
    asks = text.rlike(ABILITY)
    hits = lambda c: F.size(F.regexp_extract_all(c, F.lit(ADDRESS), F.lit(0)))
    word = F.col("count_word") if "count_word" in df.columns else F.lit(None).cast("string")
    missing_word = word.isNotNull() & ~text.contains(word) & ~((word == "两") & text.contains("二"))
    rows = rows.withColumn("issues", issues(
        ("empty", F.coalesce(text, F.lit("")) == ""),
        ("unchanged", norm_text(text) == norm_text(F.col(source))),
        ("prompt leak", text.rlike(LEAK)),
        ("quotes", text.rlike(QUOTES)),
        ("address term", hits(text) > hits(F.col(source))),
        ("no ability marker", F.col("_r_ability") & ~asks),
        ("ability question", ~F.coalesce("_r_ability", F.lit(False)) & asks),
        ("no marker", F.col("_r_marker").isNotNull() & ~F.regexp_like(text, F.col("_r_marker"))),
        ("wrong count", missing_word),
        ("lost name", F.col("_r_name_pattern").isNotNull() & ~F.regexp_like(text, F.col("_r_name_pattern"))),
        ("label lost", F.col("_r_keeps") & ~F.col("derived").eqNullSafe(F.col("label"))),
        ("label kept", ~F.col("_r_keeps") & F.col("derived").isNotNull()),
    ))
    return rows.drop("_v", *[f"_r_{c}" for c in ("marker", "ability", "keeps", "name_pattern")])


def screen_translation(df: DataFrame, names: DataFrame, query: str = "query", instruction: str = "instruction",
                       source: str = "source_query") -> DataFrame:
    """``reason`` of an unusable translation, or null.

    ``names``: small table (name, translated). Row columns: span (must occur; null = none wanted), city (as translated; null = none).
    The name table is folded into one array value.
    """
    table = names.select(F.struct(F.col("name"), F.col("translated")).alias("n")).limit(10_001).agg(
        F.when(F.count(F.lit(1)) > 10_000, F.raise_error(F.lit("name table too large")).cast("boolean")).alias("_b"),
        F.collect_list("n").alias("t"),
    ).where(F.col("_b").isNull()).select("t").scalar()
    df = df.withColumn("_names", table)
    text = F.lower(query)
    present = F.filter("_names", lambda n: F.col(source).contains(n["name"]))
    lost = F.exists(present, lambda n: ~text.contains(F.lower(n["translated"])))
    added = F.exists("_names", lambda n: ~F.col(source).contains(n["name"]) & text.contains(F.lower(n["translated"])))
    span, city = F.col("span"), F.col("city")
    reason = (
        F.when((F.coalesce(F.col(query), F.lit("")) == "") | (F.coalesce(F.col(instruction), F.lit("")) == ""), "empty")
        .when(F.col(query).rlike(HAN) | F.col(instruction).rlike(HAN), "source script left")
        .when(lost, "name lost")
        .when(added, "name added")
        .when(span.isNotNull() & ((span == "") | ~F.col(query).contains(span)), "span")
        .when(city.isNotNull() & ((city == "") | city.rlike(HAN) | ~text.contains(F.lower(city))), "city")
    )
    return df.withColumn("reason", reason).drop("_names")


def check_quotes(df: DataFrame, query: str = "query", items: str = "items", extra: str = "extra") -> DataFrame:
    """``reason`` when a merge judge missed a source, quoted nothing, or quoted out of order; else null.

    ``items``: array of struct(kept, quote) by source. Quotes are looked for one after the other, ignoring case.
    """
    text = F.lower(F.coalesce(F.col(query), F.lit("")))
    missing = F.filter(F.transform(items, lambda x, i: F.when(~F.coalesce(x["kept"], F.lit(False)), i + 1)), lambda i: i.isNotNull())
    quotes = F.transform(items, lambda x: F.lower(F.trim(F.coalesce(x["quote"], F.lit("")))))
    df = df.withColumn("_q", quotes).withColumn("_t", text)
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("bad"))

    def step(state: Column, q: Column) -> Column:
        rest = F.substr(F.col("_t"), state["at"] + 1)
        found = F.position(q, rest)
        bad = F.when((q == "") | ~F.col("_t").contains(q), F.lit("quote not found")).when(found == 0, F.lit("order"))
        return F.when(state["bad"].isNotNull(), state).otherwise(
            F.struct((state["at"] + found).alias("at"), bad.alias("bad"))
        )

    walked = F.aggregate("_q", start, step, lambda s: s["bad"])
    reason = F.when(F.size(missing) > 0, F.concat(F.lit("judge misses "), F.to_json(missing))).otherwise(
        F.coalesce(walked, F.when(F.size(F.coalesce(F.col(extra), F.array().cast("array<string>"))) > 0, F.lit("judge extra")))
    )
    return df.withColumn("reason", reason).drop("_q", "_t")


def reorder_by_quote(df: DataFrame, query: str = "query", items: str = "items", labels: str = "labels") -> DataFrame:
    """Labels and items of rows with reason ``order`` put in the order their quotes occur."""
    text = F.lower(F.col(query))
    keyed = F.transform(
        F.arrays_zip(F.col(items).alias("item"), F.col(labels).alias("label")),
        lambda z, i: F.struct(
            F.position(F.lower(F.trim(z["item"]["quote"])), text).alias("at"), i.alias("i"), z["item"].alias("item"), z["label"].alias("label")
        ),
    )
    df = df.withColumn("_s", F.array_sort(keyed))
    moved = F.col("reason") == "order"
    return df.withColumn(items, F.when(moved, F.transform("_s", lambda s: s["item"])).otherwise(F.col(items))).withColumn(
        labels, F.when(moved, F.transform("_s", lambda s: s["label"])).otherwise(F.col(labels))
    ).drop("_s")


def agrees(label: Column, verdict: Column) -> Column:
    """Label against verdict, both struct(tool, params JSON); tool ``reply`` for replies.

    Movement is compared by sign, step and degree by value with defaults 1 and 90, search tools by name only.
    """
    get = lambda s, path: F.get_json_object(s["params"], path)
    num = lambda s, path, default: F.coalesce(get(s, path).try_cast("double"), F.lit(float(default)))
    tool = label["tool"]
    flat = ("RobotGesture", "RobotDance", "robot_status")
    same_params = F.coalesce(
        F.to_json(F.try_parse_json(label["params"])) == F.to_json(F.try_parse_json(verdict["params"])), F.lit(False)
    )
    weather = get(label, "$.city").eqNullSafe(get(verdict, "$.city")) & get(label, "$.query_type").eqNullSafe(get(verdict, "$.query_type"))
    same_action = get(label, "$.action").eqNullSafe(get(verdict, "$.action"))
    move = same_action
    for k in MOVE_KEYS:
        move = move & (F.signum(num(verdict, f"$.{k}", 0)) == F.signum(num(label, f"$.parameters.{k}", 0)))
    # a step of 0 falls back to the default, as a missing one does
    or_default = lambda c, d: F.when(c == 0, F.lit(float(d))).otherwise(c)
    move = move & (F.floor(or_default(num(verdict, "$.step", 1), 1)) == F.floor(num(label, "$.parameters.step", 1)))
    turns = num(label, "$.parameters.yaw", 0) != 0
    degree = F.floor(or_default(num(verdict, "$.degree", 90), 90)) == F.floor(num(label, "$.parameters.degree", 90))
    move = move & (~turns | degree)
    return F.coalesce(
        F.when(tool == "reply", verdict["tool"] == "reply")
        .when(tool != verdict["tool"], F.lit(False))
        .when(tool.isin(*flat), same_params)
        .when(tool == "get_weather", weather)
        .when((tool == "HumanAction") & (get(label, "$.action") != "walk"), same_action)
        .when(tool == "HumanAction", move)
        .otherwise(F.lit(True)),
        F.lit(False),
    )


def label_agreement(df: DataFrame, label: str = "label", verdict: str = "verdict") -> DataFrame:
    return df.withColumn("agree", agrees(F.col(label), F.col(verdict)))


def consensus(df: DataFrame, labels: str = "labels", verdicts: str = "verdicts") -> DataFrame:
    """``disputed`` unless every reviewer's list matches the labels one to one, adjacent replies merged on both sides."""
    is_reply = lambda t: t["tool"] == "reply"
    df = df.withColumn("_l", merged_replies(F.col(labels), is_reply))

    def matches(v: Column) -> Column:
        merged = merged_replies(v, is_reply)
        fits = F.zip_with("_l", merged, lambda a, b: F.when(a.isNull() | b.isNull(), F.lit(False)).otherwise(agrees(a, b)))
        return F.coalesce(F.forall(fits, lambda x: x), F.lit(False))

    return df.withColumn("disputed", ~F.forall(verdicts, matches)).drop("_l")
