"""Labels implied by wording: rule tables applied as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording patterns of the planning contract.
TURN = r"转|旋"
BACK = r"后退|倒退|退|(?:往|向|朝)后(?!转|面)"
FORWARD = r"前进|(?:往|向|朝)前"
LEFT = r"左"
RIGHT = r"右"
POSTURES = (
    ("sit_down", r"坐"),
    ("lie_down", r"躺"),
    ("stand_up", r"站|起身|起立|直立|立正|立起|起来"),
)
STEP = r"(\d+|[零一二两三四五六七八九十百]+)\s*步"
DEGREE = r"(\d+|[零一二两三四五六七八九十]+)\s*(?:度|°)"
EXPLICIT_DEGREE = r"(?i)\d+\s*(?:度|°|degree)|[一二三四五六七八九十百]+度"
TURN_DEGREES = (
    (360, r"(?i)圈|circle|spin|360"),
    (180, r"(?i)向后转|往后转|转.{0,2}身|掉头|后面|背对|around|backward|about[- ]face"),
    (15, r"(?i)一点|一下|一些|一点儿|一丢|稍|微|轻轻|a little|a bit|slightly|briefly|a touch"),
)
BARE_TURN = 90
MOVE = 0.6
PLACE_HINT = r"[省市县]"
DEFAULT_CITY = "深圳"
NOW = r"现在|当前|此刻|今天|今日|这会|眼下|目前|实时"
WITHIN_DAY = r"今晚|今夜|明天|明早|明晚|明日|几点|待会|等会|一会儿|小时|夜里|晚上|凌晨|上午|中午|下午|傍晚"
WITHIN_WEEK = r"这周|本周|周末|几天|一周|七天|7天|下周|星期|礼拜"
GESTURES = (
    ("blow_kisses_multi", r"飞.{0,2}吻"),
    ("curtain_bow", r"谢幕"),
    ("bow", r"鞠.{0,2}躬"),
    ("clap", r"鼓.{0,2}掌|拍.{0,2}手|掌声"),
    ("high_five", r"(?i)击.{0,2}掌|high\s*five|give me five"),
    ("nod", r"点.{0,2}头"),
    ("shake_head", r"摇.{0,2}头"),
    ("shake_hands", r"握.{0,2}手"),
    ("this_way_please", r"这边请|请.{0,4}这边|请的手势|指引|引导|引路"),
    ("wave_greet_bye", r"(?i)挥.{0,2}手|招.{0,2}手|拜拜|再见|回头见|打.{0,2}招呼|道别|告别|bye"),
)
HEART = r"比(?!较|如).{0,8}心|爱心|心形"
STATUS = (
    ("电量", r"电量|电池|没电|充电|续航|撑多久|还能用多久|电还|多少电"),
    ("日期", r"日期|几号|几月|星期几|周几|礼拜几|哪一天|哪天"),
    ("时间", r"几点|时间|钟点|几时"),
    ("位置", r"位置|在哪|哪里|哪儿|什么地方|定位|所在的?(省份|城市)"),
    ("型号", r"型号|版本|哪款|哪一款|什么款|什么机器人|什么系列"),
    ("当前动作", r"在做什么|在干什么|在干嘛|在忙|忙吗|空闲|在做啥|在干啥|什么动作|什么姿势|当前动作|在执行|在运行|执行什么"),
)
ANY_DANCE = r"舞|跳一段|跳一个|跳一支|跳个"
GENERIC_DANCE = "warm_up_dance"


def matched(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Names of the rules whose pattern occurs, in rule order."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in rules]))


def only_one(names: Column) -> Column:
    return F.when(F.size(names) == 1, F.get(names, F.lit(0)))


#: Fixed value: the numerals in order; a numeral's place is its value.
NUMERALS = "零一二三四五六七八九"


def chinese_number(col: Column) -> Column:
    """Digits, one numeral (两 is 2), or a form with one 十; null for anything else, 百 among it.

    Numerals that follow each other in counting order read as the first of them (一二 gives 1), others give null.
    """
    place = lambda c: F.instr(F.lit(NUMERALS), c) - 1
    head = F.substring_index(col, "十", 1)
    tail = F.substr(col, F.length(head) + 2)
    tens = F.when(head == "", F.lit(1)).otherwise(place(head))
    ones = F.when(tail == "", F.lit(0)).otherwise(place(tail))
    return F.when(col.rlike(r"^\d+$"), col.try_cast("int")).when(col == "两", F.lit(2)).when(
        (col != "") & (place(col) >= 0), place(col)
    ).when(col.contains("十") & ~col.contains("百") & (tens >= 1) & (ones >= 0), tens * 10 + ones)


def turn_degree(text: Column) -> Column:
    """Named degree, else the first phrase rule, else a quarter turn."""
    named = F.regexp_extract_all(text, F.lit(DEGREE), F.lit(1))
    rule = F.lit(BARE_TURN)
    for value, pattern in reversed(TURN_DEGREES):
        rule = F.when(text.rlike(pattern), F.lit(value)).otherwise(rule)
    return F.when(
        text.rlike(EXPLICIT_DEGREE), F.when(F.size(named) == 1, chinese_number(F.get(named, F.lit(0))))
    ).otherwise(rule)


def _walk(x, y, yaw, **rest) -> Column:
    members = [F.lit('"x":'), x, F.lit(',"y":'), y, F.lit(',"yaw":'), yaw]
    for name, value in rest.items():
        members += [F.lit(f',"{name}":'), value]
    text = F.concat(F.lit('{"action":"walk","parameters":{'), *[m.cast("string") for m in members], F.lit("}}"))
    return text


def derive_motion(text: Column) -> Column:
    """Argument JSON one motion wording implies, or null."""
    postures = matched(text, POSTURES)
    left, right = text.rlike(LEFT), text.rlike(RIGHT)
    ahead, back = text.rlike(FORWARD), text.rlike(BACK)
    degree = turn_degree(text)
    turned = F.when(
        (F.size(postures) == 0) & ~ahead & ~back & degree.isNotNull(),
        _walk(F.lit("0"), F.lit("0"), F.when(right, F.lit("-1")).otherwise(F.lit("1")), degree=degree, step=F.lit("1")),
    )
    ways = sum((c.cast("int") for c in (back, left, right)), ahead.cast("int"))
    steps = F.regexp_extract_all(text, F.lit(STEP), F.lit(1))
    step = F.when(F.size(steps) == 0, F.lit(1)).when(F.size(steps) == 1, chinese_number(F.get(steps, F.lit(0))))
    x = F.when(ahead, F.lit(str(MOVE))).when(back, F.lit(str(-MOVE))).otherwise(F.lit("0"))
    y = F.when(left, F.lit("1")).when(right, F.lit("-1")).otherwise(F.lit("0"))
    moved = F.when((ways == 1) & (F.size(postures) == 0) & step.isNotNull(), _walk(x, y, F.lit("0"), step=step))
    posed = F.when(F.size(postures) == 1, F.concat(F.lit('{"action":"'), F.get(postures, F.lit(0)), F.lit('"}')))
    return F.when(left & right, F.lit(None).cast("string")).when(text.rlike(TURN), turned).when(ways > 0, moved).otherwise(posed)


def derive_weather(text: Column, cities: Sequence[str]) -> Column:
    """City (default when no place is named) and forecast range, or null for two cities, an unknown place, or two ranges."""
    named = F.array_compact(F.array(*[F.when(text.contains(c), F.lit(c)) for c in sorted(cities, key=len, reverse=True)]))
    now, day, week = text.rlike(NOW), text.rlike(WITHIN_DAY), text.rlike(WITHIN_WEEK)
    kind = F.when(week, F.when(now, "now_7d").otherwise("7d")).when(day, "24h").otherwise("now")
    unusable = (F.size(named) > 1) | ((F.size(named) == 0) & text.rlike(PLACE_HINT)) | (week & day)
    city = F.coalesce(F.get(named, F.lit(0)), F.lit(DEFAULT_CITY))
    return F.when(~unusable, F.concat(F.lit('{"city":"'), city, F.lit('","query_type":"'), kind, F.lit('"}')))


def derive_gesture(text: Column) -> Column:
    """The only gesture a wording names; a heart is by its hand, a curtain call is not also a bow."""
    found = matched(text, GESTURES)
    found = F.when(F.array_contains(found, "curtain_bow"), F.array_remove(found, "bow")).otherwise(found)
    left, right = text.contains("左"), text.contains("右")
    heart = F.when(left, "left_hand_side_heart").when(right, "right_hand_side_heart").otherwise("hand_heart")
    has_heart = text.rlike(HEART)
    found = F.when(has_heart, F.array_append(found, heart)).otherwise(found)
    one = F.when(~(has_heart & left & right), only_one(found))
    return F.when(one.isNotNull(), F.concat(F.lit('{"gesture":"'), one, F.lit('"}')))


def derive_dance(text: Column, dances: Sequence[tuple[str, str]], ambiguous: str = "女团舞") -> Column:
    """The only dance a wording names; an unnamed dance is the generic one. ``dances``: (name, pattern) rules."""
    found = matched(text, dances)
    generic = (F.size(found) == 0) & ~text.contains(ambiguous) & text.rlike(ANY_DANCE)
    one = F.coalesce(only_one(found), F.when(generic, F.lit(GENERIC_DANCE)))
    return F.when(one.isNotNull(), F.concat(F.lit('{"dance":"'), one, F.lit('"}')))


def derive_status(text: Column, cities: Sequence[str]) -> Column:
    """The only status item a wording names; a named city asks about the world."""
    city = F.lit(False)
    for c in cities:
        city = city | text.contains(c)
    one = F.when(~city, only_one(matched(text, STATUS)))
    return F.when(one.isNotNull(), F.concat(F.lit('{"query":"'), one, F.lit('"}')))


def derive_labels(df: DataFrame, text: str = "query", tool: str = "expected_function", cities: Sequence[str] = (),
                  dances: Sequence[tuple[str, str]] = (), out: str = "derived") -> DataFrame:
    """Argument JSON the wording implies for the row's tool."""
    t, name = F.col(text), F.col(tool)
    derived = F.when(name == "HumanAction", derive_motion(t)).when(name == "get_weather", derive_weather(t, cities))
    derived = derived.when(name == "RobotGesture", derive_gesture(t)).when(name == "robot_status", derive_status(t, cities))
    if dances:
        derived = derived.when(name == "RobotDance", derive_dance(t, dances))
    return df.withColumn(out, derived)


def canonical_params(df: DataFrame, params: str = "expected_params", texts: str = "text", tool: str = "expected_function") -> DataFrame:
    """Turn degrees by the phrase rules, forward and backward moves to the fixed magnitude; open bounds to the side they allow."""
    parsed = F.try_parse_json(params)
    inner = F.try_variant_get(parsed, "$.parameters", "map<string,variant>")
    number = lambda k: F.try_variant_get(parsed, f"$.parameters.{k}", "double")
    text = F.col(texts)
    turn = F.map_contains_key(inner, "degree") & F.coalesce(number("yaw") != 0, F.lit(False)) & ~text.rlike(EXPLICIT_DEGREE)
    bound = lambda k: F.try_variant_get(parsed, f"$.parameters.x.{k}", "double")
    is_range = F.coalesce(F.schema_of_variant(F.try_variant_get(parsed, "$.parameters.x", "variant")).startswith("OBJECT"), F.lit(False))

    def inside(v: float) -> Column:
        ok = F.lit(True)
        for k, test in (("min", lambda b: F.lit(v) >= b), ("gte", lambda b: F.lit(v) >= b), ("gt", lambda b: F.lit(v) > b),
                        ("max", lambda b: F.lit(v) <= b), ("lte", lambda b: F.lit(v) <= b), ("lt", lambda b: F.lit(v) < b)):
            ok = ok & F.coalesce(test(bound(k)), F.lit(True))
        return ok

    both = F.when(inside(MOVE) & ~inside(-MOVE), F.lit(MOVE)).when(~inside(MOVE) & inside(-MOVE), F.lit(-MOVE))
    plain = F.when(number("x") > 0, F.lit(MOVE)).when(number("x") < 0, F.lit(-MOVE))
    x = F.when(is_range, both).otherwise(plain)
    move = ~F.map_contains_key(inner, "degree") & F.map_contains_key(inner, "x") & x.isNotNull()
    replaced = F.map_concat(
        F.map_filter(inner, lambda k, v: ~((k == "degree") & turn) & ~((k == "x") & move)),
        F.when(turn, F.create_map(F.lit("degree"), F.parse_json(turn_degree(text).cast("string")))).otherwise(
            F.create_map().cast("map<string,variant>")
        ),
        F.when(move, F.create_map(F.lit("x"), F.parse_json(x.cast("string")))).otherwise(
            F.create_map().cast("map<string,variant>")
        ),
    )
    outer = F.try_variant_get(parsed, "$", "map<string,variant>")
    rebuilt = F.to_json(F.map_concat(
        F.map_filter(outer, lambda k, v: k != "parameters"), F.create_map(F.lit("parameters"), F.parse_json(F.to_json(replaced)))
    ))
    applies = (F.col(tool) == "HumanAction") & inner.isNotNull() & (turn | move)
    return df.withColumn(params, F.when(F.coalesce(applies, F.lit(False)), rebuilt).otherwise(F.col(params)))


def normalize_atoms(df: DataFrame) -> DataFrame:
    """Atoms in contract shape.

    Columns: query, test_input, kind, expected_function, expected_params, steps (array of struct(expected_function,
    expected_params)). Replies lose steps and labels; a call keeps exactly one step, whose values the flat fields
    take over; a document query without parameters asks for the text itself. ``atom_error`` flags a bad call.
    """
    text = F.coalesce("test_input", "query")
    steps = F.coalesce(
        F.col("steps"), F.array(F.struct(F.col("expected_function"), F.col("expected_params")))
    )
    step = F.get(steps, F.lit(0))
    reply = F.col("kind") == "reply"
    asks = (step["expected_function"] == "rag_query") & step["expected_params"].isNull()
    params = F.when(asks, F.to_json(F.struct(F.trim(text).alias("query")))).otherwise(step["expected_params"])
    fixed = F.array(F.struct(step["expected_function"].alias("expected_function"), params.alias("expected_params")))
    error = F.when(F.col("kind").isNull(), "atom is missing its target").when(
        ~reply & (F.size(steps) != 1), "call atom must contain exactly one expected step"
    ).when(~reply & step["expected_function"].isNull(), "call atom has no executable step")
    out = df.withColumn("_steps", F.when(reply, F.slice(fixed, 1, 0)).otherwise(fixed)).withColumn("_error", error).withColumn("_text", text)
    return (
        out.withColumn("test_input", F.col("_text")).withColumn("steps", F.col("_steps"))
        .withColumn("expected_function", F.get("_steps", F.lit(0))["expected_function"])
        .withColumn("expected_params", F.get("_steps", F.lit(0))["expected_params"])
        .withColumn("atom_error", F.col("_error")).drop("_steps", "_error", "_text")
    )


def source_cell(df: DataFrame, cells: DataFrame, atom: str = "atom_name", negative: str = "negative_sample") -> DataFrame:
    """Topic of an atom: the gesture or dance of its cell, else the cell. ``cells``: (cell_id, gesture, dance)."""
    named = F.col(atom)
    cell = F.when(F.coalesce(F.col(negative), F.lit(False)), F.regexp_replace(named, r"^[^_]*_[^_]*_", "")).otherwise(named)
    known = cells.select(F.col("cell_id").alias("_cell"), "gesture", "dance")
    joined = df.withColumn("_c", cell).join(known, F.col("_c") == F.col("_cell"), "left")
    topic = F.coalesce(
        F.concat(F.lit("gesture:"), F.col("gesture")), F.concat(F.lit("dance:"), F.col("dance")), F.col("_c")
    )
    return joined.withColumn("topic", topic).drop("_c", "_cell", "gesture", "dance")
