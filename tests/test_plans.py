import json

import pytest
from pyspark.sql import functions as F

from parlance import adapters
from parlance.operators import screening
from parlance.plans import compose, labels, reports, scoring, textmetrics
from parlance.plans.openjson import schema_error

CASE = "expected array<struct<kind string,instruction string,name string,arguments string>>, output string, forbidden_functions array<string>, error string"
WALK = ("action", "go", "HumanAction", '{"action":"walk","parameters":{"x":0.6,"step":1}}')
REPLY = ("reply", "say hi", None, None)


def out(*tasks):
    items = []
    for kind, instruction, name, arguments in tasks:
        item = {"kind": kind, "instruction": instruction}
        if name:
            item |= {"name": name, "arguments": json.loads(arguments)}
        items.append(item)
    return "text " + json.dumps(items) + " more"


def walk(x, step=1):
    return ("action", "go", "HumanAction", json.dumps({"action": "walk", "parameters": {"x": x, "step": step}}))


CASES = [
    ([WALK], out(walk(0.1)), [], None, "passed", "passed"),  # direction by sign
    ([WALK], out(walk(-0.1)), [], None, "task_parameter_mismatch", "parameter_mismatch"),
    ([WALK], out(walk(0.6, 3)), [], None, "task_parameter_mismatch", "passed"),  # steps are exempt in the compatible score
    ([WALK], out(walk(5)), [], None, "contract_violation", "parser_rejected"),
    ([WALK], "no plan", [], None, "invalid_json", "parser_rejected"),
    ([WALK], "[", [], None, "invalid_json", "parser_rejected"),
    ([WALK], "[{]", [], None, "invalid_json", "parser_rejected"),
    ([WALK], '[{"kind": "reply"}]', [], None, "invalid_task_schema", "parser_rejected"),
    ([WALK], None, [], None, "invalid_json", "parser_rejected"),
    ([WALK], out(WALK), [], "timeout", "backend_error", "backend_error"),
    ([REPLY], out(WALK), ["HumanAction"], None, "forbidden_tool", "forbidden_tool"),
    ([REPLY, WALK], out(WALK), [], None, "task_count_mismatch", "passed"),  # a reply slot may be skipped
    ([REPLY], out(("query", "q", "robot_status", '{"query":"x"}')), ["HumanAction"], None, "task_kind_mismatch", "passed"),
    ([("action", "a", "RobotGesture", '{"action":"bow","repeat":1}')], out(("action", "a", "RobotGesture", '{"gesture":"bow"}')), [], None, "passed", "passed"),
    ([("action", "a", "HumanAction", '{"action":"walk","parameters":{"x":{"gt":0.2,"lte":0.5}}}')], out(walk(0.5)), [], None, "passed", "passed"),
    ([("action", "a", "HumanAction", '{"action":"walk","parameters":{"x":{"gt":0.5}}}')], out(walk(0.5)), [], None, "task_parameter_mismatch", "parameter_mismatch"),
    ([("action", "a", "HumanAction", '{"action":"walk","parameters":{"x":{"gt":0.5,"foo":1}}}')], out(walk(0.5)), [], None, "task_parameter_mismatch", "parameter_mismatch"),
    ([("query", "a", "web_search", '{"query":"x"}')], out(("query", "a", "web_search", '{"query":"y"}')), [], None, "passed", "passed"),
]


def test_score_ladders(spark):
    df = spark.createDataFrame([c[:4] for c in CASES], CASE).withColumn("n", F.monotonically_increasing_id()).coalesce(1)
    df = spark.createDataFrame([(*c[:4], i) for i, c in enumerate(CASES)], CASE + ", n int")
    rows = scoring.score_compatible(scoring.score_strict(df, adapters.contract(spark)), adapters.contract(spark)).orderBy("n").collect()
    assert [(r["n"], r["reason"], r["compatible_reason"]) for r in rows] == [(i, c[4], c[5]) for i, c in enumerate(CASES)]
    by = {r["n"]: r for r in rows}
    assert by[17]["parameter_match"] is None  # skipped tools are not compared
    assert by[0]["parameter_match"] is True and by[3]["parameter_match"] is False and by[4]["parameter_match"] is None


def test_schema_keywords():
    schema = {"oneOf": [{"type": "object", "required": ["a"]}, {"type": "object", "required": ["b"]}]}
    assert schema_error({"a": 1}, schema) is None and schema_error({"a": 1, "b": 2}, schema)
    assert schema_error({"n": True}, {"properties": {"n": {"type": "integer"}}}) and schema_error(1.0, {"type": "integer"}) is None
    assert schema_error({"z": 1}, {"additionalProperties": False, "properties": {}}) and schema_error("b", {"enum": ["a"]})


def test_signature_and_adjustment(spark):
    tasks = [REPLY, REPLY, walk(-0.2), ("action", "g", "RobotGesture", '{"gesture":"bow","repeat":3,"latitude":1}')]
    df = spark.createDataFrame([(tasks,)], "tasks array<struct<kind string,instruction string,name string,arguments string>>")
    assert scoring.plan_signature(df).collect()[0]["signature"] == "reply;HumanAction|walk|x=-1;RobotGesture|bow"
    grown = scoring.adjust_plan(df).collect()[0]["tasks"]
    assert len(grown) == 6 and json.loads(grown[-1]["arguments"]) == {"gesture": "bow", "repeat": 1}


def test_labels(spark):
    rows = [("往前走三步", "HumanAction", {"action": "walk", "parameters": {"x": 0.6, "y": 0, "yaw": 0, "step": 3}}),
            ("左转一下", "HumanAction", {"action": "walk", "parameters": {"x": 0, "y": 0, "yaw": 1, "degree": 15, "step": 1}}),
            ("向右转九十度", "HumanAction", {"action": "walk", "parameters": {"x": 0, "y": 0, "yaw": -1, "degree": 90, "step": 1}}),
            ("坐下再站起来", "HumanAction", None), ("左右走", "HumanAction", None), ("躺下", "HumanAction", {"action": "lie_down"}),
            ("谢幕鞠个躬", "RobotGesture", {"gesture": "curtain_bow"}), ("左手比个心", "RobotGesture", {"gesture": "left_hand_side_heart"}),
            ("鼓掌再点头", "RobotGesture", None), ("北京明天天气", "get_weather", {"city": "北京", "query_type": "24h"}),
            ("北京和上海天气", "get_weather", None), ("现在几号", "robot_status", {"query": "日期"})]
    df = spark.createDataFrame([r[:2] for r in rows], "query string, expected_function string")
    got = {r["query"]: r["derived"] for r in labels.derive_labels(df, cities=["北京", "上海"]).collect()}
    for text, _, want in rows:
        assert (json.loads(got[text]) if got[text] else None) == want, text


def test_reports_null_rates_and_paired(spark):
    base = {"record_id": "a", "strict_pass": True, "valid_json": True, "contract_valid": True, "task_count_match": True,
            "ordered_kind_name_match": True, "parameter_match": None, "forbidden_tool_violation": False, "latency_ms": 10.0,
            "prompt_tokens": 1, "output_tokens": 2, "reason": "passed", "case_id": "1", "variant": "x"}
    rows = [base, base | {"strict_pass": False, "reason": "invalid_json", "variant": "y", "latency_ms": 20.0}]
    schema = ("record_id string, strict_pass boolean, valid_json boolean, contract_valid boolean, task_count_match boolean, ordered_kind_name_match boolean,"
              "parameter_match boolean, forbidden_tool_violation boolean, latency_ms double, prompt_tokens int, output_tokens int, reason string, case_id string, variant string")
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.replace(",", ", ").split(",")) for r in rows], schema)
    m = reports.metrics(df).collect()[0]
    assert m["parameter_accuracy"] is None and m["parameter_accuracy_denominator"] == 0 and m["strict_sequence_accuracy"] == 0.5
    assert m["failure_reasons"] == {"invalid_json": 1} and m["latency_p50"] == 20.0 and m["output_tokens_per_second"] == pytest.approx(4 / 0.03)
    p = reports.paired(df, "x", "y")
    row = p.collect()[0]
    assert (row["paired_count"], row["left_only_pass"], row["accuracy_delta"]) == (1, 1, 1.0)
    ci = reports.bootstrap_ci(p, 200, 1).collect()[0]
    assert (ci["ci_low"], ci["ci_high"]) == (1.0, 1.0)
    nobody = reports.paired(df, "x", "z").collect()[0]
    assert nobody["paired_count"] == 0 and nobody["left_accuracy"] is None


def test_bootstrap_matches_direct_resampling(spark):
    import random

    counts = spark.createDataFrame([(60, 18, 9, 9 / 60)], "paired_count long, left_only_pass long, right_only_pass long, accuracy_delta double")
    ci = reports.bootstrap_ci(counts, 2000, 3).collect()[0]
    rng, diffs = random.Random(0), [1] * 18 + [-1] * 9 + [0] * 33
    means = sorted(sum(rng.choices(diffs, k=60)) / 60 for _ in range(2000))
    assert ci["ci_low"] == pytest.approx(means[50], abs=0.035) and ci["ci_high"] == pytest.approx(means[1950], abs=0.035)


def test_mcnemar(spark):
    from math import comb

    pairs = [(0, 0), (1, 5), (10, 3), (40, 60), (200, 150)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", reports.mcnemar_p(F.col("a"), F.col("b")).alias("p"))
    for r in df.collect():
        n, k = r["a"] + r["b"], min(r["a"], r["b"])
        want = min(1.0, 2 * sum(comb(n, i) for i in range(k + 1)) / 2**n) if n else 1.0
        assert r["p"] == pytest.approx(want, rel=1e-6)


def test_text_metrics(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on a mat"), (2, "", "x"), (3, "abc", "abc"), (4, "zzz", "abc")],
                               "k long, predict string, label string")
    rows = {r["k"]: r for r in textmetrics.text_scores(df, "k").collect()}
    assert rows[3]["rouge_1"] == pytest.approx(100, abs=1e-3) and rows[2]["rouge_l"] == 0 and rows[2]["bleu_4"] == 0 and rows[4]["bleu_4"] == 0
    assert rows[1]["rouge_l"] == pytest.approx(2 * (5 / 6) * (5 / 6) / (10 / 6) * 100, abs=1e-3)
    assert rows[3]["bleu_4"] == pytest.approx(100 * (1 / 2) ** 0.25, abs=1e-3)  # three characters: the 4-gram precision is smoothed


def test_composition_constraints(spark, sf):
    atoms = adapters.atoms(spark, sf)
    cases = compose.compose_cases(atoms, 3, 60, 1).collect()
    assert len(cases) == 60 and len({tuple(c["ids"]) for c in cases}) == 60
    assert all(len(set(c["topics"])) == 3 and len(set(c["flips"])) == len(c["flips"]) for c in cases)
    topic = {str(r["id"]): (r["topic"], r["value"]) for r in atoms.collect()}
    for r in compose.sample_pairs(atoms, 50, 2).collect():
        assert topic[str(r["a"])][0] != topic[str(r["b"])][0] and topic[str(r["a"])][1] != topic[str(r["b"])][1]


def test_cases_are_refilled(spark):
    """Small pools: n cases wherever 20 n tries find them, else a stated shortfall; none repeats, topic or flip."""
    def atoms(n):
        return spark.createDataFrame([(i, "positive", f"c{i % 3}", f"t{i}", None) for i in range(n)], "id long, part string, cell string, topic string, flip string")

    six = compose.case_pool(atoms(6))
    for want, found in ((28, 28), (45, 30)):  # 6 * 5 ordered pairs
        rows = compose.compose_cases(six, 2, want, 1, 0.0).collect()
        assert len(rows) == found == len({tuple(r.ids) for r in rows}) and {r.missing for r in rows} == {want - found}
        assert all(len(set(r.topics)) == 2 for r in rows)
    rows = compose.compose_cases(atoms(40), 2, 1100, 1, 0.0).collect()
    assert len(rows) == 1100 == len({tuple(r.ids) for r in rows}) and {r.missing for r in rows} == {0}
    assert [r.case_no for r in rows] != sorted(range(1100)) and compose.compose_cases(six, 7, 3, 1, 0.0).collect() == []


def test_variants_revalidate(spark, sf):
    from parlance.showcase.composing import tool_rows

    rows = compose.augment(tool_rows(spark, sf), {"masked": 1.0, "drop_used": 1.0, "drop_unused": 1.0}, 3)
    for r in rows.limit(200).collect():
        assert r["valid"] and len(r["tools"]) >= 1
        schemas = {t["name"]: json.loads(t["arguments_schema"]) for t in r["tools"]}
        for t in r["tasks"]:
            assert t["kind"] == "reply" or schema_error(json.loads(t["arguments"]), schemas[t["name"]]) is None


def test_consensus_merges_replies(spark):
    s = "labels array<struct<tool string,params string>>, verdicts array<array<struct<tool string,params string>>>"
    walks = ("HumanAction", '{"action":"walk","parameters":{"x":0.6,"step":2}}')
    rows = [([("reply", None), ("reply", None), walks], [[("reply", None), ("HumanAction", '{"action":"walk","x":1,"step":2}')]]),
            ([walks], [[("HumanAction", '{"action":"walk","x":-1,"step":2}')]]), ([walks], [[("reply", None), walks]])]
    assert [r["disputed"] for r in screening.consensus(spark.createDataFrame(rows, s)).collect()] == [False, True, True]


def test_numerals_and_unicode_spaces(spark):
    from pyspark.sql import functions as F

    from parlance.functions.text import words
    from parlance.plans.labels import chinese_number

    cases = {"12": 12, "三": 3, "两": 2, "十": 10, "十二": 12, "三十": 30, "三十五": 35, "三五": None, "一二": 1, "一百二十": None, "": None,
             "两十": None, "零十": None}
    frame = spark.createDataFrame([(k,) for k in cases], "t string").select("t", chinese_number(F.col("t")).alias("n"))
    assert {r.t: r.n for r in frame.collect()} == cases
    got = spark.createDataFrame([("a b　c d",)], "t string").select(words(F.col("t"))).first()[0]
    assert got == ["a", "b", "c", "d"]


def test_masking_rebuilds_the_schema():
    import json

    from parlance.plans.openjson import _fresh, _grown, _leaves, _masked_schema

    schema = {"type": "object", "properties": {"a": {"type": "string", "description": "a of b"}, "b": {"items": [{"properties": {"a": {}}}]}},
              "required": ["a", "b"], "x": [], "enum": ["a"]}
    assert _grown(_leaves(schema)) == schema and _grown(_leaves([])) == [] and _grown(_leaves([1, [2, {"k": None}]])) == [1, [2, {"k": None}]]
    got = _masked_schema(_leaves(schema), {"a": "p", "b": "q"})
    assert json.dumps(got) == json.dumps({
        "type": "object", "properties": {"p": {"type": "string", "description": "p of q"}, "q": {"items": [{"properties": {"p": {}}}]}},
        "required": ["p", "q"], "x": [], "enum": ["a"]})
    taken: set = set()
    assert len({_fresh("s", "n", taken) for _ in range(5)}) == 5


def test_align_slots(spark):
    """Every allowed assignment by hand: most matches, then earliest slots."""
    import itertools
    import random

    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = []
    for k in range(300):
        slots = [rng.choice(["", "a", "b"]) for _ in range(rng.randrange(5))]
        calls = [rng.choice("abc") for _ in range(rng.randrange(4))]
        rows.append((k, slots, calls, [[rng.random() < 0.5 for _ in calls] for _ in slots], rng.choice([[], ["c"], ["a", "x"]])))

    def plain(slots, calls, match, blocked):
        found = []
        for places in itertools.combinations(range(len(slots)), len(calls)):
            picks = [-1] * len(slots)
            for j, i in enumerate(places):
                picks[i] = j
            if all(
                (j >= 0 and s == calls[j]) if s else j < 0 or (blocked and calls[j] not in blocked) for s, j in zip(slots, picks)
            ):
                found.append((sum(match[i][j] for i, (s, j) in enumerate(zip(slots, picks)) if s), [j >= 0 for j in picks], picks))
        return max(found)[2] if found else None

    df = spark.createDataFrame(rows, "k int, s array<string>, c array<string>, m array<array<boolean>>, b array<string>")
    got = {r.k: r.x for r in df.select("k", scoring.align_slots(F.col("s"), F.col("c"), F.col("m"), F.col("b")).alias("x")).collect()}
    assert got == {k: plain(*rest) for k, *rest in rows} and sum(x is not None for x in got.values()) > 40
