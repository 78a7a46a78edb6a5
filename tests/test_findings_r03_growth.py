"""Cases of the third round's findings on time that grows."""

import random
from collections import Counter

import pytest

from parlance.operators import profiles


@pytest.mark.parametrize("letters, n", [("ab\U0001F600", 4), ("".join(map(chr, range(0x6A00, 0x9000))), 4), ("abc", 1), ("abcdefgh", 2)])
def test_top_grams_by_characters(spark, monkeypatch, letters, n):
    """Windows are counted as by a plain loop, null pools too, and do not become rows before they are counted."""
    monkeypatch.setattr(profiles, "HELD_GRAMS", 64)
    rng = random.Random(4)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(150)] + ["", None]
    rows = [(rng.choice(["x", "y", None]), t) for t in texts]
    want = Counter()
    for group, text in rows:
        want.update({(group, text[i:i + n]) for i in range(len(text) - n + 1)} if text else ())
    df = spark.createDataFrame(rows, "pool string, text string").repartition(3)
    top = profiles.top_grams(df, "pool", "text", n, 10**6)
    assert "Generate" not in top._jdf.queryExecution().executedPlan().toString()
    got = [(r.pool, r.gram, r.rows) for r in top.collect()]
    assert {(p, g): k for p, g, k in got} == want and len(got) == len(want)


def test_masked_tools_are_those_of_a_plain_loop(spark):
    """Names, schemas, descriptions and arguments as when each row parses its tools anew; each is parsed once now."""
    import hashlib
    import json

    from parlance.plans import compose, openjson

    schemas = [
        '{"type":"object","required":["a","b c"],"properties":{"a":{"description":"a é of a"},"b c":{"properties":{"a":{},"x":{"enum":["a"]}}}}}',
        '{"properties":{"q":{"items":[{"properties":{"q":{}}}]}},"x":[]}', "{}", None,
    ]
    described = ["calls a, then q", "", None, "nothing"]
    # the third row offers one name twice
    offers = [[("one", 0), ("two", 1)], [("two", 0)], [("one", 2), ("one", 3)], []]
    tools = [[(n, "action", described[i], schemas[i]) for n, i in o] for o in offers]
    tasks = [
        [("action", "do", "one", '{"a": [1, {"b c": {"a": "é"}}], "q": null}'), ("reply", "say", None, None)],
        [("action", "do", "two", '{"a":{}}'), ("action", "do", "two", '{"a":{}}')], [], [("reply", "say", None, None)],
    ]
    kind = "example_id string, instruction string, tools array<struct<name:string,kind:string,description:string,arguments_schema:string>>, " \
        "tasks array<struct<kind:string,instruction:string,name:string,arguments:string>>"
    rows = [(str(i), "go", tools[i % 4], tasks[i % 4]) for i in range(24) if i % 4 != 2]
    got = {r.example_id: r for r in compose.mask_names(spark.createDataFrame(rows, kind).coalesce(2), 7).collect()}
    assert len(got) == len(rows)
    for key, _, offered, wanted in rows:
        seed, taken, new, renames = hashlib.md5(f"7:{key}".encode()).hexdigest(), set(), [], {}
        for name, action, description, schema in offered:
            leaves, own = openjson._leaves(json.loads(schema or "{}")), set()
            names = {n: openjson._fresh(f"{seed}:{name}", n, own) for n in dict.fromkeys(p[i] for p, _ in leaves for i in openjson._names_at(p))}
            masked = json.dumps(openjson._masked_schema(leaves, names), ensure_ascii=False)
            new.append((openjson._fresh(seed, name, taken), action, openjson._in_text(description or "", names), masked))
            renames[name] = new[-1][0], names
        assert [tuple(t) for t in got[key].tools] == new
        for task, old in zip(got[key].tasks, wanted, strict=True):
            if old[0] == "reply":
                assert tuple(task) == old
                continue
            name, names = renames[old[2]]
            leaves = [(tuple(names.get(x, x) for x in path), v) for path, v in openjson._leaves(json.loads(old[3]))]
            assert tuple(task) == (old[0], old[1], name, json.dumps(openjson._grown(leaves), ensure_ascii=False))
    openjson._tool_form.cache_clear()
    forms = [openjson._tool_form(described[0], schemas[0]) for _ in range(3)]
    assert forms[0][0] == ["a", "b c", "x"] and openjson._tool_form.cache_info().misses == 1


def test_hashed_names_have_not_changed():
    from parlance.plans.openjson import hashed_name

    assert [hashed_name(s, n) for s, n in (("s", "n"), ("3:7", "web_search"))] == ["zMOGyB", "PzdpEXxshbx"]
