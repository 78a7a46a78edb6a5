"""Rules that depend on all earlier decisions, against plain loops, for few and many ranges."""

import random
from collections import Counter

import pytest

from parlance.operators.ordered import cap_openers
from parlance.operators.pack import dynamic_batches, token_batches


def plain_caps(texts, cap, floor=50):
    counts, out = Counter(), []
    for t in texts:
        total, o = sum(counts.values()), t[:2]
        full = cap > 0 and total >= floor and counts[o] >= cap * total
        out.append(not full)
        counts[o] += not full
    return out


def pool(kind, n=700):
    rng = random.Random(kind)
    if kind == "first":  # one opener holds the first 50 rows
        return ["aa x"] * 50 + [f"{rng.choice(['aa', 'bb', 'cc', 'dd', 'ee', 'ff', 'gg'])} y" for _ in range(n - 50)]
    if kind == "late":  # a rare opener turns hot, another ends
        return [f"{'aa' if i < 300 else 'bb'} z" if rng.random() < 0.5 else f"{rng.choice('cdefgh')}x z" for i in range(n)]
    return [f"{chr(97 + int(9 * rng.random() ** 2))}q w" for _ in range(n)]


@pytest.mark.parametrize("kind, ranges", [("first", 1), ("first", 7), ("first", 100), ("late", 7), ("mixed", 7)])
def test_opener_caps(spark, kind, ranges):
    texts = pool(kind)
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    random.Random(1).shuffle(rows)
    rounds = []
    df = spark.createDataFrame(rows, "k long, q string").repartition(5)
    got = cap_openers(df, "k", "q", 0.2, range_rows=-(-len(texts) // ranges), rounds=rounds)
    assert [r.accepted for r in got.orderBy("k").collect()] == plain_caps(texts, 0.2)
    assert len(rounds) <= ranges + 1 and rounds[0] <= ranges


def test_opener_caps_of_few_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  ，ab")], "k long, q string")
    assert [r.accepted for r in cap_openers(df, "k", "q", 0.01, floor=1).orderBy("k").collect()] == plain_caps(["", "", "ab"], 0.01, 1)
    assert cap_openers(df.limit(0), "k", "q", 0.1).collect() == []
    assert all(r.accepted for r in cap_openers(df, "k", "q", 0.0).collect())


def plain_batches(lengths, budget, padded):
    out, first, batch = [], 0, 0
    while first < len(lengths):
        used, full = 0, False
        while first + used < len(lengths):
            window = lengths[first:first + used + 1]
            if used and (max(window) * len(window) if padded else sum(window)) > budget:
                full = True
                break
            used += 1
            if padded and max(window) * len(window) >= budget:
                full = True
                break
        out += [(batch, full)] * used
        first, batch = first + used, batch + 1
    return out


@pytest.mark.parametrize("padded", [True, False])
@pytest.mark.parametrize("rows, least", [(40, 1), (7, 1), (1000, 0), (40, 0)])
def test_budget_batches(spark, padded, rows, least):
    rng = random.Random(rows)
    lengths = [rng.choice((least, 1, 3, 9, 30)) if i % 90 > 20 else least for i in range(600)]
    df = spark.createDataFrame([(7 * i, [0] * n) for i, n in enumerate(lengths)], "k long, input_ids array<int>").repartition(4)
    got = (dynamic_batches if padded else token_batches)(df, 24, 2, "k", range_rows=rows).orderBy("k").collect()
    want = plain_batches([min(n, 24) for n in lengths], 48, padded)
    assert [(r.micro_batch, r.complete) for r in got] == want
    assert len({b for b, full in want if not full}) <= 1


def test_no_batches(spark):
    assert dynamic_batches(spark.createDataFrame([], "k long, input_ids array<int>"), 8, 1, "k").collect() == []
