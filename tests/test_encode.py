import pytest
from pyspark.sql import functions as F

from parlance.operators import encode, pack, profiles, render

TRIPLES = [(3000, 2000, 600, 400), (2000, 3000, 400, 600), (1000, 100, 900, 100), (100, 1000, 100, 900), (100, 500, 100, 500),
           (500, 100, 500, 100), (10, 10, 10, 10)]


def test_length_rule(spark):
    df = spark.createDataFrame([t[:2] for t in TRIPLES], "s int, t int")
    got = [(r["s"], r["t"], r["source_len"], r["target_len"]) for r in encode.infer_seqlen(df, "s", "t", 1000).collect()]
    assert got == TRIPLES


def model_sft(pairs, cutoff, mask_history):
    """Plain model of the turn budget."""
    ids, labels, used = [], [], 0
    order = list(reversed(pairs)) if mask_history else pairs
    for i, (s, t) in enumerate(order):
        if used >= cutoff:
            break
        c = cutoff - used
        most = c if len(t) * 2 < c else c - len(s) if len(s) * 2 < c else int(c * (len(t) / (len(s) + len(t))))
        kt = min(most, len(t))
        ks = min(max(c - kt, 0), len(s))
        used += ks + kt
        lab = [-100] * ks + ([-100] * kt if mask_history and i else t[:kt])
        ids, labels = (s[:ks] + t[:kt] + ids, lab + labels) if mask_history else (ids + s[:ks] + t[:kt], labels + lab)
    return ids, labels


@pytest.mark.parametrize("mask", [False, True])
@pytest.mark.parametrize("cutoff", [5, 9, 14, 100])
def test_sft_budget(spark, mask, cutoff):
    pairs = [([1, 2, 3, 4], [5, 6, 7]), ([8, 9], [10, 11, 12, 13, 14]), ([15], [16])]
    df = spark.createDataFrame([(pairs,)], "pairs array<struct<source array<int>, target array<int>>>")
    row = encode.encode_sft(df, cutoff, mask_history=mask).collect()[0]
    assert (row["input_ids"], row["labels"]) == model_sft(pairs, cutoff, mask)


def test_packs_take_the_largest_fit_and_the_latest_row():
    placed = pack.plan_packs([3, 5, 5, 2, 4], 9)
    packs = {}
    for row, (p, slot) in enumerate(placed):
        packs.setdefault(p, []).append((slot, row))
    assert [[r for _, r in sorted(v)] for _, v in sorted(packs.items())] == [[2, 4], [1, 0], [3]]


def test_pack_and_assemble(spark):
    rows = [(i, [i] * n) for i, n in enumerate([3, 5, 5, 2, 4, 20])]
    df = spark.createDataFrame(rows, "k long, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    packed = pack.pack(pack.with_batches(df, "k"), 9, "k")
    assert packed.count() == 5  # the over-long row is dropped
    out = {r["pack_id"]: r for r in pack.assemble_packs(packed, 9, neat=True).collect()}
    assert all(len(r["input_ids"]) == 10 == len(r["attention_mask"]) for r in out.values())
    assert out[0]["attention_mask"] == [1] * 5 + [2] * 4 + [0]
    assert out[0]["position_ids"] == [0, 1, 2, 3, 4, 0, 1, 2, 3, 0] and out[0]["sequence_boundaries"] == [0, 5, 9, 10]
    assert out[0]["labels"][-1] == -100
    flat = {r["pack_id"]: r for r in pack.assemble_packs(packed, 9).collect()}
    assert flat[0]["attention_mask"] == [1] * 10


def test_chunks_cut_rows_at_block_borders(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5]), (2, []), (3, [6, 7, 8, 9])], "k long, input_ids array<int>")
    out = pack.chunk_pt(pack.with_batches(df, "k"), 4, bos_id=0)
    assert [r["input_ids"] for r in out.orderBy("block").collect()] == [[0, 2, 3, 4], [0, 6, 7, 8]]


def test_kto_takes_the_previous_answer(spark):
    df = spark.createDataFrame([(0, [1], [10]), (1, [2], [20]), (2, [3], [30])], "k long, prompt_ids array<int>, response_ids array<int>")
    out = encode.encode_kto(pack.with_batches(df, "k"), 10).orderBy("k").collect()
    assert [r["kl_input_ids"] for r in out] == [[1, 30], [2, 10], [3, 20]]


def test_prefix_labels_and_pairs(spark):
    df = spark.createDataFrame([([1, 2], [1, 2, 3], 0.5), ([9], [1, 2], 1.0)], "prompt_ids array<int>, full_ids array<int>, loss_weight double")
    good, bad = encode.label_by_prefix(df).collect()
    assert good["labels"] == [-100, -100, 3] and good["loss_weights"] == [0, 0, 0.5] and not good["prefix_error"] and bad["prefix_error"]


def test_calls_round_trip(spark):
    text = 'Action: f_x\nAction Input: {"a": [1, 2], "b": "x, y: z"}\nAction: g\nAction Input: {"c": 1}'
    df = spark.createDataFrame([(text,), ("no call",), ("Action: f\nAction Input: {bad",)], "content string")
    rows = render.extract_calls(df).collect()
    assert [c["name"] for c in rows[0]["calls"]] == ["f_x", "g"]
    assert rows[0]["calls"][0]["arguments"] == '{"a": [1, 2], "b": "x, y: z"}' and rows[1]["calls"] is None and rows[2]["calls"] is None
    back = spark.createDataFrame([('[{"name": "f_x", "arguments": {"a": [1, 2], "b": "x, y: z"}}, {"name": "g", "arguments": {"c": 1}}]',)], "content string")
    assert render.render_calls(back).collect()[0]["call_text"] == text
    tagged = render.render_calls(back, layout="tagged", out="content")
    assert [c["name"] for c in render.extract_calls(tagged, layout="tagged").collect()[0]["calls"]] == ["f_x", "g"]


def test_ema_and_cap(spark):
    import math

    values = [5.0, 3.0, 4.0, 1.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], "run string, i int, v double")
    w = 1.8 * (1 / (1 + math.exp(-0.05 * 4)) - 0.5)
    last, want = values[0], []
    for v in values:
        last = last * w + (1 - w) * v
        want.append(last)
    got = [r["smoothed"] for r in profiles.ema(df, "run", "i", "v").orderBy("i").collect()]
    assert got == pytest.approx(want)
    old, profiles.EMA_CHUNK = profiles.EMA_CHUNK, 3  # chunk borders inside the series
    try:
        cut = [r["smoothed"] for r in profiles.ema(df, "run", "i", "v").orderBy("i").collect()]
    finally:
        profiles.EMA_CHUNK = old
    assert cut == pytest.approx(want)
