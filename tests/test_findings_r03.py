"""Cases of the third round's findings."""

import hashlib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parlance import adapters
from parlance.functions.hashing import smallest_md5
from parlance.operators import encode
from parlance.plans import compose, textmetrics


def test_smallest_md5_equals_hashlib():
    draw = random.Random(3)
    tails = [str(i).encode() for i in range(400)] + [b""]
    heads = [b"0:train:%d:" % draw.randrange(10 ** draw.randrange(1, 9)) for _ in range(300)] + [b"x" * 70, b""]
    own = [draw.choice([*tails, b"none", None]) for _ in heads]
    for n in (0, 1, 2, 7):
        want = [
            [j for _, j in sorted((hashlib.md5(h + t).digest(), j) for j, t in enumerate(tails) if t != o)[:n]] for h, o in zip(heads, own)
        ]
        assert smallest_md5(heads, tails, n, own) == want


def test_slot_variants_of_several_blocks(spark, monkeypatch):
    """Picks in blocks equal the smallest hashes."""
    monkeypatch.setattr(compose, "VARIANT_ROWS", 20)
    atoms = spark.range(100).select(
        "id", F.concat(F.lit("go "), F.col("id") % 7, F.lit(" on")).alias("query"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("slot"),
        (F.col("id") % 7).cast("string").alias("value"),
    )
    values = spark.createDataFrame([("a", "train", str(i)) for i in range(30)] + [("b", "train", "x"), ("b", "test", "y"), ("c", "train", "z")],
                                   "slot string, part string, surface string")
    rows = compose.slot_variants(atoms, values, "train", 3, 5)
    assert rows.columns == ["slot", "id", "query", "value", "new_text", "new_value", "part"]
    got = {}
    for r in rows.collect():
        got.setdefault(r.id, set()).add(r.new_text)
    for i in range(100):
        listed = [str(j) for j in range(30)] if i % 2 == 0 else ["x"]
        rest = sorted((hashlib.md5(f"5:train:{i}:{v}".encode()).hexdigest(), v) for v in listed if v != str(i % 7))[:3]
        assert got[i] == {f"go {v} on" for _, v in rest}


CONVERSATIONS = [
    # reversed quotes that are found in order all the same
    (1, 1, "user", "say it again please"), (1, 2, "assistant", "say it again and say it again"),
    (3, 1, "user", "one thing here"), (3, 2, "assistant", "other matter, one thing here too"),
    # out of order, with ties of turn and of place
    (5, 1, "user", "first of them all"), (5, 2, "assistant", "second of them"), (5, 2, "assistant", "a second of them"), (5, 3, "user", "FIRST OF THEM"),
    # quotes of blanks or of nothing, edge blanks of other kinds
    (7, 1, "user", "            later"), (7, 2, "assistant", "words then"), (9, 1, "user", None), (9, 2, "assistant", "words then"), (11, 1, "user", None),
    (13, 1, "user", "\u00a0wide \u2009"), (13, 2, "assistant", " plain one\u00a0"), (2, 1, "user", ""), (2, 2, "assistant", "x"), (4, 2, "user", "b"), (4, 1, "user", "a b"),
]


def compared(spark, folder, name):
    """Rows of a query and of its SQL."""
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for path in folder.iterdir():
        files = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    got = sorted(map(tuple, entry.queries()[name](spark, str(folder)).collect()), key=repr)
    return got, sorted(con.execute(entry.oracle_sql()[name]).fetchall(), key=repr)


@pytest.mark.parametrize("name", ["quote_order", "reordered_labels"])
def test_quotes_and_their_sql(spark, tmp_path, name):
    rows = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn int, role string, text string")
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = compared(spark, tmp_path, name)
    assert got == want
    if name == "quote_order":
        assert dict(got)[3] is None and dict(got)[5] == "order" and dict(got)[7] == "quote not found"


@pytest.mark.parametrize("rows", [CONVERSATIONS, []])
def test_streams_read_folders_of_parts(spark, tmp_path, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    table.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = compared(spark, tmp_path, "stream_alignment")
    assert got == want and len(got) == len([r for r in rows if r[2] == "assistant" and r[3]])


def test_scores_of_long_and_odd_texts(spark):
    """Equal to counting by hand; the work on a long text is in proportion to it."""
    long = " ".join(f"w{i % 40000}" for i in range(60000))
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 20000))) + "".join(map(chr, range(0x20000, 0x20000 + 20000)))
    pairs = [("a b a b", "a b c"), ("", "x"), ("ab", ""), (None, "x"), ("aaaa", "aa"), ("日本語 テキスト", "日本 テキスト 語"), (wide, wide[:5000] + wide[3:50]),
             ("𝒳y𝒳y", "y𝒳"), (long, long[1000:])]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "k int, predict string, label string")
    start = time.time()
    got = {r.k: r for r in textmetrics.rouge_scores(df, "k", lcs=False, bleu=True).collect()}
    assert time.time() - start < 25
    one = {r.k: r.bleu_4 for r in textmetrics.bleu4(df, "k").collect()}
    hits = {r.k: r.g for r in df.select("k", textmetrics.gram_hits("predict", "label").alias("g")).collect()}
    for k, (p, l) in enumerate(pairs):
        p, l = p or "", l or ""
        want = []
        for n in range(1, 5):
            a, b = (Counter(t[i:i + n] for i in range(len(t) - n + 1)) for t in (p, l))
            want += [(a & b).total(), a.total()]
        assert hits[k] == want and got[k].bleu_4 == one[k]
        for n in (1, 2):
            a, b = (set(zip(*[t.split()[i:] for i in range(n)])) for t in (p, l))
            x, y = len(a & b) / max(len(a), 1), len(a & b) / max(len(b), 1)
            assert got[k][f"rouge_{n}"] == pytest.approx(200 * x * y / (x + y + 1e-8), abs=1e-4)


def test_vocabulary_of_a_long_text(spark):
    """Every token is looked up at once; unknown ones, and rows without a known token, get the unknown id."""
    tokens = [f"t{i}" for i in range(100_000)]
    docs = spark.createDataFrame([(1, tokens), (2, ["x", "t7", "t7"]), (3, ["y"]), (4, []), (5, None)], "k int, tokens array<string>")
    vocabulary = spark.range(100_000).select(F.concat(F.lit("t"), "id").alias("token"), (F.col("id") + 1).alias("id"))
    start = time.time()
    got = {r.k: r.input_ids for r in encode.vocab_ids(docs, vocabulary, "k", unknown=-1).collect()}
    assert time.time() - start < 15
    assert got == {1: list(range(1, 100_001)), 2: [-1, 8, 8], 3: [-1], 4: [], 5: None}


@pytest.mark.parametrize("few", [1, 2])
def test_cases_do_not_depend_on_the_picks_drawn_first(spark, sf, monkeypatch, few):
    """Tries that few picks fill are as all picks fill them; the others are drawn again with all."""
    pool = compose.case_pool(adapters.atoms(spark, sf), 1)
    cases = lambda: sorted(map(tuple, compose.compose_cases(pool, 3, 40, 1, 0.6).collect()))
    monkeypatch.setattr(compose, "FEW_PICKS", 20)
    want = cases()
    monkeypatch.setattr(compose, "FEW_PICKS", few)
    assert cases() == want and len(want) == 40
