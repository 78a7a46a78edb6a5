"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import types as T

from parlance.llm import embeddings, exactdup, extraction, linedup, mixing, packing, simhash, tokencount, toxicity, warc
from parlance.llm.components import components
from parlance.llm.queries import QUERIES


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def roots_of(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(5, None), (3, 3)]
    got = dict(rows_of(components(spark.createDataFrame(pairs, "u long, v long"))))
    real = [(a, b) for a, b in pairs if b is not None and a != b]
    want = roots_of({x for p in real for x in p}, real)
    assert got == want
    assert rows_of(components(spark.createDataFrame([], "u long, v long"))) == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs_of, odd_rows):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = list(odd_rows)
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(300)] = f"x{rng.randrange(9)}"
        rows.append((100 + i, " ".join(words), "n"))
    rows += [(300 + i, " ".join(f"q{rng.randrange(5000)}" for _ in range(40)), "n") for i in range(60)]
    got = rows_of(simhash.near_duplicates(docs_of(rows)))
    assert sorted((d is None, d or 0, h) for d, h, _ in got) == sorted(
        (d is None, d or 0, f"{plain_fingerprint(t):016x}") for d, t, _ in rows
    )
    prints = sorted({int(h, 16) for _, h, _ in got})
    near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if (a ^ b).bit_count() <= 4]
    roots = roots_of(prints, near)
    least = {}
    for d, h, _ in got:
        if d is not None:
            least[roots[int(h, 16)]] = min(d, least.get(roots[int(h, 16)], d))
    assert all(c == least.get(roots[int(h, 16)]) for d, h, c in got)
    assert rows_of(simhash.near_duplicates(docs_of([]))) == []


def test_bk_forest_with_split_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 16)
    rng = random.Random(3)
    values = list({(1 << 40) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(200)})
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    got = components(simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")))
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    want = roots_of(values, near)
    assert dict(rows_of(got)) == {n: r for n, r in want.items() if Counter(want.values())[r] > 1}


def test_toxicity(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100, 400)] + [(None, 1), (100, None)], "doc_id long, toxic int")
    rows = odd_rows + [(i, "calm words here. " + ("what an idiot! " if i % 3 == 0 else ""), "s") for i in range(100, 400)]
    got = rows_of(toxicity.scores(docs_of(rows), labels))
    assert len(got) == len(rows)
    for doc, held, score, predicted, clauses in got:
        assert held == (doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == (score >= 0.5)
        if doc is not None and doc >= 100:
            assert predicted == (doc % 3 == 0)
    assert rows_of(toxicity.scores(docs_of([]), labels)) == []
    assert len(rows_of(toxicity.scores(docs_of(rows), labels.limit(0)))) == len(rows)


def test_toxicity_learns_beginnings(spark, docs_of):
    rng = random.Random(8)
    plain = [a + b for a in ("mora", "tile", "vano", "peku") for b in ("", "s", "ti", "ron")]
    rows, marks = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(40)] = "grux" + rng.choice(("", "a", "en", "ilo"))
        rows.append((i, " ".join(words), "s"))
        marks.append((i, int(i % 4 == 0)))
    got = rows_of(toxicity.scores(docs_of(rows), spark.createDataFrame(marks, "doc_id long, toxic int")))
    assert all(predicted == (doc % 4 == 0) for doc, _, _, predicted, _ in got)
    sample = spark.createDataFrame([("grux words", 1)] * 50 + [(None, 1), ("", 0)], "text string, _label int")
    assert toxicity.learned_terms(sample) == []
    matcher = toxicity.Matcher(["grux"])
    assert matcher.counts("gruxen, a grux. not grux! he said gruxa; xgrux")[toxicity.KINDS.index("learned")] == 2
    assert toxicity.Matcher().counts("calm " * 2000 + "you. " + "calm " * 2000 + "idiot")[0] == 1


@pytest.mark.parametrize(("text", "kinds"), [
    ("You are an idiot.", {"aimed": 1}), ("An idiot, they say.", {"bare": 1}), ("idiot like you", {"bare": 0, "aimed": 1}),
    ("you are not an idiot", {"negated": 1}), ("he said you are scum", {"reported": 1}), ("I will kill you", {"threat": 1}),
    ("we kill time", {}), ("idiotic, scumbag", {}),
])
def test_grammar(text, kinds):
    got = dict(zip(toxicity.KINDS, toxicity.Matcher().counts(text)))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in kinds.items() if v}


def odd_texts(seed, n):
    rng = random.Random(seed)
    letters = list("ab c  \n\t'sdltre1²½é́ßİΣς   　漢字🙂\x1c\x1f\x85​.,!-A") + ["<|endoftext|>", "'ll", "idiot"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(16))) for _ in range(n)]


def test_token_counts(docs_of, odd_rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = odd_rows + [(100 + i, t, "s") for i, t in enumerate(odd_texts(4, 500))]
    got = rows_of(tokencount.token_counts(docs_of(rows), path, public_tokenizers.PATTERN))
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 512) for d, t, _ in rows]
    assert Counter(got) == Counter(want)
    assert rows_of(tokencount.token_counts(docs_of([]), path, public_tokenizers.PATTERN)) == []


def test_packing(docs_of, odd_rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(5)
    rows = odd_rows + [(100 + i, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(900))), "s") for i in range(200)]
    rows += [(1000 + i, t, "s") for i, t in enumerate(odd_texts(6, 300))]
    got = rows_of(packing.pack(docs_of(rows), path))
    want = []
    for d, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], dtype="<u4")
            want.append((d, n, at, len(part), zlib.crc32(part.tobytes())))
    assert Counter(r[:5] for r in got) == Counter(want)
    sequences = {}
    for *_, length, _, sequence, offset in got:
        sequences.setdefault(sequence, []).append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.02 * sum(r[3] for r in got) / 2048 + 2
    assert rows_of(packing.pack(docs_of([]), path)) == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length(seed):
    rng = random.Random(seed)
    wanted = Counter(min(64, int(rng.expovariate(1 / 20)) + 1) for _ in range(rng.randrange(1, 3000)))
    got = Counter()
    for repeats, lengths in packing.plan(dict(wanted), 64, bins=16):
        assert sum(lengths) <= 64
        for n in lengths:
            got[n] += repeats
    assert got == wanted


def near_rows(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)))]
    for i in range(120):
        base = np.array(rows[i % 12][1])
        rows.append((1000 + i, (base + rng.standard_normal(16) * np.linalg.norm(base) * 0.06).tolist()))
    rows += [(2000 + i, rows[5][1]) for i in range(5)] + [(2004, rows[5][1]), (3000, [2 * x for x in rows[5][1]])]
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] * 16), (4003, [1.0, None]), (4004, [float("inf"), 1.0]),
             (4005, []), (4006, [1.0, 2.0]), (4007, [1.0, 2.0]), (None, rows[7][1])]
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("cid", T.StringType())])
    rows = near_rows(7)
    got = rows_of(embeddings.near_vectors(spark.createDataFrame([(*r, "c") for r in rows], schema)))
    assert len(got) == len(rows)
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for n, i in enumerate(good):
        for j in good[n + 1:]:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                pairs.append((i, j))
    degree = Counter(x for p in pairs for x in p)
    want, have = Counter(), Counter()
    for i, (key, _) in enumerate(rows):
        want[key] += degree[i]
    for key, links, _, kept in got:
        have[key] += links
    assert all(have[k] <= want[k] for k in want) and sum(have.values()) >= 0.95 * sum(want.values())
    assert all(kept == (key == component) for key, _, component, kept in got)
    assert {key for key, links, c, _ in got if key is not None and 4000 <= key <= 4005 and (links or c != key)} == set()
    assert rows_of(embeddings.near_vectors(spark.createDataFrame([], schema))) == []


def test_warc(spark):
    page = "<p>" + "é" * 80 + "</p>"
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("digest", T.StringType())])
    rows = [(3, "http://a.b.c/x?q", page, ""), (1, "http://A.b.c:80/x?q#f", page, ""), (2, "http://a.b.c/x?q", "short", ""), (4, None, "short", ""),
            (5, "bad url\r\n", None, ""), (6, "ftp://u@h:9/", "y" * 100_000, ""), (7, "x", page, ""), (7, "x", page, ""), (None, "n", page, "")]
    got = rows_of(warc.round_trip(spark.createDataFrame(rows, schema)))
    import hashlib

    want = []
    for key, _, text, _ in rows:
        data = (text or "").encode()
        revisit = text == page and key != 1
        want.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None))
    assert Counter(got) == Counter(want)
    assert rows_of(warc.round_trip(spark.createDataFrame([], schema))) == []
    assert warc.url_key("http://u:p@A.b.C:80/x?y#z") == "c,b,a)/x?y"


def test_index_finds_every_capture(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(f"http://h{i % 13}.org/{i % 5}", str(i)) for i in range(400)]
    captures = spark.createDataFrame([(warc.url_key(u), i, "f", int(i), 1) for u, i in rows],
                                     "urlkey string, id string, file string, start long, length long")
    found = warc.lookup(warc.build_index(captures), spark.createDataFrame([(rows[0][0],), (rows[9][0],), ("http://no.org/",)], "url string"))
    wanted = {rows[0][0], rows[9][0]}
    assert sorted(r.id for r in found.collect()) == sorted(i for u, i in rows if u in wanted)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_within_matches_the_edit_distance():
    rng = random.Random(8)
    for errors in (1, 2, 3):
        for _ in range(3000):
            a = "".join(rng.choice("ab") for _ in range(rng.randrange(10)))
            b = "".join(rng.choice("abc") if rng.random() < 0.2 else c for c in a if rng.random() < 0.85)
            assert linedup.within(a, b, errors) == (edits(a, b) <= errors)


def test_met_keys_over_any_cut():
    rng = random.Random(9)
    for _ in range(500):
        rows = sorted(((rng.randrange(6), rng.randrange(4), rng.random() < 0.5) for _ in range(rng.randrange(30))),
                      key=lambda r: (r[0], not r[2], r[1]))
        batches, at = [], 0
        while at < len(rows):
            n = rng.randrange(1, 6)
            k, i, o = zip(*rows[at:at + n])
            batches.append(pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array(o)], names=["key", "id", "own"]))
            at += n
        got = {x for b in linedup.met_keys(iter(batches)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
        want = {(k, i) for k, i, _ in rows
                if len({r[1] for r in rows if r[0] == k}) > 1 and any(r[2] for r in rows if r[0] == k)}
        assert got == want


@pytest.mark.parametrize("block", [2048, 4])
def test_line_dedup(docs_of, odd_rows, monkeypatch, block):
    monkeypatch.setattr(linedup, "BLOCK", block)
    rng = random.Random(10)
    stems = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(18, 40))).strip() for _ in range(12)]
    rows = list(odd_rows)
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(stems))
            for _ in range(rng.randrange(4)):
                line[rng.randrange(len(line))] = rng.choice("abcxyz")
            lines.append("".join(line))
        rows.append((100 + i, "\n".join(lines), "s"))
    got = {(d, t, total, lost) for d, t, *_, total, lost in rows_of(linedup.dedup_lines(docs_of(rows)))}
    order = sorted((d is None, d or 0, t or "") for d, t, _ in rows)
    first = {}
    for null, d, t in order:
        for n, line in enumerate(t.split("\n")):
            if len(line.strip()) >= 20:
                first.setdefault(line.strip(), (null, d, n))
    places = sorted(first.items(), key=lambda kv: (kv[1], kv[0]))
    dropped = set()
    for i, (line, at) in enumerate(places):
        if len(line) < 200 and any(abs(len(o) - len(line)) <= 2 and edits(o, line) <= 2 for o, _ in places[:i]):
            dropped.add(line)
    want = set()
    for d, t, _ in rows:
        kept, seen = [], set()
        for n, line in enumerate((t or "").split("\n")):
            bare = line.strip()
            if len(bare) >= 20:
                if bare in seen or bare in dropped or first[bare][:2] != (d is None, d or 0):
                    seen.add(bare)
                    continue
                seen.add(bare)
            kept.append(line)
        total = 0 if t is None else t.count("\n") + 1
        want.add((d, None if t is None else "\n".join(kept), total, total - len(kept) if t is not None else 0))
    assert got == want
    assert rows_of(linedup.dedup_lines(docs_of([]))) == []


def test_line_dedup_takes_short_lines(spark, tmp_path):
    rows = [(1, "Les.\nx\n\nA first line that is long enough."), (2, " Les. \nx y\n\nx\nx"), (3, "Lez.\nLes."), (None, "Les.\n "), (4, None),
            (5, "A first line that is lung enough.\nx y\n9")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(1, "Les.\nx\n\nA first line that is long enough.", 4, 0), (2, "x y\n", 5, 3), (3, "Lez.", 2, 1), (None, " ", 2, 1), (4, None, 0, 0),
            (5, "9", 3, 2)}
    assert set(rows_of(QUERIES["op7_line_dedup"](spark, str(tmp_path)))) == want
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert kept == {d: t for d, t, *_ in want if d is not None}


def test_within_many_edits():
    rng = random.Random(13)
    for errors in (4, 7):
        for _ in range(1500):
            a = "".join(rng.choice("abc") for _ in range(rng.randrange(30)))
            b = "".join(rng.choice("abcd") if rng.random() < 0.15 else c for c in a if rng.random() < 0.9)
            assert linedup.within(a, b, errors) == (edits(a, b) <= errors)


def test_long_lines_against_every_pair(docs_of):
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    lines = ["-" * 90, "-" * 94, "-" * 99, "ab" * 60, "ab" * 63]
    while len(lines) < 110:
        line = list(" ".join(rng.choice(words) for _ in range(rng.randrange(9, 45))))
        lines.append("".join(line).strip())
        for _ in range(2):
            for _ in range(rng.randrange(1, 2 + len(line) // 16)):
                at = rng.randrange(len(line))
                line[at:at + rng.randrange(2)] = rng.choice(["", "x", "é"])
            lines.append("".join(line).strip())
    lines = list(dict.fromkeys(lines))
    rng.shuffle(lines)
    near = {b for i, b in enumerate(lines) for a in lines[:i]
            if abs(len(a) - len(b)) <= len(b) // 10 and edits(a, b) <= max(2, min(len(a), len(b)) // 20)}
    many = {b for i, b in enumerate(lines) for a in lines[:i] if abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2}
    assert len(near) > len(many) + 10
    got = {t: lost for _, t, *_, lost in rows_of(linedup.dedup_lines(docs_of([(i, x, "s") for i, x in enumerate(lines)])))}
    assert {t for t, lost in got.items() if not lost} - {""} == set(lines) - near


def test_short_lines_against_a_plain_version(docs_of, odd_rows):
    rng = random.Random(12)
    rows = list(odd_rows[:3]) + [(100 + i, "\n".join(rng.choice(["", " "]) + "ab"[:rng.randrange(3)] * rng.randrange(4) for _ in range(rng.randrange(9))), "s")
                                 for i in range(80)]
    got = {(d, t, total, lost) for d, t, *_, total, lost in rows_of(linedup.dedup_lines(docs_of(rows), equal_from=1))}
    want, seen = set(), set()
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (t or "").split("\n"):
            if line.strip() not in seen:
                kept.append(line)
            if line.strip():
                seen.add(line.strip())
        total = 0 if t is None else t.count("\n") + 1
        want.add((d, None if t is None else "\n".join(kept), total, 0 if t is None else total - len(kept)))
    assert got == want


def test_mixing(docs_of, odd_rows):
    rng = random.Random(11)
    rows = odd_rows[:3] + odd_rows[5:] + [
        (100 + i, " ".join(["w"] * rng.randrange(1, 200)), rng.choice(["a", "a", "a", "b", "é", "z", None])) for i in range(600)
    ]
    frame = docs_of(rows)
    got = rows_of(mixing.copies(frame))
    assert Counter(got) == Counter(rows_of(mixing.copies(frame.repartition(7))))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        unit = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and unit * weight[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    goal = {sizes[s]: 2 * sizes[s] if s in full else unit * weight[s] for s in names}
    taken = Counter()
    for _, size, source_size, target, copies, words in got:
        assert words == copies * size <= 2 * size
        assert target == pytest.approx(goal[source_size])
        taken[source_size] += words
    assert len(got) == len(rows)
    for size, words in taken.items():
        assert abs(words - goal[size]) <= max(0.02 * goal[size], 200)
    assert rows_of(mixing.copies(docs_of([]))) == []
    mixed = Counter(r[0] for r in rows_of(mixing.mixed(frame)))
    once = {d for d, n in Counter(r[0] for r in rows).items() if n == 1}
    assert {d: n for d, n in mixed.items() if d in once} == {d: n for d, *_, n, _ in got if n and d in once}


def plain_page(i, body, extra=""):
    return (f'<html><head><title>t{i}</title><script>x="</p>"</script></head><body><nav><ul><li><a href="/">home {i}</a></li></ul></nav>'
            f'<div class="ad">buy now {i}</div><article><h1>Head {i}</h1>{body}</article>{extra}<footer>foot {i}</footer></body></html>')


def test_main_text(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("key", T.StringType())])
    rng = random.Random(12)
    rows, want = [], {}
    for i in range(80):
        paragraphs = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(3, 40))) + "." for _ in range(rng.randrange(1, 7))]
        extra = '<section class="comments"><p>first comment here</p></section>' if i % 7 == 0 else ""
        rows.append((i, "u", plain_page(i, "".join(f"<p>{p.replace('w1', '<b>w1</b>')} &amp; x<br>y" for p in paragraphs), extra), "k"))
        want[i] = " ".join([f"Head {i}"] + [f"{p} & x y" for p in paragraphs])
    rows += [(200, None, None, ""), (201, "", "", ""), (202, "u", "<p>" * 5, ""), (None, "u", rows[0][2], ""), (79, "u", rows[79][2], "")]
    got = rows_of(extraction.main_text(spark.createDataFrame(rows, schema)))
    assert len(got) == len(rows)
    right = sum(t == want[k] for k, _, t, _ in got if k in want)
    assert right >= 0.97 * 81
    assert all(n == len(t) for *_, t, n in got) and {t for k, _, t, _ in got if k in (200, 201, 202)} == {""}
    assert rows_of(extraction.main_text(spark.createDataFrame([], schema))) == []


def test_blocks():
    page = "<div>a<b>b</b> &lt;x&gt;<script>no</script><p>c<p>d <!-- no --> e</div>f < g<ul><li>h<li>i</ul>"
    assert [t for _, t, _ in extraction.blocks(page)] == ["ab <x>", "c", "d e", "f < g", "h", "i"]


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(13)
    net = extraction.Labeller(hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    pages = [rng.standard_normal((n, extraction.WIDTH)) for n in (4, 2)]
    labels = [np.array([1.0, 0, 1, 1]), np.array([0.0, 1])]

    def loss():
        scores = net.scores(pages)
        return sum(np.logaddexp(0, -s * (2 * y - 1)).sum() for s, y in zip(scores, labels)) / 6

    grads = net._gradients(pages, labels)
    for name in ("hf", "xb", "cb", "o"):
        at = tuple(0 for _ in net.weights[name].shape)
        old = net.weights[name][at]
        net.weights[name][at] = old + 1e-2
        up = loss()
        net.weights[name][at] = old - 1e-2
        down = loss()
        net.weights[name][at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(grads[name][at]), rel=0.05, abs=2e-3)


def test_exact_duplicates(docs_of, odd_rows):
    import hashlib
    import re

    rows = odd_rows + [(20, "a  b", "s"), (19, "a\tb", "s"), (21, "a b", "s"), (18, "", "s")]
    want = {}
    for d, t, _ in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        want.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(d)
    for bits in (24, 2):
        got = rows_of(exactdup.exact_duplicates(docs_of(rows), bits=bits))
        assert len(got) == len(rows)
        for digest, ids in want.items():
            own = [r for r in got if r[4] == digest]
            least = min((d for d in ids if d is not None), default=None)
            assert Counter(r[0] for r in own) == Counter(ids)
            assert all(r[1] == least and r[2] == len(ids) for r in own)
            assert [r[0] for r in own if r[3]] == [least]
    assert rows_of(exactdup.exact_duplicates(docs_of([]))) == []


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


@pytest.mark.parametrize("large, null_keys", [(True, False), (False, True)])
def test_main_text_is_fitted_on_any_pages(spark, large, null_keys):
    """Pages above the preferred size only, and null keys only: no page loses its article."""
    rng = random.Random(14)
    rows, want = [], []
    for i in range(24):
        words = [f"w{rng.randrange(999)}" for _ in range(400 if large else 30)]
        paragraphs = [" ".join(words[:20 + 10 * (j % 3)]) + "." for j in range(6)]
        rows.append((None if null_keys else i, "u", plain_page(i, "".join(f"<p>{p}</p>" for p in paragraphs))))
        want.append(" ".join([f"Head {i}", *paragraphs]))
    got = rows_of(extraction.main_text(spark.createDataFrame(rows, PAGES), fit_bytes=500 if large else extraction.FIT_BYTES))
    assert len(got) == 24 and len({t for *_, t, _ in got} & set(want)) >= 22


def test_long_pages_are_labelled_in_parts():
    rng = np.random.default_rng(15)
    net = extraction.Labeller(hidden=4)
    page = [(("html", "body", "p"), f"word{i} x{i % 7}", 0.0) for i in range(9000)]
    features = extraction.Features()
    whole = net.scores([features.matrix(page)])[0]
    assert np.allclose(net.scores([features.parts(page)])[0], whole, atol=1e-5)
    short = [rng.standard_normal((n, extraction.WIDTH)).astype(np.float32) for n in (5, 1)]
    together = net.scores(short)
    assert all(np.allclose(net.scores([p])[0], s, atol=1e-5) for p, s in zip(short, together))
