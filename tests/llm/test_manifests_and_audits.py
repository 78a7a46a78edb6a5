"""Merkle manifest, personal data and filter audit against plain versions, and on odd rows and empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parlance.llm import audit, merkle, personal
from parlance.llm.tries import Trie


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def none_first(x):
    return (x is not None, x or 0) if not isinstance(x, str) else (True, x.encode())


def plain_manifest(rows):
    """Per row (doc_id, leaf, subroot, root, proof, folded, verified) for rows (doc_id, text, source), one tree a source."""
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(hashes):
        levels = [hashes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha(*last[i:i + 8]) for i in range(0, len(last), 8)])
        return levels

    def climb(levels, i):
        for level in levels[:-1]:
            run = i // 8 * 8
            yield level[run:i], level[i + 1:run + 8]
            i //= 8

    groups = defaultdict(list)
    for d, t, s in rows:
        leaf = sha(framed(d), framed(s), framed(t))
        low = None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
        hit = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        groups[s].append((none_first(d), leaf, sha(framed(d), framed(s), framed(low)) if hit else leaf, d))
    order = sorted(groups, key=none_first)
    trees = {s: tree([x[1] for x in sorted(groups[s])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, (_, leaf, changed, d) in enumerate(sorted(groups[s])):
            path = [*climb(trees[s], i), *climb(top, k)]
            node = changed
            for left, right in path:
                node = sha(*left, node, *right)
            proof = sha(*[x for left, right in path for x in (*left, *right)])
            yield d, leaf, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]


@pytest.mark.parametrize("groups", [1, 3, 11])
def test_merkle(docs_of, odd_rows, groups):
    rng = random.Random(4)
    rows = [(100 + i, f"Text {rng.randrange(400)}" if i % 2 else f"text {i}", f"g{int(groups * rng.random() ** 3)}") for i in range(650)]
    rows += [(9000, "Alone", "z")] if groups > 1 else []
    rows = rows if groups == 1 else rows + odd_rows
    got = merkle.verified_leaves(docs_of(rows), group="source", fields=("doc_id", "source", "text")).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_manifest(rows))
    assert {r.verified for r in got} == {True, False}


def test_merkle_nodes(docs_of):
    assert merkle.verified_leaves(docs_of([]), group="source", fields=("doc_id", "text")).collect() == []
    nodes = merkle.manifest(docs_of([(i, "x", "a") for i in range(70)]), group="source", fields=("doc_id", "text")).collect()
    assert Counter(r.level for r in nodes) == {0: 70, 1: 9, 2: 2, 3: 1, -1: 1}
    for level in range(4):
        spans = sorted((r.lo, r.hi) for r in nodes if r.level == level)
        assert spans[0][0] == 0 and spans[-1][1] == 70 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_trie():
    rng = random.Random(5)
    trie, want = Trie(), {}
    for i in range(3000):
        data = bytes(rng.choice(b"ab\xc3") for _ in range(rng.randrange(12)))
        node = trie.insert(data)
        assert (node.rows is not None) == (data in want)
        node.rows = want[data] = i
    assert {text: node.rows for text, node in trie.terminals()} == want


def plain_audit(rows, labels):
    first = {}
    for d, t, _ in rows:
        t = t or ""
        key = (d is None, d or 0)
        first[t] = min(first.get(t, key), key)
    good, toxic = Counter(), Counter()
    n = Counter()
    marks = {}
    for d, q, x in labels:
        a, b = marks.get(d, (False, False))
        marks[d] = (a or q == 1, b or x == 1)
    for d, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = frozenset(c for c, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t), (d is None, d or 0) > first[t],
        )) if bad)
        n[s or "", fails] += 1
        is_good, is_toxic = marks.get(d, (False, False)) if d is not None else (False, False)
        good[s or "", fails] += is_good
        toxic[s or "", fails] += is_toxic
    shapley = Counter()
    out = {}
    for part in {p for p, _ in n}:
        own = [(f, n[part, f], good[part, f], toxic[part, f]) for p, f in n if p == part]
        for order in itertools.permutations("ABCDE"):
            for step, c in enumerate(order, 1):
                before = set(order[:step - 1])
                removed = sum(k for f, k, *_ in own if c in f and not f & before)
                shapley[part, c] += removed
                out[part, "".join(order), step] = (
                    sum(k for f, k, *_ in own if c not in f and not f & before), removed,
                    sum(k for f, k, *_ in own if c in f and f & before), sum(k for f, k, *_ in own if f == {c}),
                    sum(g for f, _, g, _ in own if c in f and not f & before), sum(x for f, *_, x in own if c in f and not f & before),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("small", [False, True])
def test_audit(spark, docs_of, odd_rows, monkeypatch, small):
    rng = random.Random(6)
    if small:  # tries emptied often, prefixes taken longer
        monkeypatch.setattr(audit, "TRIE_BYTES", 3000)
        monkeypatch.setattr(audit.large_cells, "__defaults__", (2000,))
    head = " ".join(f"word{i}" for i in range(260))
    rows = list(odd_rows) + [(1000 - i, f"{head} {rng.randrange(30)} #"[rng.randrange(2):], rng.choice(("a", "b"))) for i in range(120)]
    rows += [(2000 + i, "the same text", "a") for i in range(200)] + [(i, f"HEAD {i % 7}", None) for i in range(40)]
    rng.shuffle(rows)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 1000, 3)] + [(3, 1, 1), (None, 1, 1), (999, 0, 1), (999, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.filter_audit(docs_of(rows).repartition(7), marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == plain_audit(rows, labels)
    assert audit.filter_audit(docs_of([]), marks).collect() == []


def test_adaptive_cells(docs_of):
    head = "a" * 90
    rows = docs_of([(i, f"{head}{i:04d}" if i % 2 else f"{i:04d}", "a") for i in range(400)]).select("doc_id", "text")
    large = audit.large_cells(rows.select("text"), 1000)
    assert [n for n, _ in large][:3] == [4, 16, 64]
    cells = {r.text: r.cell for r in audit.with_cells(rows, large).collect()}
    assert len(cells) == 400 and len({c for t, c in cells.items() if t.startswith("aa")}) > 50
    assert len(audit.large_cells(docs_of([(i, "same" * 400, "a") for i in range(50)]).select("text"), 1700)) == 0


# ---- personal data -----------------------------------------------------------------------------------

RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "phone" and 9 <= len(digits) <= 15 \
                    or kind == "card" and 12 <= len(digits) <= 19 and plain_luhn(digits):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], [k for k, _ in RULES].index(s[0])))


def test_base_spans():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("012345+@.-( )aé\n") for _ in range(rng.randrange(50)))
        assert personal.base_spans(text) == plain_spans(text)
    cards = ["4111111111111111", "5500 0000 0000 0004", "3400-000000-00009", "4111111111111112"]
    text = " é ".join([*cards, "+49 (30) 5550-1234", "a.b@c-d.ef", "1.2.3.400", "1.2.3.4.5.6.7.8"])
    assert personal.base_spans(text) == plain_spans(text)
    long_ = "1" * 300_000 + " " + "a" * 300_000 + "@" + "0." * 100_000
    found = personal.base_spans(long_)
    assert {k for k, *_ in found} == {"email", "ip"} and len(found) == 1 + 100_000 // 4


def segmentations(n, found, at=0, before=0):
    """All of them, as lists of (start, end, kind, kind before)."""
    if at == n:
        yield []
        return
    for rest in segmentations(n, found, at + 1, 0):
        yield [(at, at + 1, 0, before), *rest]
    for i, j, *_ in found:
        if i == at:
            for kind in range(1, 5):
                for rest in segmentations(n, found, j, kind):
                    yield [(i, j, kind, before), *rest]


def test_field_sums_over_all_segmentations():
    rng = np.random.default_rng(9)
    text = "x 1.2.3.4 98"
    bounds, found, fixed = personal.candidates(text, [])
    found = found[:4]
    field = personal.Field()
    for _, _, told in found:
        for t in told:
            field.names.setdefault(t, len(field.names))
    field.weights = rng.normal(0, 1, (len(field.names), 4))
    field.steps[:, 1:] = rng.normal(0, 1, (5, 4))
    segments = field._scores(field._known(found))
    scores = {(i, j): s for i, j, _, s in segments}
    n = len(bounds) - 1
    weighed = [
        (sum(field.steps[b, k] + (scores[i, j][k - 1] if k else 0) for i, j, k, b in way), way) for way in segmentations(n, found)
    ]
    whole = sum(np.exp(w) for w, _ in weighed)
    shares, steps = field._posteriors(n, segments, fixed)
    for (i, j, _, _), share in zip(segments, shares):
        want = [sum(np.exp(w) for w, way in weighed if (i, j, k) in {x[:3] for x in way}) / whole for k in range(1, 5)]
        assert np.allclose(share, want)
    want = np.zeros((5, 4))
    for w, way in weighed:
        for _, _, k, b in way:
            if k:
                want[b, k - 1] += np.exp(w) / whole
    assert np.allclose(steps, want)
    table, _ = field._sums(n, segments, fixed, most=True)
    assert np.isclose(table[n].max(), max(w for w, _ in weighed))


@pytest.fixture(scope="module")
def field(spark, sf):
    return personal.fitted(spark.read.parquet(f"{sf}/documents.parquet"))


def test_added_spans(field):
    """What the rules lose, in words that no training window has; and what is nobody's."""
    for text, want in (
        ("Der Zettel: 7536784127813050 4845168114407329 liegt hier", ["7536784127813050", "4845168114407329"]),
        ("Ring +1 (826) 555-4081 190.137.223.204 tomorrow", ["+1 (826) 555-4081", "190.137.223.204"]),
        ("schreib an karla.m (at) beispiel (dot) org bitte", ["karla.m (at) beispiel (dot) org"]),
        ("server 10[.]20[.]30[.]40 antwortet", ["10[.]20[.]30[.]40"]),
        ("phone (017) 555-7713 after six", ["(017) 555-7713"]),
    ):
        assert [text[s:e] for _, s, e, _ in personal.all_spans(text, field)] == want
    for text in ("on 2024-05-17 12:30 we had 1,234,567.89", "isbn 978-3-16-148410-0 fine", "pages 12 34 56 78 90 12 and 555",
                 'token = "2100a60029d9170a161913d4d019930026318f5d"', "look (at) this", "see you at noon dot", "build 3.11.4.1 of 1999-2004 2011",
                 "pi is 3.14159265358979", "4111111111111112"):
        added = [s for s in personal.all_spans(text, field) if s[3]]
        assert not added, (text, added)


def test_personal_rows(spark, docs_of, odd_rows, field):
    rows = [*odd_rows, (20, "a@b.cd und 4111111111111111 4111111111111111", "x"), (21, "9" * 50_000, "x"), (22, "1 " * 20_000, "x")]
    got = personal.span_digests(personal.personal_spans(docs_of(rows), field=field)).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for d, t, _ in rows:
        texts[d].append(t or "")
    told = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)
    for r in got:
        assert r.base_sha256 in {hashlib.sha256(told(plain_spans(t)).encode()).hexdigest() for t in texts[r.doc_id]}
    one = next(r for r in got if r.doc_id == 20)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone, one.n_added) == (1, 0, 0, 0, 2)
    assert one.spans == "email:0:6,card:11:27,card:28:44"
    assert personal.personal_spans(docs_of([])).collect() == []
