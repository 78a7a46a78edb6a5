"""Toxicity by a weighted finite-state grammar over clauses.

The words of a clause become symbols (insult, learned insult, threat, target, negation, reporting verb, other). Three
transducers are composed into one: negation marks what follows a negation within a few words, reported speech marks what
follows a reporting verb, and the last reads the marked symbols and weighs the clause's match: a bare insult, an insult
aimed at a target, a learned insult, a threat to a target, a negated or a reported match. A document is the sum of its
matched clauses by kind. Learned insults are the word beginnings that occur far more often in labelled toxic texts than
in clean ones, so that languages and inflections outside the stated lists are covered. What each kind counts for, and
what the length of the text takes off, is fitted to labelled rows by logistic regression that is held near stated
weights, so that kinds the labels lack keep them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.tables import saved

#: The terminals of the grammar.
INSULTS = """idiot idiots moron morons stupid dumb dumbass loser losers clown clowns scum trash pathetic worthless disgusting
imbecile imbeciles cretin cretins fool fools vermin filth filthy garbage parasite parasites pig pigs rat rats bastard bastards
bitch bitches whore slut jerk creep freak freaks degenerate subhuman retard retarded asshole assholes dickhead prick twat
wanker cunt shithead coward cowards liar liars brainless useless idiota idiotas imbécil estúpido estúpida basura
crétin abruti connard connasse salope ordure dummkopf idioten arschloch abschaum trottel schlampe""".split()
THREATS = """kill murder hurt destroy stab shoot strangle hang burn beat rape slaughter perish suffer bleed
matar morir tuer crever mourir töten sterben umbringen""".split()
TARGETS = """you your yours yourself u ur he she him her they them these those everyone people tu toi vous te ti usted ustedes
du dich dir ihr euch sie""".split()
NEGATIONS = """not no never neither nor without isn't aren't wasn't weren't don't doesn't didn't won't can't cannot hardly
nicht kein keine nie pas jamais ni nunca""".split()
REPORTS = """said says say saying called calls call calling wrote writes quoted quote quotes claimed claims reported reports
told allegedly supposedly word term sagte nannte dit appelle appelé dijo llamó""".split()

KINDS = ("bare", "aimed", "learned", "threat", "negated", "reported")
#: Weights of log(1 + matches) for kinds the labels do not show, of log(1 + characters), and of none at all.
PRIOR = (4.0, 5.0, 3.0, 5.0, 0.5, 1.0)
PRIOR_SIZE = 0.0
PRIOR_BIAS = -4.0
HOLD = 0.05
REACH = 3
FIT_ROWS = 20_000
#: A learned beginning has 4 to 12 letters, occurs in at least 6 toxic texts, and e^3 times as often as in clean ones.
SHORTEST, LONGEST = 4, 12
SUPPORT = 6
LOG_ODDS = 3.0
#: Bound on the learned beginnings, the surest first.
TERMS = 2_000
CLAUSE_ENDS = ".!?;:,\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol, kind weighed or None). Unlisted pairs copy the symbol."""

    def __init__(self, start, step) -> None:
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """Their composition: what this one writes, the other reads."""

        def step(state, symbol):
            left, middle, mine = self.step(state[0], symbol)
            right, out, theirs = other.step(state[1], middle)
            return (left, right), out, theirs or mine

        return Transducer((self.start, other.start), step)

    def table(self, symbols: str) -> Table:
        return Table(self, symbols)


class Table:
    """The reachable states of a transducer, numbered, as arrays to look up."""

    def __init__(self, machine: Transducer, symbols: str) -> None:
        numbers, waiting = {machine.start: 0}, [machine.start]
        self.next: list[dict[str, tuple[int, str | None]]] = []
        while waiting:
            state = waiting.pop(0)
            row = {}
            for symbol in symbols:
                to, _, kind = machine.step(state, symbol)
                if to not in numbers:
                    numbers[to] = len(numbers)
                    waiting.append(to)
                row[symbol] = (numbers[to], kind)
            self.next.append(row)

    def kinds(self, symbols: str) -> dict[str, int]:
        """How often each kind matches in a clause. An aimed match takes the place of the bare one it completes."""
        state, found = 0, {}
        for s in symbols:
            state, kind = self.next[state][s]
            if kind == "aims":
                found["bare"] -= 1
                kind = "aimed"
            if kind:
                found[kind] = found.get(kind, 0) + 1
        return found


def _negate(left: int, symbol: str):
    if symbol == "n":
        return REACH, symbol, None
    return max(0, left - 1), {"i": "x", "l": "x", "t": "x"}.get(symbol, symbol) if left else symbol, None


def _report(open_: bool, symbol: str):
    if symbol == "r":
        return True, symbol, None
    return open_, {"i": "q", "l": "q", "t": "q"}.get(symbol, symbol) if open_ else symbol, None


def _weigh(state: tuple[bool, bool, bool], symbol: str):
    """state: a target seen, a bare insult waiting for one, a threat waiting for one."""
    target, insult, threat = state
    if symbol == "x":
        return state, symbol, "negated"
    if symbol == "q":
        return state, symbol, "reported"
    if symbol == "i":
        return ((target, insult, threat), symbol, "aimed") if target else ((target, True, threat), symbol, "bare")
    if symbol == "l":
        return state, symbol, "learned"
    if symbol == "t":
        return ((target, insult, threat), symbol, "threat") if target else ((target, insult, True), symbol, None)
    if symbol == "g":
        if threat:
            return (True, insult, False), symbol, "threat"
        return (True, False, threat), symbol, "aims" if insult else None
    return state, symbol, None


GRAMMAR = Transducer(0, _negate).then(Transducer(False, _report)).then(Transducer((False, False, False), _weigh)).table("iltgnro")


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)]


class Matcher:
    """Finds the clauses that hold an insult, a learned one or a threat, and runs the grammar on those."""

    def __init__(self, learned: Sequence[str] = ()) -> None:
        self.symbols = {w: s for s, words in zip("rgnti", (REPORTS, TARGETS, NEGATIONS, THREATS, INSULTS)) for w in words}
        self.learned = frozenset(learned)
        self.finder = ahocorasick.Automaton()
        for word in {*INSULTS, *THREATS, *learned}:
            self.finder.add_word(word, len(word))
        self.finder.make_automaton()

    def symbol(self, word: str) -> str:
        found = self.symbols.get(word)
        if not found and self.learned and not self.learned.isdisjoint(beginnings(word)):
            return "l"
        return found or "o"

    def counts(self, text: str) -> list[int]:
        found = dict.fromkeys(KINDS, 0)
        text = text.lower()
        done = 0
        for last, size in self.finder.iter(text):
            start, stop = last + 1 - size, last + 1
            if start < done or text[start - 1:start].isalnum():
                continue
            if text[stop:stop + 1].isalnum() and text[start:stop] not in self.learned:
                continue
            before = max(done, 1 + max(text.rfind(end, done, start) for end in CLAUSE_ENDS))
            end = CLAUSE_END.search(text, stop)
            done = end.end() if end else len(text)
            clause = "".join(map(self.symbol, WORD.findall(text, before, done)))
            for kind, n in GRAMMAR.kinds(clause).items():
                found[kind] += n
        return [found[k] for k in KINDS]


def matches(df: DataFrame, key: str = "doc_id", text: str = "text", learned: Sequence[str] = ()) -> DataFrame:
    """(key, size, hits): characters, and matched clauses by kind in the order of KINDS. A null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(learned)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            hits = [matcher.counts(t) if t else [0] * len(KINDS) for t in texts]
            sizes = pa.array([len(t or "") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(hits, pa.list_(pa.int32()))], names=[key, "size", "hits"]
            )

    rows = df.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, size long, hits array<int>")


def learned_terms(rows: DataFrame, limit: int = TERMS) -> list[str]:
    """Beginnings of words that tell toxic texts from clean ones, from (text, _label) of a bounded sample.

    Equal texts count once (toxic if any of them is). A text counts a beginning once. Beginnings that extend another one
    in the list are left out, since the shorter one matches wherever they do.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(text.lower()))
                seen[label == 1].update({b for word in words for b in beginnings(word)})
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()),
                pa.array([seen[0][t] for t in terms], pa.int64()),
            ], names=["term", "toxic", "clean"])

    texts = rows.where("text IS NOT NULL").groupBy(F.sha2("text", 256)).agg(
        F.min("text").alias("text"), F.max("_label").cast("int").alias("_label")
    ).select("text", "_label")
    texts = saved(texts, "sample")
    n = {bool(r["toxic"]): r["n"] for r in texts.groupBy((F.col("_label") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    counted = texts.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    ).where(F.col("toxic") >= SUPPORT)
    odds = F.log((F.col("toxic") + 0.5) / (n.get(True, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(False, 0) + 1))
    sure = counted.withColumn("odds", odds).where(F.col("odds") > LOG_ODDS)
    found = {r["term"] for r in sure.orderBy(F.desc("odds"), F.desc("toxic"), "term").limit(limit).collect()}
    return sorted(t for t in found if not any(t[:k] in found for k in range(SHORTEST, len(t))))


def fit(hits: np.ndarray, labels: np.ndarray) -> tuple[float, list[float]]:
    """(bias, weights) of a logistic regression on log(1 + hits), the last of which is the size; the prior without rows."""
    prior = np.array([PRIOR_BIAS, *PRIOR, PRIOR_SIZE])
    if not len(labels):
        return prior[0], prior[1:].tolist()
    x = np.hstack([np.ones((len(labels), 1)), np.log1p(hits)])
    w = prior.copy()
    hold = HOLD * np.ones(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - hold * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), gradient)
        w += step * min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), w[1:].tolist()


def held_out(key: Column) -> Column:
    """Rows kept from the fit: crc32 of the key as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def scores(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``df``: key, held_out, score (0 to 1), predicted (1 if score >= 0.5), clauses (matches by kind).

    Learned insults and weights come from at most ``fit_rows`` labelled rows that are not held out, the first by the hash
    of their key; without any the stated words and weights hold. Null and empty texts score by the bias alone. A null key
    is never fitted on nor held out. Other columns are not read. Repeated rows are scored alike. Empty table: empty result.
    """
    known = labels.select(F.col(key), F.col(label).alias("_label")).where(F.col("_label").isNotNull() & ~held_out(F.col(key)))
    known = df.select(key).join(known, key).distinct()
    known = saved(known.orderBy(F.xxhash64(key), key, "_label").limit(fit_rows), "labelled")
    terms = learned_terms(df.select(key, F.col(text).alias("text")).join(F.broadcast(known), key))
    found = saved(matches(df, key, text, terms), "matches")
    sample = found.join(F.broadcast(known), key).orderBy(F.xxhash64(key), key, "_label").limit(fit_rows)
    sample = sample.select("hits", "size", "_label").collect()
    bias, weights = fit(
        np.array([[*r["hits"], r["size"]] for r in sample], dtype=float).reshape(-1, len(KINDS) + 1),
        np.array([r["_label"] for r in sample], dtype=float),
    )
    sum_ = F.lit(bias)
    for w, feature in zip(weights, [*(F.col("hits")[i] for i in range(len(KINDS))), F.col("size")]):
        sum_ = sum_ + F.lit(w) * F.log1p(feature)
    score = F.lit(1.0) / (1 + F.exp(-sum_))
    return found.withColumn("score", score).select(
        key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("hits").alias("clauses"),
    )
