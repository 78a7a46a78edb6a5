"""Personal data in texts: four stated rules, and a semi-Markov conditional random field for what the rules miss.

The rules give the base spans (e-mail, IPv4, card, phone), found in time linear in the text. They lose whatever runs together (two cards
with a space between, a phone before an address) or is written otherwise (no plus sign, "name (at) host dot org"). There
the field decides: every stretch of at most ``LONGEST`` tokens is a candidate, described as a whole (digits, groups, check
sums, marks, ends, what stands beside it) for each kind, and a dynamic program over the tokens chooses boundaries and kinds together.
Base spans are fixed segments of that program, so they stay; a span it adds must also have a posterior of ``SURE``.
Text without digits, at-signs or spelt-out ones cannot hold a candidate and scores nothing, so the program runs on the windows that
can, which gives the same answer as running it on the whole text.

The field is fitted on the driver on at most ``windows`` surroundings of base spans (those of the smallest hashes), as they are and
rewritten into spellings the rules miss, joined to a neighbour, or spoilt so that nothing is left to find.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
LONGEST = 24
SURE = 0.9
UNSEEN = 2.0
MOST_GROUPS = 6
WINDOWS = 150
#: Most characters of a candidate; windows reach further than that.
WIDEST, MARGIN = 80, 100
SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"

# ---- the rules ---------------------------------------------------------------------------------------

HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Digits with few marks between them: holds every address and every chain whole.
NUMBERS = re.compile(r"[0-9](?:[\x20().\[\]-]{0,3}[0-9])*+")
#: A candidate without an at-sign.
NUMBER = re.compile(r"[+(]{0,2}" + NUMBERS.pattern)
LOCAL_MARKS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the four rules, each leftmost and non-overlapping in its kind; a match that fails its test is gone."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_MARKS:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            found.append(("email", start, host.end()))
            done = host.end()
        at = text.find("@", host.end() if host else at + 1)
    for region in NUMBERS.finditer(text):
        low, high = region.span()
        if high - low < 7:
            continue
        for m in ADDRESS.finditer(text, low, high):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CHAIN.finditer(text, low, high):
            digits = only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=by_place)


def by_place(span: tuple) -> tuple:
    return span[1], KINDS.index(span[0])


# ---- tokens and windows ------------------------------------------------------------------------------

TOKENS = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
#: Spelt-out at-signs and dots. A bare "at" is a word like others.
AT = re.compile(r"\x20?[(\[{](?:at|AT)[)\]}]\x20?")
DOT = re.compile(r"\x20?[(\[{](?:dot|DOT)[)\]}]\x20?|\x20(?:dot|DOT)\x20|\[\.\]")
SIGN = re.compile("@|" + AT.pattern)


def places_of(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Stretches that hold digits, at-signs or spelt-out ones which no base span covers, in order."""
    merged: list[list[int]] = []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    starts, ends = [m[0] for m in merged], [m[1] for m in merged]

    def free(low: int, high: int) -> str:
        out, at = [], low
        for k in range(bisect_right(ends, low), bisect_left(starts, high)):
            out.append(text[at:max(at, starts[k])])
            at = ends[k]
        return " ".join([*out, text[at:high]])

    out = []
    for region in NUMBERS.finditer(text):
        low, high = region.span()
        if high - low >= 7:
            left = free(low, high)
            if len(only_digits(left)) >= 9 or len(re.findall("[0-9]+", left)) >= 4:
                out.append((low, high))
    at = text.find("@")
    while at >= 0:
        if free(at, at + 1):
            out.append((at, at + 1))
        at = text.find("@", at + 1)
    for mark in ("(at)", "(AT)", "[at]", "[AT]", "{at}", "{AT}"):
        at = text.find(mark)
        while at >= 0:
            out.append((at, at + len(mark)))
            at = text.find(mark, at + 1)
    return sorted(out)


def windows_of(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Windows (start, end) of the text in which a candidate may lie, wide enough to hold it and what stands beside it."""
    last = None
    for low, high in places_of(text, spans):
        low, high = max(0, low - MARGIN), min(len(text), high + MARGIN)
        if last and low <= last[1]:
            last = (last[0], max(last[1], high))
        else:
            if last:
                yield last
            last = (low, high)
    if last:
        yield last


def side(text: str, at: int) -> str:
    """The kind of character at a place."""
    if not 0 <= at < len(text):
        return "end"
    c = text[at]
    return "letter" if c.isalpha() else "digit" if c.isdigit() else "space" if c.isspace() else c


def features_of(text: str, low: int, high: int) -> list[str] | None:
    """What a stretch looks like as a whole; None if it cannot be personal data of any kind."""
    body = text[low:high]
    digits = only_digits(body)
    n = len(digits)
    at = body.count("@") + len(AT.findall(body))
    dots = body.count(".") + len(DOT.findall(body)) - body.count("[.]")
    groups = re.findall(r"[0-9]+", body)
    if at:
        if at > 1 or dots < 1 or not body[-1].isalnum() or not body[0].isalnum():
            return None
    elif not 4 <= n <= 19 or n < 9 and len(groups) != 4 or not NUMBER.fullmatch(body):
        return None
    out = ["one", f"before {side(text, low - 1)}", f"after {side(text, high)}"]
    if at:
        out.append(f"goes on {DOT.match(text, high) is not None}")
        sides = SIGN.split(body, maxsplit=1)
        host = DOT.sub(".", sides[1])
        out += [
            "at sign" if "@" in body else "at word", f"local {bool(re.fullmatch(r'[A-Za-z0-9._%+-]+', sides[0]))}",
            f"host {bool(HOST.fullmatch(host))}", f"tail {bool(re.fullmatch(r'[A-Za-z]{2,10}', host.rpartition('.')[2]))}",
            f"spaces {body.count(' ') > 3}",
        ]
        return out
    marks = "".join(sorted({c for c in body if not c.isdigit()}))
    sizes = "-".join(str(len(g)) for g in groups)
    octets = DOT.sub(".", body).split(".")
    is_octets = len(octets) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) <= 255 for p in octets)
    out += [
        f"digits {n}", f"marks {marks}", f"groups {len(groups)}", f"opens {body[0] if body[0] in '+(' else 'digit'}",
        f"octets {is_octets}", f"check {luhn(digits)} {12 <= n <= 19}", f"sizes {sizes}", f"least {min(map(len, groups))}",
        f"paired {body.count('(') == body.count(')')}", f"phone length {9 <= n <= 15} {body[0] if body[0] in '+(' else 'digit'}",
        f"fours {sizes in ('4-4-4-4', '16', '4-6-5', '15')} {luhn(digits)}",
    ]
    return out


def candidates(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[int], list[tuple[int, int, list[str]]], dict[int, tuple[int, int]]]:
    """(token bounds, candidate stretches as (first token, end token, features), fixed: first token -> (end token, kind))."""
    bounds = [0] + [m.end() for m in TOKENS.finditer(text)]
    index = {b: i for i, b in enumerate(bounds)}
    fixed: dict[int, tuple[int, int]] = {}
    blocked = [False] * (len(bounds) - 1)
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        i, j = index[start], index[end]
        if not any(blocked[i:j]):
            fixed[i] = (j, 1 + KINDS.index(kind))
        for k in range(i, j):
            blocked[k] = True
    found = []
    n = len(bounds) - 1
    for i in range(n):
        first = text[bounds[i]]
        if blocked[i] or not (first in "+(" or first.isascii() and first.isalnum()):
            continue
        digits, groups, sign, small = 0, 0, False, False
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            low, high = bounds[j - 1], bounds[j]
            last = text[low]
            if blocked[j - 1] or last == "\n" or high - bounds[i] > WIDEST:
                break
            if "0" <= last <= "9":
                digits += high - low
                groups += 1
                small = small or groups > 1 and high - low == 1
            elif last == "@" or last in "aA" and text[low:high] in ("at", "AT"):
                sign = True
            # cheap bounds first: with no at-sign, at most MOST_GROUPS groups of two digits or more behind the first, or four of any size
            plausible = sign or 9 <= digits <= 19 and groups <= MOST_GROUPS and not small or groups == 4 and digits <= 12
            if plausible and last.isascii() and last.isalnum():
                told = features_of(text, bounds[i], high)
                if told:
                    found.append((i, j, told))
    return bounds, found, fixed


# ---- the field -----------------------------------------------------------------------------------------

class Field:
    """Semi-Markov conditional random field over tokens: a segment is one token outside, or a stretch of one kind."""

    def __init__(self) -> None:
        self.names: dict[str, int] = {}
        self.weights = np.zeros((0, len(KINDS)))
        self.steps = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def _known(self, found: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, np.ndarray, int]]:
        """Features by number, and how many no training window has shown."""
        out = []
        for i, j, told in found:
            ids = np.array([self.names[t] for t in told if t in self.names], dtype=np.int64)
            out.append((i, j, ids, len(told) - len(ids)))
        return out

    def _scores(self, known) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        # what has never been shown counts against every kind
        return [(i, j, ids, self.weights[ids].sum(axis=0) - UNSEEN * unseen) for i, j, ids, unseen in known]

    def _sums(self, n: int, segments, fixed, most: bool = False):
        """Forward table over token bounds: log-sums (or, with ``most``, largest scores and where they come from)."""
        kinds = len(KINDS) + 1
        table = np.full((n + 1, kinds), -np.inf)
        table[0, OUTSIDE] = 0.0
        came: list[list] = [[None] * kinds for _ in range(n + 1)]
        entries: list = [None] * (n + 1)
        ending: dict[int, list] = {}
        for i, j, _, score in segments:
            ending.setdefault(j, []).append((i, score))
        closed = {j: (i, kind) for i, (j, kind) in fixed.items()}
        inside = {k for i, (j, _) in fixed.items() for k in range(i + 1, j + 1)}

        def enter(i: int) -> tuple[np.ndarray, list[int]]:
            """Of all ways to reach bound i: the sum by the kind that begins there, and the likeliest kind before it."""
            if entries[i] is None:
                into = table[i][:, None] + self.steps
                entries[i] = (into.max(axis=0), into.argmax(axis=0).tolist()) if most else (np.logaddexp.reduce(into, axis=0), [0] * kinds)
            return entries[i]

        for j in range(1, n + 1):
            if j in inside:
                if j in closed:
                    i, kind = closed[j]
                    values, before = enter(i)
                    table[j, kind], came[j][kind] = values[kind], (i, before[kind])
                continue
            values, before = enter(j - 1)
            table[j, OUTSIDE], came[j][OUTSIDE] = values[OUTSIDE], (j - 1, before[OUTSIDE])
            for i, score in ending.get(j, ()):
                values, before = enter(i)
                values = values[1:] + score
                if most:
                    for kind in np.flatnonzero(values > table[j, 1:]).tolist():
                        table[j, kind + 1], came[j][kind + 1] = values[kind], (i, before[kind + 1])
                else:
                    table[j, 1:] = np.logaddexp(table[j, 1:], values)
        return table, came

    def _backward(self, n: int, segments, fixed) -> np.ndarray:
        table = np.full((n + 1, len(KINDS) + 1), -np.inf)
        table[n] = 0.0
        starting: dict[int, list] = {}
        for i, j, _, score in segments:
            starting.setdefault(i, []).append((j, score))
        inside = {k for i, (j, _) in fixed.items() for k in range(i + 1, j)}
        for i in range(n - 1, -1, -1):
            if i in inside:
                continue
            ways = np.full(len(KINDS) + 1, -np.inf)
            if i in fixed:
                j, kind = fixed[i]
                ways[kind] = table[j, kind]
            else:
                ways[OUTSIDE] = table[i + 1, OUTSIDE]
                for j, score in starting.get(i, ()):
                    ways[1:] = np.logaddexp(ways[1:], table[j, 1:] + score)
            table[i] = np.logaddexp.reduce(self.steps + ways, axis=1)
        return table

    def _posteriors(self, n: int, segments, fixed) -> tuple[list[np.ndarray], np.ndarray]:
        """(posterior of each kind for each candidate, expected steps into the kinds)."""
        ahead, _ = self._sums(n, segments, fixed)
        back = self._backward(n, segments, fixed)
        whole = float(np.logaddexp.reduce(ahead[n]))
        shares, steps = [], np.zeros((len(KINDS) + 1, len(KINDS)))
        for i, j, _, score in segments:
            both = np.exp(np.minimum(0.0, ahead[i][:, None] + self.steps[:, 1:] + score + back[j, 1:] - whole))
            steps += both
            shares.append(both.sum(axis=0))
        return shares, steps

    def added(self, text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """The spans of one window beside the base spans in it."""
        bounds, found, fixed = candidates(text, spans)
        if not found:
            return []
        segments = self._scores(self._known(found))
        # a candidate that loses in the best company is in no best segmentation; mostly none is left
        company = self.steps[:, 1:].max(axis=0) + np.maximum(0.0, self.steps[1:, :].max(axis=1))
        able = [s for s in segments if (s[3] + company).max() > 0]
        if not able:
            return []
        n = len(bounds) - 1
        table, came = self._sums(n, able, fixed, most=True)
        j, kind, chosen = n, int(table[n].argmax()), []
        while j > 0:
            i, before = came[j][kind]
            if kind != OUTSIDE and fixed.get(i, (None,))[0] != j:
                chosen.append((i, j, kind))
            j, kind = i, before
        if not chosen:
            return []
        shares, _ = self._posteriors(n, segments, fixed)
        sure = {(i, j): share for (i, j, *_), share in zip(segments, shares)}
        return [(KINDS[k - 1], bounds[i], bounds[j]) for i, j, k in chosen if sure[i, j][k - 1] >= SURE]

    def fit(self, examples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 6, rate: float = 0.3, shrink: float = 1e-3) -> None:
        """Ascends the likelihood of the examples' segmentations by per-weight step sizes (AdaGrad), one example at a time."""
        prepared = []
        for text, gold in examples:
            bounds, found, _ = candidates(text, [])
            index = {b: i for i, b in enumerate(bounds)}
            if not all(s in index and e in index for _, s, e in gold):
                continue
            wanted = {(index[s], index[e]): KINDS.index(k) for k, s, e in gold}
            if wanted.keys() <= {(i, j) for i, j, _ in found}:
                prepared.append((len(bounds) - 1, found, wanted))
        for _, found, _ in prepared:
            for _, _, told in found:
                for t in told:
                    self.names.setdefault(t, len(self.names))
        prepared = [(n, self._known(found), wanted) for n, found, wanted in prepared]
        self.weights = np.zeros((len(self.names), len(KINDS)))
        past, past_steps = np.full_like(self.weights, 1e-2), np.full_like(self.steps[:, 1:], 1e-2)
        order = random.Random(7)
        for _ in range(rounds):
            order.shuffle(prepared)
            for n, found, wanted in prepared:
                segments = self._scores(found)
                shares, steps = self._posteriors(n, segments, {})
                move: dict[int, np.ndarray] = {}
                for (i, j, ids, _), share in zip(segments, shares):
                    off = -share
                    if (i, j) in wanted:
                        off[wanted[i, j]] += 1
                    if np.abs(off).max() > 1e-4:
                        for k in ids.tolist():
                            move[k] = move.get(k, 0) + off
                for k, g in move.items():
                    g = g - shrink * self.weights[k]
                    past[k] += g * g
                    self.weights[k] += rate * g / np.sqrt(past[k])
                ending = {j: kind + 1 for (_, j), kind in wanted.items()}
                g = -steps - shrink * self.steps[:, 1:]
                for (i, _), kind in wanted.items():
                    g[ending.get(i, OUTSIDE), kind] += 1
                past_steps += g * g
                self.steps[:, 1:] += rate * g / np.sqrt(past_steps)


# ---- training examples -----------------------------------------------------------------------------------

#: Examples of each kind, used besides what the texts show.
SEEDS = (
    ("email", "anna.lee@example.org"), ("email", "j_smith42@mail.example.com"), ("email", "office@city-library.net"),
    ("ip", "192.168.17.44"), ("ip", "10.0.0.7"), ("ip", "203.0.113.250"), ("card", "4111111111111111"),
    ("card", "5500 0000 0000 0004"), ("card", "3400-000000-00009"), ("phone", "+44 (020) 555-0199"), ("phone", "+1 202 555 0143"),
    ("phone", "+49 30 5550 1234"),
)
PLAIN = "the and of to in on was it for with that from here there note see".split()


def card_number(rng: random.Random, size: int) -> str:
    head = "".join(rng.choice("0123456789") for _ in range(size - 1))
    return next(head + c for c in "0123456789" if luhn(head + c))


def respelt(kind: str, body: str, rng: random.Random) -> str:
    """The same datum in a spelling that the rules miss, or another of the kind."""
    if kind == "email":
        local, _, host = body.partition("@")
        at = rng.choice((" (at) ", "(at)", " [at] ", "[at]", " {at} "))
        dot = rng.choice((".", ".", " dot ", " (dot) ", "(dot)", " [dot] ", "[dot]", "[.]"))
        return local + at + host.replace(".", dot)
    if kind == "ip":
        return body.replace(".", "[.]")
    if kind == "card":
        digits = card_number(rng, rng.choice((15, 16, 16, 16)))
        parts = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return rng.choice((digits, " ".join(parts), "-".join(parts), ".".join(parts)))
    digits = "".join(rng.choice("0123456789") for _ in range(rng.choice((10, 10, 11))))
    area, rest = digits[:-7], digits[-7:]
    return rng.choice((f"({area}) {rest[:3]}-{rest[3:]}", f"{area}-{rest[:3]}-{rest[3:]}", f"+1 ({area[-3:]}) {rest[:3]}-{rest[3:]}",
                       f"00{rng.randrange(1, 99)} {area} {rest[:3]} {rest[3:]}", f"({area}) {rest[:3]} {rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}"))


def spoilt(kind: str, body: str, rng: random.Random) -> str:
    """Something alike that is nobody's datum."""
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        return rng.choice(("@" + body.partition("@")[2].partition(".")[0], body.replace("@", " ", 1), "look (at) this", f"@{some(3)}", "see [at] end. Then"))
    if kind == "ip":
        return rng.choice((".".join(str(rng.randrange(256, 999)) for _ in range(4)), f"{some(1)}.{some(2)}.{some(1)}", f"{some(2)}.{some(3)}"))
    if kind == "card":
        wrong = card_number(rng, 16)
        wrong = wrong[:-1] + str((int(wrong[-1]) + 1 + rng.randrange(9)) % 10)
        return rng.choice((wrong, some(8), "".join(rng.choice("0123456789abcdef") for _ in range(40)), some(22)))
    return rng.choice((
        f"20{some(2)}-0{rng.randrange(1, 9)}-1{some(1)} 1{some(1)}:{some(2)}", f"{some(3)},{some(3)},{some(3)}", f"{some(4)}-{some(4)}",
        f"{some(5)}.{some(6)}", some(9), some(10), f"{some(2)} {some(2)} {some(3)} {some(2)} {some(2)}", f"19{some(2)}-20{some(2)} 20{some(2)}",
        f"{some(3)} {some(4)} {some(5)} {some(1)}", f"978-{some(1)}-{some(3)}-{some(5)}-{some(1)}",
    ))


def examples_of(found: list[tuple[str, list[tuple[str, int, int]]]], seed: int = 3) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows with their spans: as found, and each kind respelt, run together and spoilt in the same surroundings."""
    rng = random.Random(seed)
    shown = [(k, text[s:e]) for text, spans in found for k, s, e in spans]
    beside = [text[:spans[0][1]].split()[-3:] for text, spans in found if spans] or [PLAIN[:3]]
    out = [(text, spans) for text, spans in found if not places_of(text, spans)]

    def put(pieces: list[tuple[str | None, str]]) -> None:
        text, spans = " ".join(rng.choice(beside) or PLAIN[:2]) + " ", []
        for i, (kind, body) in enumerate(pieces):
            text += " " if i else ""
            if kind:
                spans.append((kind, len(text), len(text) + len(body)))
            text += body
        out.append((text + rng.choice((" ", ", ", ". ", ") ", "\n")) + " ".join(rng.choice(beside) or PLAIN[2:4]), spans))

    for k, body in [*SEEDS * 6, *shown]:
        put([(k, body)])
        put([(k, respelt(k, body, rng))])
        put([(None, spoilt(k, body, rng))])
        other, second = rng.choice(shown) if shown and rng.random() < 0.5 else rng.choice(SEEDS)
        if rng.random() < 0.5:
            put([(k, respelt(k, body, rng)), (other, second)])
        if rng.random() < 0.5:
            put([(other, second), (k, respelt(k, body, rng))])
        put([(k, respelt(k, body, rng)), (k, respelt(k, body, rng))] if k in ("card", "phone") else [(k, body), (other, second)])
    return out


def base_windows(df: DataFrame, text: str, windows: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """At most ``windows`` surroundings of base spans, those of the smallest hashes, with the base spans in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, cut, spans = [], [], []
            for t in batch.column(0).to_pylist():
                found = base_spans(t) if t else []
                for kind, start, end in found:
                    low, high = max(0, start - 30), min(len(t), end + 30)
                    inside = [(k, s - low, e - low) for k, s, e in found if s < high and e > low]
                    if end - start > 200 or any(s < 0 or e > high - low for _, s, e in inside):
                        continue
                    order.append(hashlib.md5(t[low:high].encode("utf-8", "surrogatepass")).hexdigest())
                    cut.append(t[low:high])
                    spans.append(" ".join(f"{k}:{s}:{e}" for k, s, e in inside))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (order, cut, spans)], names=["o", "t", "s"])

    rows = df.select(F.col(text).alias("t")).mapInArrow(run, "o string, t string, s string").groupBy("o").agg(
        F.min(F.struct("t", "s")).alias("r")
    ).orderBy("o").limit(windows).select("r.t", "r.s").collect()
    return [(r.t, [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.s.split())]) for r in rows]


def fitted(df: DataFrame, text: str = "text", windows: int = WINDOWS) -> Field:
    field = Field()
    field.fit(examples_of(base_windows(df, text, windows)))
    return field


def all_spans(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, added) of one text, by start and kind."""
    base = base_spans(text)
    out = [(*s, False) for s in base]
    for low, high in windows_of(text, base):
        # a span cut by the window's edge widens it
        for _, s, e in base:
            if s < low < e:
                low = s
            if s < high < e:
                high = e
        inside = [(k, s - low, e - low) for k, s, e in base if low <= s and e <= high]
        out += [(k, s + low, e + low, True) for k, s, e in field.added(text[low:high], inside)]
    return sorted(set(out), key=by_place)


def personal_spans(df: DataFrame, key: str = "doc_id", text: str = "text", windows: int = WINDOWS, field: Field | None = None) -> DataFrame:
    """(key, spans): every row's spans (kind, start, end in code points, end exclusive; added: by the field), by start, then kind.

    A null text counts as empty; repeated rows and null keys are rows like others, and columns of any other name are not
    read. Texts are read whole, however long; work is linear but in windows dense with digits, where a token costs up to
    ``LONGEST`` candidates. An empty table gives no row and is fitted on the stated examples alone.
    """
    model = field or fitted(df, text, windows)
    kind = dict(df.dtypes)[key]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "added"), s)) for s in all_spans(t or "", model)] for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], names=["key", "spans"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, spans {SPANS}")
    return rows.withColumnRenamed("key", key)


def joined_spans(spans) -> object:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, base spans of each kind counted, base_sha256, all spans as text, and how many of them the field has added."""
    base = F.filter("spans", lambda s: ~s["added"])
    counts = [F.size(F.array_remove(F.transform(base, lambda s: s["kind"] != kind), True)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        key, *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added"),
    )
