"""Text and label metrics: BLEU, ROUGE, token, preference and multiple-choice accuracy."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import words
from parlance.functions.udfs import batch_udf
from parlance.model import IGNORE_LABEL


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, dtype=np.int64)
    return codes[first], np.diff(np.r_[first, len(codes)])


def _clipped(a: np.ndarray, b: np.ndarray) -> int:
    """Occurrences two code arrays have in common."""
    (x, n), (y, m) = _runs(a), _runs(b)
    if not len(x) or not len(y):
        return 0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int(np.minimum(n, m[at])[y[at] == x].sum())


@batch_udf("array<int>")
def gram_hits(predict: pd.Series, label: pd.Series) -> pd.Series:
    """Clipped matches and totals of character n-grams, n = 1..4, of one row's two texts: nothing is shuffled.

    A gram is a number to the base of the row's different characters, exact while four of them fit 64 bits.
    """

    def counts(text: str, n: int) -> Counter:
        return Counter(text[i : i + n] for i in range(len(text) - n + 1))

    def one(p, l) -> list[int]:
        p, l = p or "", l or ""
        marks = np.frombuffer((p + l).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        seen = np.bincount(marks) > 0 if len(marks) else np.zeros(1, dtype=bool)
        base = int(seen.sum())
        if base >= 2**15:
            return [x for n in range(1, 5) for x in ((counts(p, n) & counts(l, n)).total(), max(len(p) - n + 1, 0))]
        marks = (np.cumsum(seen) - 1)[marks]
        mine, theirs, out = marks[: len(p)], marks[len(p) :], []
        a, b = mine, theirs
        for n in range(1, 5):
            if n > 1:
                a, b = a[:-1] * base + mine[n - 1 :], b[:-1] * base + theirs[n - 1 :]
            out += [_clipped(a, b), len(a)]
        return out

    return pd.Series([one(p, l) for p, l in zip(predict, label)])


def _bleu(h: Column, r: Column, g: Column) -> Column:
    """BLEU-4 in percent from the lengths and the gram hits: a zero precision becomes 1 / (2^k * total), k counting the zero ones so far."""
    zeros, logs = F.lit(0), F.lit(0.0)
    for n in range(4):
        hit = F.get(g, F.lit(2 * n))
        total = F.greatest(F.get(g, F.lit(2 * n + 1)), F.lit(1)).cast("double")
        zeros = zeros + F.when(hit == 0, 1).otherwise(0)
        p = F.when(hit == 0, F.lit(1.0) / (F.pow(F.lit(2.0), zeros) * total)).otherwise(hit / total)
        logs = logs + F.lit(0.25) * F.log(p)
    brevity = F.when(h > r, F.lit(1.0)).when(h == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / F.nullif(h, F.lit(0))))
    score = F.when(F.get(g, F.lit(0)) == 0, F.lit(0.0)).otherwise(brevity * F.exp(logs))
    return F.round(score * 100, 4)


def bleu4(df: DataFrame, key: str, predict: str = "predict", label: str = "label") -> DataFrame:
    """Character BLEU-4 in percent."""
    rows = df.select(key, F.length(predict).alias("_h"), F.length(label).alias("_r"), gram_hits(predict, label).alias("_g"))
    return rows.select(key, _bleu(F.col("_h"), F.col("_r"), F.col("_g")).alias("bleu_4"))


@batch_udf("int")
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence of two word arrays, one machine word of bits per 64 words."""

    def one(x, y) -> int:
        where: dict = {}
        for i, w in enumerate(x):
            where[w] = where.get(w, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for w in y:
            hit = row & where.get(w, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(x) - row.bit_count()

    return pd.Series([one(x, y) for x, y in zip(a, b)])


def _f1(hit: Column, hyp: Column, ref: Column) -> Column:
    p, r = F.try_divide(hit, hyp), F.try_divide(hit, ref)
    return F.coalesce(F.lit(2.0) * (p * r) / (p + r + F.lit(1e-8)), F.lit(0.0))


def word_grams(w: Column, n: int) -> Column:
    """Distinct n-grams of a word array. The array is zipped with itself shifted: a slice for each gram would copy it each time."""
    cut = w
    for j in range(1, n):
        cut = F.zip_with(cut, F.slice(w, F.lit(j + 1), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.slice(cut, F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(0))))


def _rouge(a: Column, b: Column) -> Column:
    return F.round(_f1(F.size(F.array_intersect(a, b)), F.size(a), F.size(b)) * 100, 4)


def rouge_n(predict: Column, label: Column, n: int) -> Column:
    """F1 of distinct word n-grams in percent; ``predict`` and ``label`` are word arrays."""
    return _rouge(word_grams(predict, n), word_grams(label, n))


def rouge_scores(df: DataFrame, key: str, predict: str = "predict", label: str = "label", lcs: bool = True,
                 segment=words, bleu: bool = False) -> DataFrame:
    """ROUGE-1/2 (and L) per row on words; a side without words scores 0. ``segment`` is the word splitter; ``bleu``: and BLEU-4."""
    rows = df.select(
        key, segment(F.col(predict)).alias("_p"), segment(F.col(label)).alias("_l"),
        *[F.length(predict).alias("_h"), F.length(label).alias("_r"), gram_hits(predict, label).alias("_g")] * bleu,
    )
    sides = [word_grams(F.col(side), n).alias(f"{side}{n}") for n in (1, 2) for side in ("_p", "_l")]
    rows = rows.select("*", *sides, *[lcs_length("_p", "_l").alias("_lcs")] * lcs)
    out = [_rouge(F.col(f"_p{n}"), F.col(f"_l{n}")).alias(f"rouge_{n}") for n in (1, 2)]
    if lcs:
        out.append(F.round(_f1(F.col("_lcs"), F.size("_p"), F.size("_l")) * 100, 4).alias("rouge_l"))
    if bleu:
        out.append(_bleu(F.col("_h"), F.col("_r"), F.col("_g")).alias("bleu_4"))
    return rows.select(key, *out)


def text_scores(df: DataFrame, key: str, predict: str = "predict", label: str = "label", segment=words) -> DataFrame:
    """All scores of a row at once: its two texts are read and moved once."""
    return rouge_scores(df, key, predict, label, True, segment, bleu=True)


def mean_scores(scores: DataFrame, columns: Sequence[str] = ("bleu_4", "rouge_1", "rouge_2", "rouge_l")) -> DataFrame:
    return scores.agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("rows"))


def token_accuracy(df: DataFrame, predictions: str = "predictions", labels: str = "labels") -> DataFrame:
    """Per row: share of supervised positions where the prediction before equals the label."""
    n = F.size(labels)
    pred = F.slice(predictions, F.lit(1), F.greatest(n - 1, F.lit(0)))
    gold = F.slice(labels, F.lit(2), F.greatest(n - 1, F.lit(0)))
    used = F.filter(F.zip_with(pred, gold, lambda p, y: F.struct(p.alias("p"), y.alias("y"))), lambda z: z["y"] != IGNORE_LABEL)
    right = F.size(F.filter(used, lambda z: z["p"] == z["y"]))
    return df.withColumn("token_accuracy", F.try_divide(right, F.size(used)))


def pair_accuracy(df: DataFrame, chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    return df.agg(F.avg((F.col(chosen) > F.col(rejected)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("pairs"))


def mcq_accuracy(df: DataFrame, scores: str = "scores", answer: str = "answer", category: str = "category",
                 letters: str = "ABCD") -> DataFrame:
    """Percent right per category and over all rows (``Average``); the first of equal best scores is the answer."""
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    picked = F.substr(F.lit(letters), best, F.lit(1))
    rows = df.select(F.col(category).alias("category"), (picked == F.col(answer)).alias("_ok"))
    return rows.rollup("category").agg(
        (F.avg(F.col("_ok").cast("double")) * 100).alias("accuracy"), F.count(F.lit(1)).alias("rows"),
        F.grouping("category").alias("_g"),
    ).select(
        F.when(F.col("_g") == 1, F.lit("Average")).otherwise(F.col("category")).alias("category"), "accuracy", "rows"
    )
