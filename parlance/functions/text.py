"""Text expressions: normal forms, shapes, character grams, openers, clauses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters and number words that define the normal forms.
EDGE_MARKS = "。.!！？?，,、；;：: \t\n"
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SHAPE_MARKS = "，。！？、,.!?;；:：~～…\"'“”‘’（）()"
SHAPE_NUMBERS = r"[0-9零一二两三四五六七八九十百]+"
OPENER_MARKS = r"(?U)^[\s，,。.!！?？~～…、]+"
CLAUSE_SPLIT = r"[，。！？；,.!?;、\n:：]+|然后|接着|再|and then|then|also"
NON_WORD = r"[^\p{L}\p{N}]+"
TWO_LETTERS = r"[\p{L}\p{N}][^\p{L}\p{N}]*[\p{L}\p{N}]"


def norm_text(col: Column) -> Column:
    """Whitespace removed everywhere, sentence marks removed at both ends."""
    return F.btrim(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?U)\s+", ""), F.lit(EDGE_MARKS))


def shape(col: Column) -> Column:
    """Spaces and marks removed, each run of number signs replaced by one mark."""
    return F.regexp_replace(F.translate(col, SPACES + SHAPE_MARKS, ""), SHAPE_NUMBERS, "#")


def windows(col: Column, n: int) -> Column:
    """All character windows of length n, in order; empty for shorter text. One pass over the text."""
    return F.regexp_extract_all(col, F.lit("(?s)(?=(.{%d}))." % n), F.lit(1))


def gram_set(base: Column, n: int = 2) -> Column:
    """Distinct character grams of a shape; a shorter shape is its own single gram."""
    return F.when(F.length(base) >= n, F.array_distinct(windows(base, n))).otherwise(F.array(base))


def grams(col: Column, n: int = 2) -> Column:
    return gram_set(shape(col), n)


def letters(col: Column) -> Column:
    """The lower-cased letters and digits."""
    return F.regexp_replace(F.lower(col), NON_WORD, "")


def word_bigrams(col: Column) -> Column:
    """Distinct bigrams of the lower-cased letters and digits."""
    return F.array_distinct(windows(F.regexp_replace(F.lower(col), NON_WORD, ""), 2))


def word_bigrams_or_self(col: Column) -> Column:
    """Distinct bigrams of the lower-cased letters and digits; one letter stands for itself."""
    base = F.regexp_replace(F.lower(col), NON_WORD, "")
    return (
        F.when(F.length(base) >= 2, F.array_distinct(windows(base, 2)))
        .when(F.length(base) == 1, F.array(base))
        .otherwise(F.array().cast("array<string>"))
    )


def opener(col: Column) -> Column:
    return F.substring(F.regexp_replace(col, OPENER_MARKS, ""), 1, 2)


def clauses(col: Column) -> Column:
    """Clauses with at least two letters or digits."""
    parts = F.transform(F.split(col, CLAUSE_SPLIT), lambda c: F.btrim(c, F.lit(" \t\r\n 　")))
    return F.filter(parts, lambda c: F.regexp_like(c, F.lit(TWO_LETTERS)))


def words(col: Column) -> Column:
    """Whitespace words, empty ones left out."""
    return F.filter(F.split(col, r"(?U)\s+"), lambda w: w != "")


def count_of(col: Column, needle: str) -> Column:
    """How often a literal occurs (non-overlapping)."""
    return (
        (F.length(col) - F.length(F.replace(col, F.lit(needle), F.lit("")))) / F.lit(len(needle))
    ).cast("int")


def json_string(col: Column) -> Column:
    """A JSON string literal of a text column."""
    listed = F.to_json(F.array(col))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def spaced_json(compact: Column) -> Column:
    """Compact JSON text with a space after each separator outside strings."""
    marked = F.regexp_replace(compact, r'("(?:[^"\\]|\\.)*+")|([,:])', "$1$2\u0001")
    return F.replace(F.replace(marked, F.lit('"\u0001'), F.lit('"')), F.lit("\u0001"), F.lit(" "))


def let(value: Column, body) -> Column:
    """Bind an expression once inside a larger one."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
