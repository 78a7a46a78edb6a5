"""A Bloom filter of fixed size as a small table, built and probed by DataFrame operations.

The filter of 2^bits cells is at most 2^bits / 64 rows of 16 bytes however many values it holds, which is what allows its
broadcast. Too small a filter lets more rows through; it never loses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def _words(cells: DataFrame) -> DataFrame:
    one = F.expr("shiftleft(1L, cast(cell & 63 AS INT))")
    return cells.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(one).alias("mask"))


def set_cells(rows: DataFrame, cells: list[Column]) -> DataFrame:
    """(word, mask): the cells that any row hits, 64 in a word."""
    return _words(rows.select(F.explode(F.array(*cells)).alias("cell")))


def repeated_cells(rows: DataFrame, cells: list[Column]) -> DataFrame:
    """(word, mask): the cells that at least two rows hit."""
    hit = rows.select(F.explode(F.array_distinct(F.array(*cells))).alias("cell"))
    return _words(hit.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def in_filter(rows: DataFrame, cells: list[Column], words: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: whether all cells are set."""
    out = rows.withColumn("maybe", F.lit(True))
    for i, cell in enumerate(cells):
        names = [f"_w{i}", f"_m{i}"]
        out = out.withColumn("_cell", cell).join(
            F.broadcast(words.toDF(*names)), F.shiftright("_cell", 6) == F.col(names[0]), "left"
        )
        set_ = F.expr(f"(shiftright(_m{i}, cast(_cell & 63 AS INT)) & 1) = 1")
        out = out.withColumn("maybe", F.col("maybe") & F.coalesce(set_, F.lit(False))).drop("_cell", *names)
    return out
