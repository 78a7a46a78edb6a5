"""How filters of documents interact, whatever the order they are applied in; copies are found in radix tries of texts.

Four filters look at a text alone and give a bit each. The fifth fails a text that a smaller id holds as well. For it each
task first inserts the texts it reads into a trie whose terminals hold the smallest id met: all other rows of the text
have failed already, so a text held by a third of all rows leaves a task once. What is left is dealt by ranges of text
prefixes. Prefixes are adaptive: a prefix that more than ``CELL_BYTES`` of different texts begin with is taken four times as long,
until no cell is too large, so the tries of a task can be emptied between cells and its memory is bounded.
Last, the five bits of every document are reduced to at most 32 counts a part, from which all orders follow.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.tables import saved
from parlance.llm.tries import Trie

FILTERS = "ABCDE"
COPY = 16
FIRST_LENGTH, FACTOR, SHOWN = 4, 4, 64
CELL_BYTES = 16 << 20
TRIE_BYTES = 32 << 20
OUT_BYTES = 4 << 20

UPPER = bytes(range(0x41, 0x5B))
INNER = bytes(range(0x80, 0xC0))  # of a character, all UTF-8 bytes but the first
MARKS = re.compile(rb"[#$%&*|]")


def failed_alone(data: bytes) -> int:
    """Bits of the filters that look at one text: few words, few different words, capitals, marks."""
    words = data.split()
    n = len(words)
    capitals = len(data) - len(data.translate(None, UPPER))
    return (
        (n < 200) | (100 * len(set(words)) < 50 * n) << 1
        | (100 * capitals > 2 * len(data.translate(None, INNER))) << 2 | (MARKS.search(data) is not None) << 3
    )


def large_cells(texts: DataFrame, cell_bytes: int = CELL_BYTES) -> list[tuple[int, DataFrame]]:
    """(length, hashes of the prefixes of that length that too many bytes of different, longer texts begin with), by length."""
    rows, length, found = texts, FIRST_LENGTH, []
    while True:
        cell = F.xxhash64(F.substring("text", 1, length))
        sizes = rows.where(F.length("text") > length).groupBy(cell.alias("cell"), F.xxhash64("text").alias("form")).agg(
            F.max(F.octet_length("text")).alias("size")
        ).groupBy("cell").agg(F.sum("size").alias("size"))
        cells = saved(sizes.where(F.col("size") > cell_bytes).select("cell"), "cells")
        if cells.isEmpty():
            return found
        found.append((length, cells))
        # no more cells than the texts have multiples of cell_bytes
        rows = rows.join(F.broadcast(cells), cell == F.col("cell"), "left_semi")
        length *= FACTOR


def with_cells(rows: DataFrame, large: list[tuple[int, DataFrame]]) -> DataFrame:
    """``rows`` with ``cell``: the prefix of ``text`` as long as it takes, shown by its beginning and a hash where it is long."""
    depth = F.lit(FIRST_LENGTH)
    for k, (length, cells) in enumerate(large):
        named = F.broadcast(cells.select(F.col("cell").alias(f"_c{k}")))
        rows = rows.join(named, F.xxhash64(F.substring("text", 1, length)) == F.col(f"_c{k}"), "left")
        depth = F.when(F.col(f"_c{k}").isNotNull(), length * FACTOR).otherwise(depth)
    prefix = F.substr("text", F.lit(1), depth)
    shown = F.concat(F.substring("text", 1, SHOWN), F.lit("\0"), F.hex(F.xxhash64(prefix)))
    return rows.withColumn("cell", F.when(depth <= SHOWN, prefix).otherwise(shown)).drop(*[f"_c{k}" for k in range(len(large))])


class _Rows:
    """Rows on their way out, in batches of bounded size."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]) -> None:
        self.names, self.kinds = names, kinds
        self.columns: list[list] = [[] for _ in names]
        self.size = 0

    def add(self, *values, size: int = 100) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.size += size

    def batch(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size > least:
            arrays = [pa.array(c, k) for c, k in zip(self.columns, self.kinds)]
            self.columns, self.size = [[] for _ in self.names], 0
            yield pa.RecordBatch.from_arrays(arrays, names=self.names)


def _place(key) -> tuple:
    """Order of ids: null comes last."""
    return (key is None, 0 if key is None else key)


def copy_bits(rows: DataFrame) -> DataFrame:
    """(key, part, mask, n) for rows (key, part, text, cell): how often a key has a mask, the bit of copies included."""
    kind = dict(rows.dtypes)["key"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie = None, Trie()

        def emptied() -> Iterator[pa.RecordBatch]:
            for data, node in trie.terminals():
                first, cell, held = node.rows
                for (part, mask), n in held.items():
                    out.add(first, part, mask, n, cell, data, size=100 + len(data))
                yield from out.batch(OUT_BYTES)

        for batch in batches:
            if out is None:
                kinds = [batch.column(0).type, pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
                out = _Rows(["key", "part", "mask", "n", "cell", "text"], kinds)
            for key, part, data, cell in zip(*[c.to_pylist() for c in batch.columns]):
                own = failed_alone(data)
                node = trie.insert(data)
                if node.rows is None:
                    node.rows = (key, cell, {(part, own): 1})
                    continue
                first, _, held = node.rows
                if key == first:
                    held[part, own] = held.get((part, own), 0) + 1
                    continue
                # a row that has failed only travels on: its cell is spread by its key
                gone = [(key, part, 1)]
                if _place(key) < _place(first):
                    gone = [(first, p, n) for (p, _), n in held.items()]
                    node.rows = (key, cell, {(part, own): 1})
                for k, p, n in gone:
                    out.add(k, p, own | COPY, n, f"{zlib.crc32(str(k).encode()):08x}", None)
            yield from out.batch(OUT_BYTES)
            if trie.size > TRIE_BYTES:
                yield from emptied()
                trie = Trie()
        if out is not None:
            yield from emptied()
            yield from out.batch()

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie, last = None, Trie(), None

        def emptied() -> Iterator[pa.RecordBatch]:
            for _, node in trie.terminals():
                least = min(_place(key) for key, *_ in node.rows)
                for key, part, mask, n in node.rows:
                    out.add(key, part, mask | COPY if _place(key) > least else mask, n)
                yield from out.batch(OUT_BYTES)

        for batch in batches:
            if out is None:
                out = _Rows(["key", "part", "mask", "n"], [batch.column(0).type, pa.string(), pa.int32(), pa.int64()])
            for key, part, mask, n, cell, data in zip(*[c.to_pylist() for c in batch.columns]):
                if data is None:
                    out.add(key, part, mask, n)
                    continue
                if cell != last and trie.size > TRIE_BYTES:
                    yield from emptied()
                    trie = Trie()
                last = cell
                node = trie.insert(data)
                if node.rows is None:
                    node.rows = []
                node.rows.append((key, part, mask, n))
            yield from out.batch(OUT_BYTES)
        if out is not None:
            yield from emptied()
            yield from out.batch()

    told = rows.select("key", "part", F.col("text").cast("binary").alias("text"), "cell").mapInArrow(
        local, f"key {kind}, part string, mask int, n long, cell string, text binary"
    )
    dealt = told.repartitionByRange("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(across, f"key {kind}, part string, mask int, n long")


def masks(df: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """(key, part, mask, n): the filters each row fails, as bits in the order of FILTERS; ``n`` rows alike in all of it."""
    rows = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return copy_bits(with_cells(rows, large_cells(rows.select("text"))).select("key", "part", "text", "cell"))


def filter_audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """For each part, each order of the filters and each step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    Null texts are empty texts, null parts the empty part. Of equal texts only those of the smallest key pass the last
    filter; a null key is larger than any other, and rows of equal key do not fail each other. A key with several labels
    counts as good or toxic if one of them says so; a null key has no label. Texts of any length are taken whole. An empty
    table gives no row. No other column is read.
    """
    marks = labels.groupBy(F.col(key).alias("key")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    counts = masks(df, key, part, text).join(marks, "key", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("_m"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before = sum(
        (F.when(F.instr("filter_order", c) < F.col("step"), 1 << i).otherwise(0) for i, c in enumerate(FILTERS)), F.lit(0)
    )
    own = F.lit(0)
    for i, c in enumerate(FILTERS):
        own = F.when(F.substr("filter_order", F.col("step"), F.lit(1)) == c, 1 << i).otherwise(own)
    steps = steps.withColumn("_before", before).withColumn("_own", own)

    def total(keep, value=lambda m: m["n"]):
        return F.aggregate("_m", F.lit(0).cast("long"), lambda sum_, m: sum_ + F.when(keep(m["mask"]), value(m)).otherwise(0))

    fails = lambda mask: mask.bitwiseAND(F.col("_own")) != 0
    earlier = lambda mask: mask.bitwiseAND(F.col("_before")) != 0
    here = lambda mask: fails(mask) & ~earlier(mask)
    # of the filters a document fails, each comes first in the same share of all orders
    all_orders = len(list(permutations(FILTERS)))
    share = lambda m: m["n"] * (F.lit(all_orders) / F.bit_count(m["mask"])).cast("long")
    return steps.select(
        "part", "filter_order", "step", total(lambda m: ~fails(m) & ~earlier(m)).alias("kept"), total(here).alias("removed"),
        total(lambda m: fails(m) & earlier(m)).alias("redundant"), total(lambda m: m == F.col("_own")).alias("unique_fails"),
        total(here, lambda m: m["good"]).alias("good_lost"), total(here, lambda m: m["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )
