"""Exact duplicates in two passes over a Bloom filter, in DataFrame operations only.

Pass one sets two cells of a filter of 2^bits cells per text and counts its hits; the cells hit at least twice are
the filter of possibly repeated texts. It has a fixed size however large the input is (2^bits / 64 words of 16 bytes, at
the default 4 MB), which is what allows its broadcast. Pass two sends only rows all of whose cells are in the filter
through a shuffle; the rest pass straight through. A filter that is too small lets more rows through, never a wrong
result: take bits so that 2^bits is at least eight times the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.bloom import BITS, in_filter, repeated_cells
from parlance.llm.tables import saved


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row per row of ``df``: key, keep_id, group_size, kept, text_sha256 of the normalised text.

    Null texts count as empty and equal empty ones. Of rows with equal text and equal key exactly one is kept. Null keys
    come after all others; a group of null keys only keeps one of them, with keep_id null. Other columns are not read.
    """
    digest = F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256))
    rows = saved(df.select(F.col(key).alias("id"), digest.alias("sha")), "digests")
    cells = [
        F.conv(F.hex(F.substring("sha", 1 + 8 * i, 7)), 16, 10).cast("long").bitwiseAND(F.lit((1 << bits) - 1))
        for i in range(2)
    ]
    words = saved(repeated_cells(rows, cells), "filter")
    marked = in_filter(rows, cells, words)
    alone = marked.where("NOT maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    same = saved(marked.where("maybe").groupBy("sha", "id").agg(F.count(F.lit(1)).alias("copies")), "suspects")
    # written, so that the join below has two plain inputs and a group of many rows can be split
    groups = saved(same.groupBy("sha").agg(F.min("id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    met = same.join(groups, "sha").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"), "sha"
    )
    return alone.unionByName(met).select(
        F.col("id").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )
