"""A training corpus from ``documents``: toxic ones out, repeated lines out, near-duplicates out, mixed, packed.

Each stage is written as Parquet and read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.ranks import join_null_safe
from parlance.llm import linedup, mixing, packing, simhash, toxicity
from parlance.llm.bloom import BITS, in_filter, set_cells
from parlance.llm.tables import saved, table


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``gone``. Only rows whose id may be among them are shuffled; the rest pass straight.

    Rows travel as one value, so no column of theirs can clash with a name used here. A null id goes if ``gone`` has one.
    """
    gone = saved(gone.select("doc_id").distinct(), "gone")
    cells = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(1 << BITS)) for i in range(2)]
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    marked = in_filter(rows, cells, saved(set_cells(gone, cells), "filter"))
    left = join_null_safe(marked.where("maybe"), gone.withColumn("_gone", F.lit(True)), ["doc_id"], "left").where("_gone IS NULL")
    return marked.where("NOT maybe").select("row.*").unionByName(left.select("row.*"))


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored 0.5 or more go. Null and empty texts stay; an empty table stays empty."""
    return without(docs, toxicity.scores(docs, table(spark, folder, "labels")).where("predicted = 1"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated lines go, and documents that have lost all their lines; n_chars follows the text. Null texts stay."""
    rest = F.struct(*[F.col(c) for c in docs.columns if c not in ("doc_id", "text")]).alias("row")
    kept = linedup.dedup_lines(docs.select("doc_id", "text", rest), equal_from=1)
    left = kept.where("n_dropped = 0 OR trim(text) <> ''")
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": length}
    return left.select(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays, and documents without words."""
    found = simhash.near_duplicates(docs.where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))))
    return without(docs, found.where("doc_id <> component_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_neardup", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither fingerprints, edit joins nor packing; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, folder), f"stage-{name}")
    return docs


