"""Tables the operators share: written steps, and blocks of large groups."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_blocks(df: DataFrame, keys: Sequence[str], item: str, limit: int) -> DataFrame:
    """Rows of groups of two and more, sorted so that each run of (keys, _a, _b) fits one task.

    A group of up to ``limit`` rows is one run with _a = _b. A larger one is dealt into chunks by the hash of
    ``item``; each pair of chunks is a run, in which ``_mine`` marks the rows of chunk _a and the others belong
    to _b. Every pair of rows of a group meets in at least one run, and no run holds more than about 2 * limit rows.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = df.join(counts, list(keys)).withColumn("_c", F.ceil(F.col("_n") / F.lit(limit)).cast("int"))
    chunk = F.pmod(F.xxhash64(F.col(item), F.lit("chunk")), F.col("_c").cast("long")).cast("int")
    rows = rows.withColumn("_j", chunk).withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
    rows = rows.select(
        *df.columns, F.least("_j", "_x").alias("_a"), F.greatest("_j", "_x").alias("_b"),
        (F.col("_j") <= F.col("_x")).alias("_mine"),
    )
    runs = [*keys, "_a", "_b"]
    return rows.repartition(*runs).sortWithinPartitions(*runs, F.desc("_mine"), item)
