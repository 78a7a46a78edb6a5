"""Turn tables and dialogue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_dialogues(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                      content: str = "text", out: str = "messages") -> DataFrame:
    """One row per dialogue, its turns in order."""
    turn = F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(content).alias("content"))
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    return rows.select(
        key, F.transform("_t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias(out)
    )


def turns(df: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """The inverse: one row per turn with its position."""
    return df.select(key, F.posexplode(messages).alias("turn", "_m")).select(
        key, "turn", F.col("_m.role").alias("role"), F.col("_m.content").alias("content")
    )
