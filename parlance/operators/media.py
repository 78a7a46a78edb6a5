"""Media paths against a file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, suffix: str = "*") -> DataFrame:
    """Paths below a folder, relative to it (contents are not read)."""
    base = folder.rstrip("/") + "/"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", suffix)
        .load(folder).select("path")
    )
    plain = F.regexp_replace("path", "^[a-z0-9]+:(//)?", "")
    return listed.select(F.substring_index(plain, base, -1).alias("path"))


def resolve_media(df: DataFrame, files: DataFrame, media_dir: str, column: str, key: str) -> DataFrame:
    """``media_dir/path`` where that file is listed, else the path as it was; flat or nested lists.

    ``key`` identifies a row. Paths are exploded and looked up by an equi join, so the listing may be large.
    """
    nested = df.schema[column].dataType.elementType.simpleString().startswith("array")
    if nested:
        outer = df.select(key, F.posexplode(column).alias("_o", "_list"))
        items = outer.select(key, "_o", F.posexplode("_list").alias("_i", "_path"))
    else:
        items = df.select(key, F.lit(0).alias("_o"), F.posexplode(column).alias("_i", "_path"))
    known = files.select(F.col("path").alias("_path"), F.lit(True).alias("_known")).distinct()
    full = F.concat(F.lit(media_dir.rstrip("/") + "/"), F.col("_path"))
    found = items.join(known, "_path", "left").select(
        key, "_o", "_i", F.when(F.col("_known"), full).otherwise(F.col("_path")).alias("_p")
    )
    lists = found.groupBy(key, "_o").agg(F.array_sort(F.collect_list(F.struct("_i", "_p"))).alias("_l"))
    lists = lists.select(key, "_o", F.transform("_l", lambda x: x["_p"]).alias("_l"))
    if nested:
        lists = lists.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_o", "_l"))).alias("_n"))
        lists = lists.select(key, F.transform("_n", lambda x: x["_l"]).alias("_resolved"))
    else:
        lists = lists.select(key, F.col("_l").alias("_resolved"))
    return df.join(lists, key, "left").withColumn(
        column, F.coalesce("_resolved", F.col(column))
    ).drop("_resolved")
