"""Row numbers and exact rank picks without sorting any large group in one task.

A plain ``row_number`` over one ordering puts every row (or every row of a hot
group) into one task. Here rows are cut into buckets that follow the order, each
bucket is numbered alone, and bucket offsets come from counts:

* hash order: bucket = the first four hex digits, at most 65,536 counts per group;
* integer order: bucket = key >> 16, at most 65,536 distinct keys per bucket, and
  offsets are summed per key >> 36 first, so no window sees more than 2^20 counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BEFORE = (W.unboundedPreceding, -1)
#: Parts of a bin that holds a wanted rank of fractional values.
PARTS = 65536


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join where null matches null; the right side's key columns are left out."""
    renamed = right.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_k_{k}" for k in keys])


def _group(by: Sequence[str]) -> list:
    return [F.col(b) for b in by] or [F.lit(0)]


def rank_by_hash(df: DataFrame, hash_col: str, by: Sequence[str] = (), tie: Sequence[str] = (),
                 out: str = "ordinal") -> DataFrame:
    """0-based position of each row in the order of a hex digest, within ``by``."""
    by = list(by)
    keyed = df.withColumn("_bucket", F.substring(hash_col, 1, 4))
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*_group(by)).orderBy("_bucket").rowsBetween(*BEFORE)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*by, "_bucket").orderBy(hash_col, *tie)
    numbered = keyed.withColumn("_r", F.row_number().over(inside))
    joined = join_null_safe(numbered, offsets, by + ["_bucket"])
    return joined.withColumn(out, F.col("_offset") + F.col("_r") - 1).drop("_bucket", "_offset", "_r")


def rank_by_int(df: DataFrame, key: str, by: Sequence[str] = (), tie: Sequence[str] = (),
                out: str = "ordinal") -> DataFrame:
    """0-based position of each row in the order of an integer key, within ``by``."""
    by = list(by)
    keyed = df.withColumn("_chunk", F.shiftright(F.col(key).cast("long"), 16))
    counts = (
        keyed.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_zone", F.shiftright("_chunk", 20))
    )
    zones = counts.groupBy(*by, "_zone").agg(F.sum("_n").alias("_zn"))
    before_zone = W.partitionBy(*_group(by)).orderBy("_zone").rowsBetween(*BEFORE)
    zones = zones.select(*by, "_zone", F.coalesce(F.sum("_zn").over(before_zone), F.lit(0)).alias("_zoff"))
    before = W.partitionBy(*by, "_zone").orderBy("_chunk").rowsBetween(*BEFORE)
    counts = counts.withColumn("_coff", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = join_null_safe(counts, zones, by + ["_zone"]).select(
        *by, "_chunk", (F.col("_coff") + F.col("_zoff")).alias("_offset")
    )
    inside = W.partitionBy(*by, "_chunk").orderBy(key, *tie)
    numbered = keyed.withColumn("_r", F.row_number().over(inside))
    joined = join_null_safe(numbered, offsets, by + ["_chunk"])
    return joined.withColumn(out, F.col("_offset") + F.col("_r") - 1).drop("_chunk", "_offset", "_r")


def ceil_rank_plus_one(p: float, n: Column) -> Column:
    """Nearest rank ceil(p*(n+1))-1, kept inside the list."""
    return F.greatest(F.lit(0), F.least(n - 1, F.ceil(F.lit(p) * (n + 1)) - 1))


def ceil_rank(p: float, n: Column) -> Column:
    """Nearest rank ceil(p*n)-1, kept inside the list."""
    return F.greatest(F.lit(0), F.least(n - 1, F.ceil(F.lit(p) * n) - 1))


def floor_rank(p: float, n: Column) -> Column:
    """Rank int(n*p), kept inside the list."""
    return F.least(n - 1, F.floor(n * F.lit(p)))


def _held(bins: DataFrame, cell: Sequence[str]) -> DataFrame:
    """The bins that hold a wanted rank, with the ranks they hold (_want) and the rows before them (_start)."""
    start = F.col("_end") - F.col("_bn")
    hit = F.filter("_want", lambda w: (w["rank"] >= start) & (w["rank"] < F.col("_end")))
    return bins.select(*cell, hit.alias("_want"), start.alias("_start")).where(F.size("_want") > 0)


def pick_ranks(df: DataFrame, by: Sequence[str], value: str, picks: dict, rule, bin_width: float = 1.0) -> DataFrame:
    """Exact order statistics per group: one row per group, one column per entry of ``picks``.

    Pass one counts value bins of ``bin_width`` and keeps the distinct values of the bins that hold a wanted rank; for
    fractional values pass two does the same with those bins cut into PARTS. No task sorts a group or a whole bin of it.
    """
    by = list(by)
    spread = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    ).withColumn("_bin", F.floor(F.col("_v") / F.lit(bin_width)))
    bins = spread.groupBy(*by, "_bin").agg(F.sum("_n").alias("_bn"))
    bins = bins.withColumn("_end", F.sum("_bn").over(W.partitionBy(*_group(by)).orderBy("_bin"))).withColumn(
        "_total", F.sum("_bn").over(W.partitionBy(*_group(by)))
    )
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), rule(p, F.col("_total")).cast("long").alias("rank"))
        for name, p in picks.items()
    ])
    cell = by + ["_bin"]
    targets = _held(bins.withColumn("_want", wanted), cell)
    if dict(df.dtypes)[value].startswith(("float", "double", "decimal")):
        place = (F.col("_v") - F.col("_bin") * F.lit(bin_width)) * F.lit(PARTS / bin_width)
        spread = join_null_safe(spread, targets.select(*cell), cell).withColumn("_part", F.floor(place))
        parts = spread.groupBy(*cell, "_part").agg(F.sum("_n").alias("_bn"))
        ends = F.col("_start") + F.sum("_bn").over(W.partitionBy(*cell).orderBy("_part"))
        targets = _held(join_null_safe(parts, targets, cell).withColumn("_end", ends), cell + ["_part"])
        cell = cell + ["_part"]
    inside = W.partitionBy(*cell).orderBy("_v")
    values = join_null_safe(spread, targets, cell).withColumn(
        "_stop", F.col("_start") + F.sum("_n").over(inside)
    ).withColumn("_first", F.col("_stop") - F.col("_n"))
    found = values.withColumn(
        "_got", F.explode(F.filter("_want", lambda w: (w["rank"] >= F.col("_first")) & (w["rank"] < F.col("_stop"))))
    )
    return found.groupBy(*by).agg(*[
        F.max(F.when(F.col("_got.name") == name, F.col("_v"))).alias(name) for name in picks
    ])
