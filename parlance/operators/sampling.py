"""Mixing, sampling and splitting by hash draws: the same rows whatever the partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.hashing import draw, draw_int, draw_uniform
from parlance.functions.ranks import join_null_safe, rank_by_hash, rank_by_int

STRATEGIES = ("concat", "interleave_under", "interleave_over", "interleave_once")


def shuffled(df: DataFrame, key: str, seed, by: Sequence[str] = (), out: str = "ordinal") -> DataFrame:
    """Position of each row in hash order (within ``by``)."""
    rows = df.withColumn("_h", draw(seed, F.col(key)))
    return rank_by_hash(rows, "_h", by, [key], out).drop("_h")


def shuffle(df: DataFrame, key: str, seed) -> DataFrame:
    """Rows in hash order: a range-partitioned sort, no single task sees all rows."""
    return df.withColumn("_h", draw(seed, F.col(key))).orderBy("_h", key).drop("_h")


def shuffle_key(df: DataFrame, key: str, seed, out: str = "shuffle_key") -> DataFrame:
    """The hash only, for streams: a stream has no order contract."""
    return df.withColumn(out, draw(seed, F.col(key)))


def _draws(spark, n: int, probs: Sequence[float], seed) -> DataFrame:
    """(draw, source, pick): which source each draw takes and how many of it came before."""
    u = draw_uniform(seed, F.col("id"))
    total, source = 0.0, F.lit(len(probs) - 1)
    edges = []
    for p in probs[:-1]:
        total += p
        edges.append(total)
    for i in range(len(edges) - 1, -1, -1):
        source = F.when(u < edges[i], F.lit(i)).otherwise(source)
    rows = spark.range(n).select(F.col("id").alias("draw"), source.alias("source"))
    return rank_by_int(rows, "draw", ["source"], out="pick")


def mix(dfs: Sequence[DataFrame], strategy: str = "concat", probs: Sequence[float] | None = None, seed=0,
        key: str | None = None) -> DataFrame:
    """Concat, or interleave by drawn source; then ``draw`` is the row's place and ``source`` its table.

    under: stop when one source is used up. over: stop when all are, shorter ones repeat.
    once: every row once.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown mixing strategy {strategy!r}")
    if len(dfs) == 1:
        return dfs[0]
    if strategy == "concat":
        out = dfs[0]
        for other in dfs[1:]:
            out = out.unionByName(other)
        return out
    if key is None:
        raise ValueError("interleaving needs the row key that fixes the order inside a source")
    probs = list(probs or [1.0 / len(dfs)] * len(dfs))
    sizes = [d.count() for d in dfs]
    if min(sizes) == 0:
        raise ValueError("an empty source cannot be interleaved")
    spark = dfs[0].sparkSession
    if strategy == "interleave_under":
        n = sum(sizes) - len(sizes) + 1
    else:  # enough draws to use up every source: the expected number plus ten deviations
        n = max(math.ceil(s / p + 10 * math.sqrt(s) / p) + 100 for s, p in zip(sizes, probs))
    draws = _draws(spark, n, probs, seed)
    size = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("source") + 1)
    ends = draws.where(F.col("pick") == size - 1).groupBy("source").agg(F.min("draw").alias("end"))
    if strategy == "interleave_under":
        draws = draws.where(F.col("draw") <= ends.agg(F.min("end")).scalar())
    else:
        covered = F.when(F.count(F.lit(1)) == len(dfs), F.max("end")).otherwise(
            F.raise_error(F.lit("too few draws to use up every source"))
        )
        last = ends.agg(covered.alias("end"))
        draws = draws.where(F.col("draw") <= last.scalar())
        if strategy == "interleave_once":
            draws = draws.where(F.col("pick") < size)
    draws = draws.withColumn("row", F.pmod("pick", size))
    parts = [
        rank_by_int(d, key, out="row").withColumn("source", F.lit(i)) for i, d in enumerate(dfs)
    ]
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other)
    return draws.select("draw", "source", "row").join(rows, ["source", "row"]).drop("row")


def sample_n(df: DataFrame, n: int, key: str, seed=0) -> DataFrame:
    """n rows in hash order; when the table is shorter, the rest is drawn again with replacement."""
    total = df.agg(F.count(F.lit(1))).scalar()
    wanted = df.sparkSession.range(n).select(F.col("id").alias("position"))
    again = F.pmod(draw_int(f"{seed}:again", F.col("position")), F.greatest(total, F.lit(1)))
    wanted = wanted.withColumn("ordinal", F.when(F.col("position") < total, F.col("position")).otherwise(again))
    return wanted.join(shuffled(df, key, seed), "ordinal").drop("ordinal")


def head_n(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)


def reweight(df: DataFrame, key: str, size: int | None = None, weight: float | None = None, seed=0) -> DataFrame:
    """With replacement: ``size`` draws of the rows, then int(length * weight) draws of those."""
    n = df.count()
    length, spark = n, df.sparkSession
    hop = None
    if size is not None:
        hop, length = "size", size
    draws = None
    if weight is not None:
        k = int(length * weight)
        draws = spark.range(k).select(F.col("id").alias("position"))
        draws = draws.withColumn("at", F.floor(draw_uniform(f"{seed}:weight", F.col("position")) * length))
        if hop:
            draws = draws.withColumn("at", F.floor(draw_uniform(f"{seed}:size", F.col("at")) * n))
    elif hop:
        draws = spark.range(size).select(F.col("id").alias("position"))
        draws = draws.withColumn("at", F.floor(draw_uniform(f"{seed}:size", F.col("position")) * n))
    else:
        return df
    rows = rank_by_int(df, key, out="at")
    return draws.join(rows, "at").drop("at")


def split(df: DataFrame, val: float, key: str, seed=0, eval_sets: dict[str, DataFrame] | None = None
          ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """({"train": ..}, {"validation": ..}): a count above 1, else a fraction (rounded up)."""
    if eval_sets and val > 1e-6:
        raise ValueError("give either a validation size or evaluation sets, not both")
    if eval_sets:
        return {"train": df}, {f"validation_{name}": d for name, d in eval_sets.items()}
    if val <= 1e-6:
        return {"train": df}, {}
    ranked = shuffled(df, key, seed, out="_o")
    total = df.agg(F.count(F.lit(1))).scalar()
    cut = F.lit(int(val)) if val > 1 else F.ceil(total * F.lit(val))
    return (
        {"train": ranked.where(F.col("_o") >= cut).drop("_o")},
        {"validation": ranked.where(F.col("_o") < cut).drop("_o")},
    )


def holdout(df: DataFrame, n: int, predicate: Column, key: str, seed=0) -> tuple[DataFrame, DataFrame]:
    """(rest, held out): n rows in hash order among those meeting the predicate."""
    ranked = shuffled(df.withColumn("_ok", F.coalesce(predicate, F.lit(False))), key, seed, ["_ok"], out="_o")
    held = F.col("_ok") & (F.col("_o") < n)
    return ranked.where(~held).drop("_ok", "_o"), ranked.where(held).drop("_ok", "_o")


def quota_table(df: DataFrame, n: int, by: str) -> DataFrame:
    """Rows to take per stratum: equal quotas, the remainder to the first strata, shortfall refilled in order."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    order = W.orderBy(by)
    whole = W.partitionBy(F.lit(0))
    counts = counts.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "levels", F.count(F.lit(1)).over(whole)
    )
    quota = F.floor(F.lit(n) / F.col("levels")) + F.when(F.col("place") < F.lit(n) % F.col("levels"), 1).otherwise(0)
    counts = counts.withColumn("quota", quota).withColumn("base", F.least("rows", "quota"))
    counts = counts.withColumn("spare", F.col("rows") - F.col("base")).withColumn(
        "short", F.sum(F.col("quota") - F.col("base")).over(whole)
    )
    before = F.coalesce(F.sum("spare").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("spare"), F.col("short") - before))
    return counts.select(by, (F.col("base") + extra).cast("long").alias("take"))


def stratified(df: DataFrame, n: int, by: str, key: str, seed=0) -> DataFrame:
    takes = quota_table(df, n, by)
    ranked = shuffled(df, key, seed, [by], out="_o")
    return join_null_safe(ranked, takes, [by]).where(F.col("_o") < F.col("take")).drop("_o", "take")


def cap_per_group(df: DataFrame, by: Sequence[str], n: int, key: str, seed=0) -> DataFrame:
    return shuffled(df, key, seed, by, out="_o").where(F.col("_o") < n).drop("_o")


def assign_round_robin(df: DataFrame, by: str, variants: Sequence[str], key: str, seed=0) -> DataFrame:
    """Variants dealt to the rows of a group in turn; each group deals them in its own hash order."""
    dealt = F.array_sort(F.array(*[
        F.struct(draw(seed, F.col(by), F.lit(v)).alias("h"), F.lit(v).alias("v")) for v in variants
    ]))
    ranked = shuffled(df, key, seed, [by], out="_o")
    return ranked.withColumn("variant", F.get(dealt, F.pmod("_o", F.lit(len(variants))).cast("int"))["v"]).drop("_o")


def value_split(df: DataFrame, slot: str = "slot", value: str = "value", held_out: dict | None = None) -> DataFrame:
    """Fixed train/dev/test part of a numeric slot value; multiples of 15 up to 360 stay in train for degrees."""
    held_out = held_out or {"dev": (12, 17, 23, 28), "test": (13, 19, 25, 29)}
    step = F.lit("train")
    for part, values in held_out.items():
        step = F.when(F.col(value).isin(list(values)), part).otherwise(step)
    digest = F.md5(F.concat_ws(":", F.col(slot), F.col(value).cast("string")).cast("binary"))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(10))
    hashed = F.when(bucket < 8, "train").when(bucket == 8, "dev").otherwise("test")
    everyday = (F.col(value) % 15 == 0) & (F.col(value) <= 360)
    return df.withColumn(
        "part", F.when(F.col(slot) == "step", step).when(everyday, F.lit("train")).otherwise(hashed)
    )


def gate(df: DataFrame, rate: float, key: str, seed=0) -> DataFrame:
    return df.where(draw_uniform(seed, F.col(key)) < rate)


def shard(df: DataFrame, n: int, key: str, seed=0) -> DataFrame:
    """``shard`` and ``place`` of each row in hash order; equal shards, the remainder is dropped as the rule demands."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = shuffled(df, key, seed, out="_o")
    return (
        ranked.where(F.col("_o") < total - total % n)
        .withColumn("shard", F.pmod("_o", F.lit(n)).cast("int"))
        .withColumn("place", F.floor(F.col("_o") / n).cast("long")).drop("_o")
    )


def select_rows(df: DataFrame, index, key: str) -> DataFrame:
    """Rows by slice or by a list of ordinals; repeats and order are kept in ``position``."""
    ranked = rank_by_int(df, key, out="_o")
    if isinstance(index, slice):
        start, stop, step = index.indices(df.count())
        place = (F.col("_o") - start) / step
        inside = (F.col("_o") >= start) & (F.col("_o") < stop) if step > 0 else (F.col("_o") <= start) & (F.col("_o") > stop)
        return ranked.where(inside & ((F.col("_o") - start) % abs(step) == 0)).withColumn(
            "position", place.cast("long")
        ).drop("_o")
    if isinstance(index, (list, tuple)):
        n = df.count() if any(i < 0 for i in index) else 0
        rows = [(p, i if i >= 0 else n + i) for p, i in enumerate(index)]
        wanted = df.sparkSession.createDataFrame(rows, "position long, _o long")
        return wanted.join(ranked, "_o").drop("_o")
    raise ValueError(f"cannot select rows by {type(index).__name__}")
