"""Sources mixed to target weights by entropy balancing, in DataFrame operations only.

A source's share of the mix is a number of words. Each document gets a rate, the copies it is expected to be taken, as
near to one each as the relative entropy allows, so that the rates times the sizes meet the source's target and none is
above ``most``: rate = min(most, exp(tilt * size / mean size)). The tilts solve the convex dual, one equation per
source, by Newton steps over the histogram of sizes, safeguarded by the brackets that the extreme rates give. Rates are
then rounded into whole copies: the whole part, and one more for documents in a seeded weighted order up to the words
that are missing.

No step collects sources or documents: a source with a third of all rows is a number of histogram rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.ranks import join_null_safe
from parlance.llm.tables import saved

ROUNDS = 60
CLOSE = 1e-7
BINS = 4096
FILLS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in code point order, null last. Counted by ranges: no task sees all sources."""
    placed = saved(
        sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()), "sources"
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # as many rows as partitions
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return placed.withColumn("r", F.row_number().over(inside)).join(offsets, "part").select(
        *sources.columns, (F.col("before") + F.col("r") - 1).alias("rank")
    )


def targets(sources: DataFrame, weights: tuple[float, ...], total: float, most: float) -> DataFrame:
    """(source, source_size, target): shares by weight of ``total`` times all sizes, at most ``most`` times a source's own.

    What the bound cuts off is shared again by weight among the rest until none is above; a round caps at least one
    source or ends, and the number of rounds is that of distinct ratios of size to weight in the worst case.
    """
    weight = reduce(
        lambda rest, iw: F.when(F.col("rank") % len(weights) == iw[0], F.lit(float(iw[1]))).otherwise(rest),
        list(enumerate(weights)), F.lit(0.0),
    )
    open_ = saved(
        source_ranks(sources).select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")), "shares"
    )
    wanted = (open_.agg(F.sum("source_size")).first()[0] or 0) * total
    while True:
        row = open_.agg(
            F.sum(F.when(F.col("full"), F.col("source_size") * most)).alias("given"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weights"),
        ).first()
        unit = (wanted - (row["given"] or 0)) / row["weights"] if row["weights"] else 0.0
        above = ~F.col("full") & (F.col("weight") * F.lit(unit) > F.col("source_size") * most)
        if open_.where(above).isEmpty():
            return open_.select("source", "source_size", F.when(
                F.col("full"), (F.col("source_size") * most).cast("double")
            ).otherwise(F.col("weight") * F.lit(unit)).alias("target"))
        open_ = saved(open_.withColumn("full", F.col("full") | above), "shares")


def tilts(histogram: DataFrame, goals: DataFrame, most: float) -> DataFrame:
    """(source, mean, tilt) with sum of n * size * min(most, exp(tilt * size / mean)) = target for every source.

    One aggregate of the histogram (source, size, n) per Newton step, for all sources at once; a step that would leave
    the bracket halves it instead.
    """
    facts = histogram.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    smallest = F.col("least") / F.col("mean")
    ratio = F.col("target") / F.col("source_size")
    state = join_null_safe(goals, facts, ["source"]).select(
        "source", "source_size", "target", "mean", F.lit(0.0).alias("tilt"),
        F.when(ratio >= 1, F.lit(0.0)).otherwise(F.log(ratio) / smallest).alias("low"),
        F.when(ratio <= 1, F.lit(0.0)).otherwise(F.log(F.lit(float(most))) / smallest).alias("high"),
    )
    state = saved(state.withColumn("tilt", F.when(F.col("target") >= most * F.col("source_size"), F.col("high")).otherwise(
        F.col("tilt")
    )), "tilts")
    for _ in range(ROUNDS):
        each = join_null_safe(histogram, state, ["source"])
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * z, F.log(F.lit(float(most)))))
        bent = F.when(F.col("tilt") * z < F.log(F.lit(float(most))), F.col("n") * F.col("size") * z * rate).otherwise(0.0)
        sums = each.groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("value"), F.sum(bent).alias("slope")
        )
        met = join_null_safe(state, sums, ["source"]).withColumn("off", F.col("value") - F.col("target"))
        done = F.abs(F.col("off")) <= CLOSE * F.col("target")
        met = met.withColumn("low", F.when(F.col("off") < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn(
            "high", F.when(F.col("off") > 0, F.col("tilt")).otherwise(F.col("high"))
        )
        step = F.col("tilt") - F.col("off") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        moved = F.when(done, F.col("tilt")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2)
        state = saved(met.select(
            "source", "source_size", "target", "mean", moved.alias("tilt"), "low", "high", (~done).alias("open")
        ), "tilts")
        if state.where("open").isEmpty():
            break
    # sums of doubles come in any order; rounding keeps what follows the same in every run
    return state.select("source", "mean", F.round("tilt", 10).alias("tilt"))


def copies(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           weights: tuple[float, ...] = (3, 1, 2), total: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """One row per row of ``df``: key, size, source_size, target, copies, taken (copies * size).

    Sizes are words; a null text has 0 and is never taken. Null is a source of its own, the last. The draw depends on
    (seed, source, key, size), so reruns agree; rows equal in all of these are drawn alike only in their order. A source
    without words has target 0. Other columns are not read. Empty table: empty result.
    """
    docs = saved(
        df.select(F.col(key).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sizes"
    )
    histogram = saved(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = saved(targets(sources, weights, total, most), "targets")
    solved = tilts(histogram.where("size > 0"), goals.where("source_size > 0 AND target > 0"), most)
    known = saved(join_null_safe(goals, solved, ["source"], "left"), "solved")
    rated = join_null_safe(docs, known, ["source"]).withColumn("rate", F.when(F.col("size") > 0, F.coalesce(
        F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.log(F.lit(float(most))))), F.lit(0.0)
    )).otherwise(0.0))
    near_most = F.when(F.col("rate") >= most - 1e-9, F.lit(float(most))).otherwise(F.col("rate"))
    rated = rated.withColumn("whole", F.floor(near_most).cast("long")).withColumn("part", near_most - F.floor(near_most))
    draw = (F.pmod(F.xxhash64(F.lit(seed), "source", "id", "size"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    # extra copies go by draw ** (1 / part), largest first; the order is cut into bins whose words are counted
    order = F.when(F.col("part") > 0, -F.log(draw) / F.col("part"))
    rated = rated.withColumn("order", order).withColumn(
        "bin", F.when(F.col("part") > 0, F.floor(F.lit(BINS) * (1 - F.exp(-F.col("order")))).cast("int"))
    )
    chosen = saved(rated.withColumn("extra", F.lit(0).cast("long")), "chosen")
    for last in [False] * (FILLS - 1) + [True]:
        chosen = saved(_fill(chosen, last), "chosen")
    taken = F.col("whole") + F.col("extra")
    return chosen.select(
        F.col("id").alias(key), "size", "source_size", "target", taken.alias("copies"), (taken * F.col("size")).alias("taken")
    )


def _fill(chosen: DataFrame, last: bool) -> DataFrame:
    """One more copy of documents that fit into what their source still lacks, in order up to the first that does not.

    The order is cut into bins; whole bins are taken by their sums, and only the bin in which the words run out is
    ordered row by row. The last call also takes that document if this brings the source nearer.
    """
    words = (F.col("whole") + F.col("extra")) * F.col("size")
    lacking = chosen.groupBy("source").agg((F.max("target") - F.sum(words)).alias("gap"))
    met = join_null_safe(chosen, lacking, ["source"])
    fits = F.coalesce(
        (F.col("part") > 0) & (F.col("extra") == 0) & (F.col("size") <= F.col("gap") * (2 if last else 1)), F.lit(False)
    )
    upto = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = met.where(fits).groupBy("source", "bin").agg(F.sum("size").alias("words")).withColumn(
        "before", F.coalesce(F.sum("words").over(upto), F.lit(0))
    )
    placed = join_null_safe(met.where(fits), bins, ["source", "bin"])
    sure = F.col("before") + F.col("words") <= F.col("gap")
    edge = ~sure & (F.col("before") < F.col("gap"))
    settled = placed.where(~edge).withColumn("extra", sure.cast("long"))
    run = W.partitionBy("source", "bin").orderBy("order", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    over = F.col("before") + F.sum("size").over(run) - (F.col("size") / 2 if last else 0)
    cut = placed.where(edge).withColumn("_over", over).withColumn("extra", (F.col("_over") <= F.col("gap")).cast("long"))
    names = chosen.columns
    return met.where(~fits).select(*names).unionByName(settled.select(*names)).unionByName(cut.select(*names))


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them. Rows of equal key are taken alike, by the first of them."""
    taken = copies(df, key, text, source, **options).groupBy(key).agg(F.max("copies").alias("_copies")).where("_copies > 0")
    joined = join_null_safe(df, taken.hint("merge"), [key])  # one row per document on either side at any size
    return joined.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*df.columns)
