"""Counts, length profiles and yield reports over pools and encoded tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.ranks import floor_rank, join_null_safe, pick_ranks, rank_by_int
from parlance.functions.text import let, norm_text, opener, shape
from parlance.model import IGNORE_LABEL
from parlance.operators.nearest import text_slices

#: Counted grams that a task holds until it joins their counts.
HELD_GRAMS = 500_000


def length_cdf(df: DataFrame, length: Column, interval: int) -> DataFrame:
    """Rows below each length step, running and in percent. The window sees one row per step only."""
    steps = df.groupBy((F.floor(length / interval) * interval).alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    run = W.orderBy("length")
    total = F.sum("rows").over(W.partitionBy(F.lit(0)))
    return steps.select(
        "length", "rows", F.sum("rows").over(run).alias("rows_below"),
        (F.sum("rows").over(run) * 100.0 / total).alias("percent_below"),
    )


def length_summary(df: DataFrame, length: str, key: str, cutoff: int, step: int = 1) -> DataFrame:
    """Rank-picked p50/p90/p99, max, mean and rows above the cutoff, on every ``step``-th row in key order.

    ``step`` > 1 is the sampling rule of the report; 1 uses all rows.
    """
    rows = df if step == 1 else rank_by_int(df, key, out="_o").where(F.col("_o") % step == 0)
    one = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.max(length).alias("max"), F.avg(length).alias("mean"),
        F.count_if(F.col(length) > cutoff).alias("over_cutoff"),
    )
    picks = pick_ranks(rows, [], length, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, floor_rank)
    return one.withColumn("_k", F.lit(1)).join(picks.withColumn("_k", F.lit(1)), "_k").drop("_k")


def top_k(df: DataFrame, by: Sequence[str], value: str, k: int, out: str = "rows") -> DataFrame:
    """The k most frequent values per group (ties by value); the rank filter is applied before the shuffle too."""
    return most_frequent(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(out)), by, value, k, out)


def most_frequent(counts: DataFrame, by: Sequence[str], value: str, k: int, out: str) -> DataFrame:
    order = W.partitionBy(*[F.col(b) for b in by] or [F.lit(0)]).orderBy(F.desc(out), value)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pool_profile(df: DataFrame, group: str, cell: str, text: str) -> DataFrame:
    """One row per pool: rows, cells, rows per cell, distinct texts, length median and p90."""
    rows = df.select(group, cell, F.length(text).alias("_len"), F.sha2(norm_text(F.col(text)), 256).alias("_norm"))
    cells = rows.groupBy(group, cell).agg(F.count(F.lit(1)).alias("_n")).groupBy(group).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("cells"), F.min("_n").alias("cell_min"),
        F.percentile("_n", F.lit(0.5)).alias("cell_median"), F.max("_n").alias("cell_max"),
    )
    distinct = rows.groupBy(group, "_norm").agg(F.lit(1).alias("_d")).groupBy(group).agg(
        F.count(F.lit(1)).alias("unique_norm")
    )
    # lengths are few distinct values, so the exact percentile keeps a small count map
    median = rows.groupBy(group).agg(F.percentile("_len", F.lit(0.5)).alias("len_median"))
    p90 = pick_ranks(rows, [group], "_len", {"len_p90": 0.9}, floor_rank)
    out = cells
    for part in (distinct, median, p90):
        out = join_null_safe(out, part, [group])
    return out


def top_openers(df: DataFrame, group: str, text: str, k: int = 6) -> DataFrame:
    return top_k(df.select(group, opener(F.col(text)).alias("opener")), [group], "opener", k)


def top_grams(df: DataFrame, group: str, text: str, n: int = 4, k: int = 8) -> DataFrame:
    """Most frequent shape grams per pool, counted once per row. Counts of a task's texts are joined before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in text_slices(batches):
            held.append(pa.Table.from_arrays(rows_with_gram(batch.column(0), batch.column(1), n), ["group", "gram", "rows"]))
            if sum(t.num_rows for t in held) >= HELD_GRAMS:
                held = [_summed(held)]
                if held[0].num_rows >= HELD_GRAMS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from _summed(held).to_batches()

    shapes = df.select(F.col(group).alias("group"), F.coalesce(shape(F.col(text)), F.lit("")).alias("text"))
    told = shapes.mapInArrow(run, f"group {dict(df.dtypes)[group]}, gram string, rows long")
    counts = told.groupBy(F.col("group").alias(group), "gram").agg(F.sum("rows").alias("rows"))
    return most_frequent(counts, [group], "gram", k, "rows")


def _summed(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).combine_chunks()
    return whole.group_by(["group", "gram"]).aggregate([("rows", "sum")]).rename_columns(["group", "gram", "rows"])


def rows_with_gram(groups: pa.Array, texts: pa.Array, n: int) -> list[pa.Array]:
    """(group, gram, rows): in how many of a group's texts each of their windows of n characters stands."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype="<u4")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    inside, ends = np.ones(len(points) + 1, dtype=bool), np.cumsum(lengths)
    for i in range(1, n):
        inside[np.maximum(ends - i, ends - lengths)] = False
    inside[len(points)] = False
    # an empty text's end is the next one's start
    filled = lengths >= n
    inside[(ends - lengths)[filled]] = True
    at = np.flatnonzero(inside)
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - n + 1, 0))
    met = np.zeros(0x110000, dtype=bool)
    met[points] = True
    letters = np.flatnonzero(met)
    number = np.zeros(0x110000, dtype=np.int64)
    number[letters] = np.arange(len(letters))
    numbers, bits = number[points], max(1, (len(letters) - 1).bit_length())

    def spelled(codes: np.ndarray, start: np.ndarray, more: int) -> np.ndarray:
        last = [letters[codes >> bits * i & (1 << bits) - 1] for i in reversed(range(more))]
        return np.column_stack([start[codes >> bits * more], *last])

    # a gram's letters follow each other in one number; where that grows too large, the grams so far are numbered anew
    room = 63 - max(1, len(lengths).bit_length())
    codes, start, more, size = np.zeros(len(at), dtype=np.int64), np.zeros((1, 0), dtype=np.int64), 0, 0
    for i in range(n):
        if size + bits > room:
            seen, codes = np.unique(codes, return_inverse=True)
            start, more, size = spelled(seen, start, more), 0, len(seen).bit_length()
        codes = codes << bits | numbers[at + i]
        more, size = more + 1, size + bits
    once = np.sort(row << size | codes)
    once = once[np.append(True, once[1:] != once[:-1])[:len(once)]]
    pool = groups.dictionary_encode(null_encoding="encode")
    own = pool.indices.to_numpy().astype(np.int64)[once >> size]
    found, rows = np.unique(own << size | once & (1 << size) - 1, return_counts=True)
    text = spelled(found & (1 << size) - 1, start, more).astype("<u4").tobytes().decode("utf-32-le")
    grams = [text[i:i + n] for i in range(0, len(text), n)]
    return [pool.dictionary.take(pa.array(found >> size)), pa.array(grams, pa.string()), pa.array(rows)]


def label_counts(df: DataFrame, group: str, label: str) -> DataFrame:
    return df.groupBy(group, label).agg(F.count(F.lit(1)).alias("rows"))


def yield_by_dimension(accepted: DataFrame, rejected: DataFrame, dimensions: Sequence[str], novel: str = "novel"
                       ) -> DataFrame:
    """Valid, novel and reject rates per value of each dimension; a missing value counts under "-"."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.coalesce(F.nullif(F.col(d).cast("string"), F.lit("")), F.lit("-")).alias("value"))
        for d in dimensions
    ])).alias("_p")
    good = accepted.select(pairs, F.col(novel).alias("_n")).groupBy("_p.dimension", "_p.value").agg(
        F.count(F.lit(1)).alias("valid"), F.count_if("_n").alias("_novel")
    )
    bad = rejected.select(pairs).groupBy("_p.dimension", "_p.value").agg(F.count(F.lit(1)).alias("rejected"))
    both = good.join(bad, ["dimension", "value"], "full")
    valid, lost = F.coalesce("valid", F.lit(0)), F.coalesce("rejected", F.lit(0))
    return both.select(
        "dimension", "value", valid.alias("valid"),
        F.when(valid > 0, F.round(F.coalesce("_novel", F.lit(0)) / valid, 3)).otherwise(F.lit(0.0)).alias("novel_rate"),
        F.round(lost / (lost + valid), 3).alias("reject_rate"),
    )


def saturation(df: DataFrame, min_novel: int, patience: int, cell: str = "cell", round_: str = "round",
               valid: str = "new_valid", novel: str = "new_novel") -> DataFrame:
    """Growth curve per cell with its stop round: ``patience`` rounds in a row below ``min_novel``.

    ``stopped`` marks the first such round; later rounds have ``after_stop``.
    """
    order = W.partitionBy(cell).orderBy(round_)
    loud = F.when(F.col(novel) >= min_novel, 1).otherwise(0)
    rows = df.withColumn("valid_total", F.sum(valid).over(order)).withColumn("novel_total", F.sum(novel).over(order))
    rows = rows.withColumn("_island", F.sum(loud).over(order))
    # a loud round opens an island; quiet rounds before the first loud one form island 0
    inside = W.partitionBy(cell, "_island").orderBy(round_)
    quiet = F.sum(1 - loud).over(inside)
    rows = rows.withColumn("quiet", quiet).withColumn("_hit", F.col("quiet") >= patience)
    first = F.min(F.when(F.col("_hit"), F.col(round_))).over(W.partitionBy(cell))
    rows = rows.withColumn("_stop", first)
    return rows.withColumn("stopped", F.coalesce(F.col(round_) == F.col("_stop"), F.lit(False))).withColumn(
        "after_stop", F.coalesce(F.col(round_) > F.col("_stop"), F.lit(False))
    ).drop("_island", "_hit", "_stop")


def lr_hint(df: DataFrame, cutoff: int, batch_size: int, base_lr: float = 3e-4, base_batch: int = 4_000_000,
            divide: float = 1.0, labels: str = "labels") -> DataFrame:
    """One row: valid-token ratio of padded batches, tokens per step, learning rate ~ sqrt(tokens)."""
    one = df.agg(
        F.sum(F.size(F.filter(labels, lambda x: x != IGNORE_LABEL))).alias("valid_tokens"),
        F.sum(F.size(labels)).alias("total_tokens"),
    )
    ratio = F.col("valid_tokens") / F.col("total_tokens")
    tokens = F.lit(float(cutoff * batch_size)) * ratio
    return one.select(
        "valid_tokens", "total_tokens", ratio.alias("valid_ratio"), tokens.alias("token_batch_size"),
        (F.lit(base_lr) * F.sqrt(tokens / base_batch) / divide).alias("learning_rate"),
    )


def composition(df: DataFrame, scalars: Sequence[str] = (), lists: Sequence[str] = ()) -> DataFrame:
    """(facet, value, rows): scalar facets by grouping sets, each list facet over its exploded values."""
    out = None
    if scalars:
        sets = df.groupingSets([[F.col(c)] for c in scalars], *[F.col(c) for c in scalars]).agg(
            F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("_g")
        )
        n = len(scalars)
        facet, value = F.lit(None).cast("string"), F.lit(None).cast("string")
        for i, c in enumerate(scalars):
            mine = F.col("_g") == (2**n - 1) - 2 ** (n - 1 - i)
            facet = F.when(mine, F.lit(c)).otherwise(facet)
            value = F.when(mine, F.col(c).cast("string")).otherwise(value)
        out = sets.select(facet.alias("facet"), value.alias("value"), "rows")
    for c in lists:
        part = df.select(F.explode(c).alias("value")).groupBy(F.col("value").cast("string").alias("value")).agg(
            F.count(F.lit(1)).alias("rows")
        ).select(F.lit(c).alias("facet"), "value", "rows")
        out = part if out is None else out.unionByName(part)
    return out


def reject_report(asked: DataFrame, accepted: DataFrame, rejected: DataFrame, by: str = "flip",
                  reason: str = "reason", k: int = 3) -> DataFrame:
    """Asked and valid counts with the k most frequent reject reasons per group."""
    a = asked.groupBy(by).agg(F.count(F.lit(1)).alias("asked"))
    v = accepted.groupBy(by).agg(F.count(F.lit(1)).alias("valid"))
    top = top_k(rejected.select(by, reason), [by], reason, k).groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.concat(F.col(reason), F.lit(":"), F.col("rows")).alias("t")))).alias("_t")
    ).select(by, F.array_join(F.transform("_t", lambda t: t["t"]), ", ").alias("top_rejects"))
    out = join_null_safe(join_null_safe(a, v, [by], "left"), top, [by], "left")
    return out.select(
        by, "asked", F.coalesce("valid", F.lit(0)).alias("valid"), F.coalesce("top_rejects", F.lit("")).alias("top_rejects")
    )


def perplexity(df: DataFrame, losses: str = "token_losses", labels: str | None = None) -> DataFrame:
    """Per row: exp of the mean token loss over supervised positions (all positions without labels)."""
    if labels:
        kept = F.filter(
            F.arrays_zip(F.col(losses).alias("l"), F.col(labels).alias("y")), lambda z: z["y"] != IGNORE_LABEL
        )
        values = F.transform(kept, lambda z: z["l"].cast("double"))
    else:
        values = F.transform(losses, lambda x: x.cast("double"))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("perplexity", F.exp(F.try_divide(total, F.size(values))))


def mean_perplexity(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("perplexity").alias("mean_perplexity"), F.count("perplexity").alias("rows"))


def tokens_per_second(df: DataFrame, epochs: float, runtime: float, ranks: int = 1, stage: str = "sft") -> DataFrame:
    columns = ["input_ids"] if stage == "sft" else ["chosen_input_ids", "rejected_input_ids"]
    total = sum((F.size(c) for c in columns[1:]), F.size(columns[0]))
    return df.agg(F.sum(total).alias("tokens")).withColumn(
        "tokens_per_second", F.col("tokens") * F.lit(float(epochs)) / F.lit(float(runtime)) / F.lit(ranks)
    )


EMA_CHUNK = 4096


def ema(df: DataFrame, by: str, order: str, value: str, out: str = "smoothed") -> DataFrame:
    """Smoothed series per run: the weight of the past grows with the series length.

    The recurrence is linear, so a run is cut into chunks of consecutive points: each chunk is folded from zero, the
    value carried into it comes from the chunk ends, and its share w^(i+1) is added. No task sees a whole run.
    ``order`` is an integer step.
    """
    ranked = rank_by_int(df.select(by, order, F.col(value).cast("double").alias(value)), order, [by], out="_o")
    ranked = ranked.withColumn("_c", F.floor(F.col("_o") / EMA_CHUNK).cast("int"))
    lengths = ranked.groupBy(by).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("_o", value))[value].alias("_v0")
    )
    weight = F.lit(1.8) * (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-0.05) * F.col("_n"))) - F.lit(0.5))
    lengths = lengths.withColumn("_w", weight).drop("_n")
    points = ranked.groupBy(by, "_c").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_o"), F.col(order).alias("o"), F.col(value).alias("v")))).alias("_p")
    )
    points = join_null_safe(points, lengths, [by])
    start = F.struct(F.lit(0.0).alias("last"), F.array().cast("array<double>").alias("done"))

    def fold(w: Column) -> Column:
        return F.aggregate(
            "_p", start,
            lambda s, p: let(s["last"] * w + (F.lit(1.0) - w) * p["v"], lambda x: F.struct(
                x.alias("last"), F.array_append(s["done"], x).alias("done")
            )),
            lambda s: s["done"],
        )

    points = points.withColumn("_s", fold(F.col("_w")))
    ends = points.select(by, "_w", "_v0", F.struct(
        F.col("_c").alias("c"), F.size("_p").alias("n"), F.element_at("_s", -1).alias("e")
    ).alias("_e"))
    ends = ends.groupBy(by).agg(F.array_sort(F.collect_list("_e")).alias("_e"), F.first("_w").alias("_w"), F.first("_v0").alias("_v0"))
    carry_type = "array<struct<c:int,carry:double>>"
    carried = F.aggregate(
        "_e", F.struct(F.col("_v0").alias("x"), F.array().cast(carry_type).alias("all")),
        lambda s, e: F.struct(
            (e["e"] + F.pow(F.col("_w"), e["n"]) * s["x"]).alias("x"),
            F.array_append(s["all"], F.struct(e["c"].alias("c"), s["x"].alias("carry"))).alias("all"),
        ),
        lambda s: s["all"],
    )
    carries = ends.select(by, F.explode(carried).alias("_k")).select(by, F.col("_k.c").alias("_c"), F.col("_k.carry").alias("_carry"))
    rows = join_null_safe(points, carries, [by, "_c"])
    rows = rows.select(by, "_w", "_carry", F.posexplode(F.arrays_zip(F.col("_p").alias("p"), F.col("_s").alias("s"))).alias("_i", "_z"))
    return rows.select(
        by, F.col("_z.p.o").alias(order), F.col("_z.p.v").alias(value),
        (F.col("_z.s") + F.pow(F.col("_w"), F.col("_i") + 1) * F.col("_carry")).alias(out),
    )
