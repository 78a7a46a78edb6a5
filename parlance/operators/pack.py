"""Batches and packs. Groups are bounded batches (``batch_id``, 1000 rows by default); budget batches run over the whole order."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.ranks import rank_by_int
from parlance.model import IGNORE_LABEL, MAX_SUB_SEQUENCE
from parlance.operators.ordered import RANGE_ROWS, budget_batches

BATCH_ROWS = 1000


def with_batches(df: DataFrame, key: str, rows: int = BATCH_ROWS, by=()) -> DataFrame:
    """``ordinal`` in key order and ``batch_id`` of ``rows`` consecutive rows."""
    return rank_by_int(df, key, by).withColumn("batch_id", F.floor(F.col("ordinal") / rows).cast("long"))


def chunk_pt(df: DataFrame, block: int, batch: str = "batch_id", order: str = "ordinal", ids: str = "input_ids",
             bos_id: int | None = None) -> DataFrame:
    """Token streams of a batch cut into full blocks; the rest of a batch is dropped, as the rule demands.

    Rows are cut at block borders, so only slices move, never single tokens.
    """
    running = W.partitionBy(batch).orderBy(order)
    rows = df.select(batch, order, ids).withColumn("_end", F.sum(F.size(ids)).over(running))
    rows = rows.withColumn("_start", F.col("_end") - F.size(ids)).where(F.size(ids) > 0)
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)
    parts = rows.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("_start"), F.col("block") * block)
    high = F.least(F.col("_end"), (F.col("block") + 1) * block)
    piece = F.slice(ids, (low - F.col("_start") + 1).cast("int"), (high - low).cast("int"))
    blocks = parts.select(batch, "block", F.struct(F.col(order).alias("o"), piece.alias("p")).alias("_s"))
    blocks = blocks.groupBy(batch, "block").agg(F.array_sort(F.collect_list("_s")).alias("_s"))
    whole = blocks.select(batch, "block", F.flatten(F.transform("_s", lambda s: s["p"])).alias(ids))
    whole = whole.where(F.size(ids) == block)
    if bos_id is not None:
        whole = whole.withColumn(ids, F.concat(F.array(F.lit(bos_id)), F.slice(ids, 2, max(block - 1, 1))))
    return whole


def plan_packs(lengths, capacity: int) -> list[tuple[int, int]]:
    """(pack, slot) per row: each pack repeatedly takes the largest length that still fits, the latest row first."""
    free = sorted((int(n), i) for i, n in enumerate(lengths))
    placed = [(0, 0)] * len(free)
    pack = 0
    while free:
        room, slot = capacity, 0
        while True:
            at = bisect_right(free, (room, len(placed))) - 1
            if at < 0:
                break
            length, row = free.pop(at)
            placed[row] = (pack, slot)
            room -= length
            slot += 1
        if slot == 0:
            raise ValueError("a row is longer than the capacity")
        pack += 1
    return placed


def pack(df: DataFrame, capacity: int, key: str, batch: str = "batch_id", order: str = "ordinal",
         ids: str = "input_ids") -> DataFrame:
    """Rows with ``pack_id`` and ``slot``. Only (key, length) enters Python; over-long rows are dropped first."""
    fits = df.where(F.size(ids) <= capacity)
    kind = fits.schema[key].dataType.simpleString()

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        placed = plan_packs(pdf["length"], capacity)
        return pd.DataFrame({
            "batch": pdf["batch"].to_numpy(), "key": pdf["key"].to_numpy(),
            "pack_id": [p for p, _ in placed], "slot": [s for _, s in placed],
        })

    slim = fits.select(
        F.col(batch).cast("long").alias("batch"), F.col(key).alias("key"), F.col(order).alias("seq"),
        F.size(ids).alias("length"),
    )
    plan = slim.groupBy("batch").applyInPandas(assign, f"batch long, key {kind}, pack_id long, slot int")
    plan = plan.select(F.col("batch").alias(batch), F.col("key").alias(key), "pack_id", "slot")
    return fits.join(plan, [batch, key])


def assemble_packs(df: DataFrame, capacity: int, neat: bool = False, batch: str = "batch_id", pad_id: int = 0,
                   ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """One row per pack, padded to capacity + 1: positions restart, the mask is the sub-sequence number or 1."""
    media = [m for m in ("images", "videos", "audios") if m in df.columns]
    part = F.struct(
        "slot", F.col(ids).alias("ids"), F.col(labels).alias("labels"),
        *[F.coalesce(F.col(m), F.array().cast("array<string>")).alias(m) for m in media],
    )
    packs = df.groupBy(batch, "pack_id").agg(F.array_sort(F.collect_list(part)).alias("_s"))
    packs = packs.withColumn("_len", F.aggregate("_s", F.lit(0), lambda n, s: n + F.size(s["ids"]))).withColumn(
        "_pad", F.lit(capacity + 1) - F.col("_len")
    )
    zeros = F.array_repeat(F.lit(0), F.col("_pad"))
    count_up = lambda n: F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    mask = F.transform(
        "_s", lambda s: F.array_repeat(s["slot"] + 1 if neat else F.lit(1), F.size(s["ids"]))
    )
    out = {
        "input_ids": F.concat(F.flatten(F.transform("_s", lambda s: s["ids"])), F.array_repeat(F.lit(pad_id), F.col("_pad"))),
        "labels": F.concat(
            F.flatten(F.transform("_s", lambda s: s["labels"])), F.array_repeat(F.lit(IGNORE_LABEL), F.col("_pad"))
        ),
        "position_ids": F.concat(F.flatten(F.transform("_s", lambda s: count_up(F.size(s["ids"])))), zeros),
        "attention_mask": F.concat(F.flatten(mask), F.array_repeat(F.lit(0 if neat else 1), F.col("_pad"))),
    }
    for m in media:
        listed = F.flatten(F.transform("_s", lambda s: s[m]))
        out[m] = F.when(F.size(listed) > 0, listed)
    if neat:
        ends = F.aggregate(
            "_s", F.array(F.lit(0)),
            lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + F.size(s["ids"]))),
        )
        out["sequence_boundaries"] = F.concat(ends, F.array(F.lit(capacity + 1)))
        out["right_padding_length"] = F.col("_pad")
        for m in media:
            owners = F.flatten(F.transform("_s", lambda s: F.array_repeat(s["slot"].cast("long"), F.size(s[m]))))
            out[f"{m[:-1]}_subseq_ids"] = F.when(F.size(owners) > 0, owners).otherwise(
                F.array(F.lit(MAX_SUB_SEQUENCE).cast("long"))
            )
    return packs.select(batch, "pack_id", *[c.alias(n) for n, c in out.items()])


def dynamic_batches(df: DataFrame, cutoff: int, micro_batch_size: int, key: str, ids: str = "input_ids",
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """Batches in key order whose padded size (longest row times rows) stays within cutoff * micro_batch_size.

    Numbered over the whole table with no restart; the last batch of all is marked ``complete = false`` unless it has
    reached the budget (a loader does not emit it), and no row is lost.
    """
    return budget_batches(df, key, F.least(F.size(ids), F.lit(cutoff)), cutoff * micro_batch_size, True, range_rows)


def token_batches(df: DataFrame, cutoff: int, micro_batch_size: int, key: str, ids: str = "input_ids",
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """Batches in key order whose summed length stays within the budget; closed by the first row that does not fit, so the last
    one is never complete."""
    return budget_batches(df, key, F.least(F.size(ids), F.lit(cutoff)), cutoff * micro_batch_size, False, range_rows)


def concat_batches(df: DataFrame, cutoff: int, batch: str = "batch_id", order: str = "ordinal") -> DataFrame:
    """Rows of a batch joined into one sequence; the first label and weight of each later row are masked."""
    rows = df.withColumn("_i", F.row_number().over(W.partitionBy(batch).orderBy(order)) - 1).where(
        F.size("input_ids") > 0
    )
    cut = {c: F.slice(F.col(c), 1, cutoff) for c in ("input_ids", "labels", "loss_weights") if c in df.columns}
    for name, blank in (("labels", F.lit(IGNORE_LABEL)), ("loss_weights", F.lit(0.0))):
        if name in cut:
            cut[name] = F.transform(
                cut[name], lambda x, k: F.when((F.col("_i") > 0) & (k == 0), blank).otherwise(x)
            )
    part = F.struct("_i", *[c.alias(n) for n, c in cut.items()])
    packed = rows.groupBy(batch).agg(F.array_sort(F.collect_list(part)).alias("_s"))
    out = [F.flatten(F.transform("_s", lambda s: s[n])).alias(n) for n in cut]
    places = F.flatten(F.transform("_s", lambda s: F.sequence(F.lit(0), F.size(s["input_ids"]) - 1)))
    return packed.select(batch, *out, places.alias("position_ids"))
