"""Rules whose every decision depends on all earlier ones, decided in parallel and exactly.

* Opener cap: the order is cut into ranges, each replayed from a guess of what the ranges before it accept. Where the replays
  lead to other counts than guessed, the ranges behind are replayed from those, until no count changes. The first range is right
  at once and each round settles one more at least. An opener that meets its cap in a range ends with the same count whatever it came
  with, so errors fade; an opener that keeps just below its cap makes the rounds many.
* Budget batches: where the batch that begins at a row ends does not depend on what lies before it. Each range maps
  its rows to the first batch start behind the range; only starts that some range can lead to go on, and pointer
  doubling over those finds the ones the first row leads to.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.ranks import rank_by_int
from parlance.functions.text import opener
from parlance.session import ensure_checkpoint_dir

RANGE_ROWS = 100_000
BEFORE = (W.unboundedPreceding, -1)


# ---- opener cap ------------------------------------------------------------------------------------------

def decide(openers: list, quiet: np.ndarray, total: int, held: dict, cap: float, floor: int) -> tuple[np.ndarray, dict, set]:
    """(whether each row is accepted, the counts in the end, openers that met their cap exactly).

    From the accepted total and counts before; ``quiet`` rows are accepted in between. An opener that is refused with the least
    count that is too many has the same count whatever it came with.
    """
    counts, tied = dict(held), set()
    out = np.zeros(len(openers), dtype=bool)
    for i, (key, between) in enumerate(zip(openers, quiet.tolist())):
        now, count = total + between, counts.get(key, 0)
        if now >= floor and count >= cap * now:
            if count - 1 < cap * now:
                tied.add(key)
        else:
            out[i] = True
            counts[key] = count + 1
            total += 1
    return out, counts, tied


def cap_openers(df: DataFrame, order: str, text: str, cap: float, floor: int = 50, range_rows: int = RANGE_ROWS,
                out: str = "accepted", rounds: list | None = None) -> DataFrame:
    """``df`` with ``out``: false where, once ``floor`` rows are accepted, the row's opener already has ``cap`` of them.

    Rows are taken in the order of ``order``, a unique integer, and only accepted ones count. An opener of too few rows ever to
    reach ``cap * floor`` is accepted without a replay. A null text has the empty opener. ``rounds`` gets the ranges replayed a round.
    """
    if cap <= 0:
        return df.withColumn(out, F.lit(True))
    ensure_checkpoint_dir(df.sparkSession)
    rows = rank_by_int(df.select(F.col(order).alias("_key"), F.coalesce(opener(F.col(text)), F.lit("")).alias("_o")), "_key", out="_at")
    rows = rows.withColumn("_range", F.floor(F.col("_at") / range_rows)).checkpoint()
    loud = rows.groupBy("_o").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") - 1 >= cap * floor).select("_o")
    active = rows.join(loud, "_o").checkpoint()
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    pairs = active.groupBy("_range", "_o").agg(F.count(F.lit(1)).alias("_rows"))
    quiet = sizes.join(pairs.groupBy("_range").agg(F.sum("_rows").alias("_a")), "_range", "left").select(
        "_range", (F.col("_rows") - F.coalesce("_a", F.lit(0))).alias("_quiet"), "_rows"
    ).checkpoint()
    # first guess: an opener with more than cap of all rows up to the end of a range is held to that there
    total = (F.lit(cap) * (F.col("_range") + 1) * range_rows).cast("long")
    upto = W.partitionBy("_o").orderBy("_range")
    taken = pairs.withColumn("_tied", F.sum("_rows").over(upto) > total).select(
        "_range", "_o", F.col("_rows").alias("_taken"), total.alias("_end"), "_tied"
    ).checkpoint()

    def starts_of(taken: DataFrame) -> DataFrame:
        """(range, opener, accepted before, total accepted before), from what was taken since an opener last met its cap.

        No window holds more than one row a range.
        """
        earlier = upto.rowsBetween(*BEFORE)
        sums = taken.withColumn("_sum", F.sum("_taken").over(upto)).withColumn("_base", F.when(F.col("_tied"), F.col("_end") - F.col("_sum")))
        sums = sums.withColumn("_before", F.coalesce(F.last("_base", True).over(earlier), F.lit(0)) + F.col("_sum") - F.col("_taken"))
        after = F.when(F.col("_tied"), F.col("_end")).otherwise(F.col("_before") + F.col("_taken"))
        sums = sums.select("_range", "_o", "_before", (after - F.col("_before")).alias("_more"))
        all_ = quiet.join(sums.groupBy("_range").agg(F.sum("_more").alias("_t")), "_range", "left")
        before = F.sum(F.col("_quiet") + F.coalesce("_t", F.lit(0))).over(W.orderBy("_range").rowsBetween(*BEFORE))
        totals = all_.select("_range", F.coalesce(before, F.lit(0)).alias("_total"))
        return sums.select("_range", "_o", "_before").join(totals, "_range").checkpoint()

    def replayed(rows: DataFrame, starts: DataFrame, sums: bool) -> DataFrame:
        def run(mine: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
            mine = mine.sort_values("_at")
            places = (mine["_at"] % range_rows).to_numpy()
            got, ends, tied = decide(
                mine["_o"].tolist(), places - np.arange(len(mine)), int(start["_total"].iloc[0]) if len(start) else 0,
                dict(zip(start["_o"], start["_before"].tolist())), cap, floor,
            )
            if not sums:
                return pd.DataFrame({"_at": mine["_at"].to_numpy(), "_ok": got})
            told = pd.DataFrame({"_o": mine["_o"].to_numpy(), "_taken": got.astype(np.int64)}).groupby("_o", as_index=False).sum()
            told.insert(0, "_range", int(mine["_range"].iloc[0]))
            return told.assign(_end=[ends.get(o, 0) for o in told["_o"]], _tied=[o in tied for o in told["_o"]])

        schema = "_range long, _o string, _taken long, _end long, _tied boolean" if sums else "_at long, _ok boolean"
        return rows.groupBy("_range").cogroup(starts.groupBy("_range")).applyInPandas(run, schema)

    starts, waiting = starts_of(taken), None
    while True:
        todo = active if waiting is None else active.join(waiting, "_range")
        new = replayed(todo, starts if waiting is None else starts.join(waiting, "_range"), True)
        taken = (new if waiting is None else new.unionByName(taken.join(waiting, "_range", "left_anti"))).checkpoint()
        if rounds is not None:
            rounds.append(todo.select("_range").distinct().count())
        now = starts_of(taken)
        waiting = now.join(starts.withColumnsRenamed({"_before": "_b", "_total": "_t"}), ["_range", "_o"]).where(
            "_b <> _before OR _t <> _total"
        ).select("_range").distinct().checkpoint()
        starts = now
        if waiting.isEmpty():
            break
    refused = replayed(active, starts, False).where("NOT _ok").select("_at")
    marks = rows.join(refused, "_at").select(F.col("_key").alias(order), F.lit(False).alias("_no"))
    return df.join(marks, order, "left").withColumn(out, F.coalesce("_no", F.lit(True))).drop("_no")


# ---- budget batches ----------------------------------------------------------------------------------------

def next_starts(lengths: np.ndarray, budget: int, padded: bool, own: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first ``own`` rows, where the batch that begins there ends (exclusive), and whether it is full.

    ``padded``: longest row times rows stays within the budget; else the sum does. A batch has one row at least. The end is -1 where
    the rows given do not tell; with ``last`` they reach to the end of the table.
    """
    n = len(lengths)
    ends, full = np.full(own, -1, dtype=np.int64), np.zeros(own, dtype=bool)
    longest: deque[int] = deque()  # places of falling lengths from the batch's first row on
    stop = used = 0
    values = lengths.tolist()
    for i in range(own):
        while longest and longest[0] < i:
            longest.popleft()
        if stop < i:
            stop, used = i, 0
        while stop < n:
            more = values[stop]
            top = max(more, values[longest[0]] if longest else 0)
            if (top * (stop - i + 1) if padded else used + more) > budget and stop > i:
                break
            while longest and values[longest[-1]] <= more:
                longest.pop()
            longest.append(stop)
            used += more
            stop += 1
        reached = padded and longest and values[longest[0]] * (stop - i) >= budget
        if stop < n or reached or last:
            ends[i], full[i] = stop, stop < n or reached
        used -= values[i]
    return ends, full


def budget_batches(df: DataFrame, key: str, length: Column, budget: int, padded: bool, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``micro_batch``, numbered from 0 over the whole order of ``key`` (a unique integer), and ``complete``.

    No batch restarts at a range; only the last one of all can be incomplete, which a loader would hold back. A null length
    counts as 0. Where a range does not tell where its batches end (many rows without tokens), more of what follows is looked at.
    """
    ensure_checkpoint_dir(df.sparkSession)
    slim = rank_by_int(df.select(F.col(key).alias("_key"), F.coalesce(length, F.lit(0)).cast("long").alias("_length")), "_key", out="_at")
    rows = slim.withColumn("_range", F.floor(F.col("_at") / range_rows)).checkpoint()
    n = rows.count()
    ahead = 1
    while True:
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_at")
            mine, first = int(pdf["_for"].iloc[0]), int(pdf["_for"].iloc[0]) * range_rows
            own = min(range_rows, n - first)
            reaches = first + len(pdf) == n
            ends, full = next_starts(pdf["_length"].to_numpy(), budget, padded, own, reaches)
            exits, hops = ends.copy(), np.ones(own, dtype=np.int64)
            for i in range(own - 1, -1, -1):
                if 0 <= ends[i] < own:
                    exits[i], hops[i] = exits[ends[i]], hops[ends[i]] + 1
            known = exits >= 0
            return pd.DataFrame({
                "_range": mine, "_at": first + np.arange(own), "_next": np.where(ends >= 0, ends + first, -1), "_full": full,
                "_exit": np.where(known, exits + first, -1), "_hops": hops,
            })

        # rows behind a range as far as one batch can reach, if all of them have tokens
        need = F.lit(min(budget, range_rows) * ahead)
        spread = rows.withColumn("_for", F.explode(F.sequence(
            F.greatest(F.lit(0).cast("long"), F.floor((F.col("_at") - need) / range_rows)), F.col("_range")
        ))).where((F.col("_for") == F.col("_range")) | (F.col("_at") < (F.col("_for") + 1) * range_rows + need))
        jumps = spread.select("_for", "_at", "_length").groupBy("_for").applyInPandas(
            run, "_range long, _at long, _next long, _full boolean, _exit long, _hops long"
        ).checkpoint()
        if n == 0 or jumps.where("_next < 0").isEmpty():
            break
        ahead *= 2 if budget <= range_rows * ahead else -(-budget // range_rows)
    # starts that the first row or a range leads to: a range's rows share few exits
    doors = jumps.select(F.col("_exit").alias("_at")).where(F.col("_at") < n).union(
        df.sparkSession.range(0, 1 if n else 0).select(F.col("id").alias("_at"))
    ).distinct()
    step = jumps.join(doors, "_at").select("_at", F.col("_exit").alias("_to"), "_hops").checkpoint()
    chain = step.where("_at = 0").select("_at", F.lit(0).cast("long").alias("_batch")).checkpoint()
    while True:
        further = chain.join(step, "_at").where(F.col("_to") < n).select(
            F.col("_to").alias("_at"), (F.col("_batch") + F.col("_hops")).alias("_batch")
        )
        if further.isEmpty():
            break
        chain = chain.union(further).distinct().checkpoint()
        onward = step.toDF("_to", "_then", "_more")
        step = step.join(onward, "_to").select("_at", F.col("_then").alias("_to"), (F.col("_hops") + F.col("_more")).alias("_hops")).checkpoint()

    def starts(mine: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
        nexts = dict(zip(mine["_at"].tolist(), zip(mine["_next"].tolist(), mine["_full"].tolist())))
        out = []
        for at, batch in zip(first["_at"].tolist(), first["_batch"].tolist()):
            while at in nexts:
                out.append((batch, at, *nexts[at]))
                at, batch = nexts[at][0], batch + 1
        return pd.DataFrame(out, columns=["_batch", "_start", "_end", "_full"])

    entered = chain.withColumn("_range", F.floor(F.col("_at") / range_rows))
    cut = jumps.groupBy("_range").cogroup(entered.groupBy("_range")).applyInPandas(
        starts, "_batch long, _start long, _end long, _full boolean"
    )
    reach = F.sequence(F.floor(F.col("_start") / range_rows), F.floor((F.col("_end") - 1) / range_rows))

    def place(mine: pd.DataFrame, batches: pd.DataFrame) -> pd.DataFrame:
        batches = batches.sort_values("_start")
        which = np.searchsorted(batches["_start"].to_numpy(), mine["_at"].to_numpy(), side="right") - 1
        return pd.DataFrame({
            "_key": mine["_key"].to_numpy(), "micro_batch": batches["_batch"].to_numpy()[which], "complete": batches["_full"].to_numpy()[which],
        })

    kind = df.schema[key].dataType.simpleString()
    placed = rows.groupBy("_range").cogroup(cut.withColumn("_range", F.explode(reach)).groupBy("_range")).applyInPandas(
        place, f"_key {kind}, micro_batch long, complete boolean"
    )
    return df.join(placed.withColumnRenamed("_key", key), key)
