"""Token columns, length budgets and labels. Tokens leave the JVM for a tokenizer plug-in and for a vocabulary's ids only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.text import let, words
from parlance.functions.udfs import batch_udf
from parlance.model import IGNORE_LABEL

INTS = "array<int>"


def hash_id(token: Column) -> Column:
    """A 28-bit token id that needs no vocabulary."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 7), 16, 10).cast("int")


def tokenize(df: DataFrame, column: str, tokenizer="words", out: str = "tokens") -> DataFrame:
    """``words``, ``chars``, or a function text -> list of ids run per Arrow batch."""
    if tokenizer == "words":
        return df.withColumn(out, words(F.col(column)))
    if tokenizer == "chars":
        return df.withColumn(out, F.filter(F.split(F.col(column), ""), lambda c: c != ""))
    encode: Callable[[str], Sequence[int]] = tokenizer

    @F.pandas_udf(INTS)
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(encode(t)))

    return df.withColumn(out, ids(column))


def hash_ids(df: DataFrame, tokens: str = "tokens", out: str = "input_ids") -> DataFrame:
    return df.withColumn(out, F.transform(tokens, hash_id))


@batch_udf("array<int>")
def _looked_up(tokens: pd.Series, known: pd.Series, ids: pd.Series, unknown: pd.Series) -> pd.Series:
    """The id of every token by its row's own table: a map's look-up would walk the table for each token."""

    def one(row, keys, values, other):
        if row is None:
            return None
        table = dict(zip(keys, values)) if keys is not None else {}
        return [table.get(t, other) for t in row]

    return pd.Series([one(*row) for row in zip(tokens, known, ids, unknown)], dtype=object)


def vocab_ids(df: DataFrame, vocabulary: DataFrame, key: str, tokens: str = "tokens", out: str = "input_ids",
              unknown: int = 0) -> DataFrame:
    """Ids from a vocabulary table (token, id) by an equi join on distinct tokens per row."""
    items = df.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    found = items.join(vocabulary.select("token", F.col("id").cast("int").alias("id")), "token")
    maps = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("_ids"))
    rows = df.join(maps, key, "left")
    looked = _looked_up(F.col(tokens), F.map_keys("_ids"), F.map_values("_ids"), F.lit(unknown))
    return rows.withColumn(out, looked).drop("_ids")


def seq_budget(source: Column, target: Column, cutoff: Column) -> Column:
    """Struct (source, target) of kept lengths: the longer side gives way; both shrink when both are long."""
    share = F.floor(cutoff * F.try_divide(target, source + target)).cast("int")
    most = F.when(target * 2 < cutoff, cutoff).when(source * 2 < cutoff, cutoff - source).otherwise(share)
    kept_target = F.least(most, target).cast("int")
    return let(
        F.struct(kept_target.alias("t"), source.cast("int").alias("s"), cutoff.cast("int").alias("c")),
        lambda v: F.struct(
            F.least(F.greatest(v["c"] - v["t"], F.lit(0)), v["s"]).alias("source"), v["t"].alias("target")
        ),
    )


def infer_seqlen(df: DataFrame, source: str, target: str, cutoff: int) -> DataFrame:
    kept = seq_budget(F.col(source), F.col(target), F.lit(cutoff))
    return df.withColumn("_k", kept).withColumn("source_len", F.col("_k.source")).withColumn(
        "target_len", F.col("_k.target")
    ).drop("_k")


def _ignored(n: Column) -> Column:
    return F.array_repeat(F.lit(IGNORE_LABEL), n.cast("int"))


def turn_pairs(df: DataFrame, messages: str = "messages", tokens=words, out: str = "pairs") -> DataFrame:
    """Prompt/answer pairs of token ids from alternating turns."""
    ids = lambda c: F.transform(tokens(c), hash_id)
    n = F.floor(F.size(messages) / 2).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast(INTS))
    msgs = F.col(messages)
    pair = lambda k: F.struct(
        ids(F.get(msgs, k * 2)["content"]).alias("source"), ids(F.get(msgs, k * 2 + 1)["content"]).alias("target")
    )
    return df.withColumn(out, F.transform(starts, pair))


def encode_sft(df: DataFrame, cutoff: int, pairs: str = "pairs", mask_history: bool = False,
               train_on_prompt: bool = False, efficient_eos: bool = False, eos_id: int = 2) -> DataFrame:
    """``input_ids`` and ``labels`` of a dialogue under one token budget.

    Turns are budgeted in order until the cutoff is reached; with ``mask_history`` from the last turn backwards,
    and only that turn is trained.
    """
    ordered = F.reverse(pairs) if mask_history else F.col(pairs)
    sizes = F.transform(ordered, lambda p: F.struct(F.size(p["source"]).alias("s"), F.size(p["target"]).alias("t")))
    kept_type = "array<struct<source:int,target:int>>"
    start = F.struct(F.lit(1 if efficient_eos else 0).alias("used"), F.array().cast(kept_type).alias("kept"))

    def step(state: Column, p: Column) -> Column:
        full = state["used"] >= cutoff
        none = F.struct(F.lit(0).alias("source"), F.lit(0).alias("target"))
        take = F.when(full, none).otherwise(seq_budget(p["s"], p["t"], F.lit(cutoff) - state["used"]))
        return let(take, lambda k: F.struct(
            (state["used"] + k["source"] + k["target"]).alias("used"),
            F.concat(state["kept"], F.array(k)).alias("kept"),
        ))

    df = df.withColumn("_o", ordered).withColumn("_k", F.aggregate(sizes, start, step, lambda s: s["kept"]))
    df = df.withColumn("_p", F.transform(
        F.arrays_zip("_o", "_k"),
        lambda z, i: F.struct(
            F.slice(z["_o"]["source"], F.lit(1), z["_k"]["source"]).alias("source"),
            F.slice(z["_o"]["target"], F.lit(1), z["_k"]["target"]).alias("target"), i.alias("i"),
        ),
    ))

    def labels(p: Column) -> Column:
        n = F.size(p["source"])
        if train_on_prompt:
            source = p["source"]
        elif efficient_eos:
            marked = F.concat(F.array(F.lit(eos_id)), _ignored(F.greatest(n - 1, F.lit(0))))
            source = F.when((p["i"] != 0) & (n > 0), marked).otherwise(_ignored(n))
        else:
            source = _ignored(n)
        target = p["target"]
        if mask_history:
            target = F.when(p["i"] != 0, _ignored(F.size(p["target"]))).otherwise(p["target"])
        return F.concat(source, target)

    laid = F.reverse("_p") if mask_history else F.col("_p")
    end = F.array(F.lit(eos_id)) if efficient_eos else F.array().cast(INTS)
    return df.withColumn("_p", laid).select(
        *[c for c in df.columns if c not in ("_o", "_k", "_p", pairs)],
        F.concat(F.flatten(F.transform("_p", lambda p: F.concat(p["source"], p["target"]))), end).alias("input_ids"),
        F.concat(F.flatten(F.transform("_p", labels)), end).alias("labels"),
    ).withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def encode_pt(df: DataFrame, cutoff: int, ids: str = "input_ids", bos_id: int | None = None,
              eos_id: int | None = None) -> DataFrame:
    """Plain text row: end mark added, start mark in front, cut at the cutoff."""
    full = F.col(ids)
    if eos_id is not None:
        full = F.concat(full, F.array(F.lit(eos_id)))
    if bos_id is not None:
        full = F.concat(F.array(F.lit(bos_id)), full)
    return df.withColumn(ids, F.slice(full, 1, cutoff))


def _answer(prompt: Column, target: Column, kept: Column) -> tuple[Column, Column]:
    """(ids, labels) of a prompt and an answer cut to the kept lengths."""
    source = F.slice(prompt, F.lit(1), kept["source"])
    answer = F.slice(target, F.lit(1), kept["target"])
    return F.concat(source, answer), F.concat(_ignored(F.size(source)), answer)


def encode_pairs(df: DataFrame, cutoff: int, prompt: str = "prompt_ids", chosen: str = "chosen_ids",
                 rejected: str = "rejected_ids") -> DataFrame:
    """Both answers cut by one budget set by the longer answer."""
    longest = F.greatest(F.size(chosen), F.size(rejected))
    df = df.withColumn("_k", seq_budget(F.size(prompt), longest, F.lit(cutoff)))
    outs = {}
    for side, column in (("chosen", chosen), ("rejected", rejected)):
        outs[f"{side}_input_ids"], outs[f"{side}_labels"] = _answer(F.col(prompt), F.col(column), F.col("_k"))
    return df.select("*", *[c.alias(n) for n, c in outs.items()]).drop("_k")


def encode_kto(df: DataFrame, cutoff: int, batch: str = "batch_id", order: str = "ordinal",
               prompt: str = "prompt_ids", response: str = "response_ids") -> DataFrame:
    """Adds the mismatched answer: the one of the previous row of the batch, the last one for the first row."""
    inside = W.partitionBy(batch).orderBy(order)
    whole = inside.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    other = F.coalesce(F.lag(response).over(inside), F.last(response).over(whole))
    df = df.withColumn("_other", other)
    df = df.withColumn("_k", seq_budget(F.size(prompt), F.size(response), F.lit(cutoff))).withColumn(
        "_m", seq_budget(F.size(prompt), F.size("_other"), F.lit(cutoff))
    )
    ids, labels = _answer(F.col(prompt), F.col(response), F.col("_k"))
    kl_ids, kl_labels = _answer(F.col(prompt), F.col("_other"), F.col("_m"))
    return df.select(
        "*", ids.alias("input_ids"), labels.alias("labels"), kl_ids.alias("kl_input_ids"), kl_labels.alias("kl_labels")
    ).drop("_k", "_m", "_other")


def encode_prompt_only(df: DataFrame, cutoff: int, prompt: str = "prompt_ids", answer: str = "answer_ids") -> DataFrame:
    df = df.withColumn("_k", seq_budget(F.size(prompt), F.size(answer), F.lit(cutoff)))
    return df.select(
        "*", F.slice(prompt, F.lit(1), F.col("_k.source")).alias("input_ids"),
        F.slice(answer, F.lit(1), F.col("_k.target")).alias("labels"),
    ).drop("_k")


def label_by_prefix(df: DataFrame, prompt: str = "prompt_ids", full: str = "full_ids",
                    weight: str = "loss_weight") -> DataFrame:
    """Tokens after the prompt carry the message weight; ``prefix_error`` flags an unstable prompt."""
    head = F.slice(full, F.lit(1), F.size(prompt)) == F.col(prompt)
    bound = F.struct(F.size(prompt).alias("m"), F.coalesce(F.col(weight), F.lit(1.0)).cast("double").alias("w"))
    labels = let(bound, lambda v: F.transform(
        full, lambda t, i: F.when((i >= v["m"]) & (v["w"] > 1e-6), t).otherwise(F.lit(IGNORE_LABEL))
    ))
    weights = let(bound, lambda v: F.transform(full, lambda t, i: F.when(i >= v["m"], v["w"]).otherwise(F.lit(0.0))))
    return df.select(
        "*", F.col(full).alias("input_ids"), F.array_repeat(F.lit(1), F.size(full)).alias("attention_mask"),
        labels.alias("labels"), weights.alias("loss_weights"), (~head).alias("prefix_error"),
    )


def concat_pair(df: DataFrame) -> DataFrame:
    """One row of chosen then rejected: token types 1 and 2, positions restart at 1."""
    a, b = F.size("chosen_input_ids"), F.size("rejected_input_ids")
    one_to = lambda n: F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast(INTS))
    return df.select(
        *[c for c in df.columns if not c.startswith(("chosen_", "rejected_"))],
        F.concat("chosen_input_ids", "rejected_input_ids").alias("input_ids"),
        F.concat("chosen_labels", "rejected_labels").alias("labels"),
        F.concat(F.array_repeat(F.lit(1), a), F.array_repeat(F.lit(2), b)).alias("token_type_ids"),
        F.concat(one_to(a), one_to(b)).alias("position_ids"),
    )


def pad_batches(df: DataFrame, cutoff: int, batch: str = "batch_id", ids: str = "input_ids",
                columns: Sequence[str] = ("input_ids", "labels", "attention_mask")) -> DataFrame:
    """Every row of a batch padded or cut to min(longest row, cutoff); label columns padded with -100."""
    longest = F.least(F.max(F.size(ids)).over(W.partitionBy(batch)), F.lit(cutoff))
    df = df.withColumn("_n", longest)
    for name in columns:
        blank = F.lit(IGNORE_LABEL if "label" in name else 0)
        gap = F.array_repeat(blank, F.greatest(F.col("_n") - F.size(name), F.lit(0)))
        df = df.withColumn(name, F.concat(F.slice(F.col(name), F.lit(1), F.col("_n")), gap))
    return df.drop("_n")


def stack_pairs(df: DataFrame, batch: str = "batch_id", order: str = "ordinal") -> DataFrame:
    """2n rows per batch, all chosen rows first; ``position`` is the row's place in the stacked batch."""
    n = F.count(F.lit(1)).over(W.partitionBy(batch))
    place = F.row_number().over(W.partitionBy(batch).orderBy(order)) - 1
    df = df.withColumn("_n", n).withColumn("_i", place)
    sides = F.array(*[
        F.struct(
            F.lit(k).alias("side"), F.col(f"{name}_input_ids").alias("input_ids"), F.col(f"{name}_labels").alias("labels")
        )
        for k, name in enumerate(("chosen", "rejected"))
    ])
    keep = [c for c in df.columns if not c.startswith(("chosen_", "rejected_")) and c not in ("_n", "_i")]
    return df.select(*keep, "_n", "_i", F.explode(sides).alias("_s")).select(
        *keep, "_s.*", (F.col("_s.side") * F.col("_n") + F.col("_i")).alias("position")
    )
