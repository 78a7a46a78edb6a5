"""Metric blocks over flat score rows, slices, paired comparison, bootstrap."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.ranks import ceil_rank, ceil_rank_plus_one, join_null_safe, pick_ranks

REQUIRED = (
    "record_id", "contract_name", "contract_fingerprint", "variant", "case_id", "request_id", "level", "language",
    "difficulty", "polarity", "exact_train", "all_atoms_seen_train", "has_novel_atom", "strict_pass", "valid_json",
    "contract_valid", "task_count_match", "ordered_kind_name_match", "forbidden_tool_violation", "latency_ms", "reason",
)


def rate(flag: Column) -> Column:
    """Share of true rows; null without rows."""
    return F.try_divide(F.count_if(flag), F.count(F.lit(1)))


def validate_results(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per problem: missing field, id mismatch, duplicate record, duplicate case key."""
    present = [c for c in required if c in df.columns]
    absent = [c for c in required if c not in df.columns]
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == "") if types[c] == "string" else F.col(c).isNull()

    problems = F.array_compact(F.array(
        *[F.lit(f"missing column {c}") for c in absent],
        *[F.when(missing(c), F.lit(f"missing {c}")) for c in present],
        F.when(F.col("latency_ms") < 0, F.lit("negative latency_ms")),
        F.when(F.col("request_id") != F.col("record_id"), F.lit("request_id must match record_id")),
    ))
    rows = df.select(F.col("record_id").alias("subject"), F.explode(problems).alias("problem"))
    twice = lambda keys, text: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        F.concat_ws("|", *keys).alias("subject"), F.lit(text).alias("problem")
    )
    return rows.unionByName(twice(["record_id"], "duplicate record_id")).unionByName(
        twice(["contract_fingerprint", "variant", "case_id"], "duplicate case key")
    )


def _counted(df: DataFrame, by: Sequence[str], reason: str, failed: Column, out: str) -> DataFrame:
    counts = df.where(failed).groupBy(*by, reason).agg(F.count(F.lit(1)).alias("_n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(reason).alias("k"), F.col("_n").alias("v"))))
    return counts.groupBy(*by).agg(F.map_from_entries(entries).alias(out))


def metrics(df: DataFrame, by: Sequence[str] = (), bin_width: float = 1.0) -> DataFrame:
    """The metric block per group: rates, nearest-rank latency, tokens, failure reasons."""
    by = list(by)
    df = df if by else df.withColumn("_all", F.lit("all"))
    keys = by or ["_all"]
    block = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        rate(F.col("strict_pass")).alias("strict_sequence_accuracy"),
        rate(F.col("valid_json")).alias("valid_json_rate"),
        rate(F.col("contract_valid")).alias("contract_valid_rate"),
        rate(F.col("task_count_match")).alias("task_count_accuracy"),
        rate(F.col("ordered_kind_name_match")).alias("ordered_kind_name_accuracy"),
        F.try_divide(F.count_if("parameter_match"), F.nullif(F.count("parameter_match"), F.lit(0))).alias("parameter_accuracy"),
        F.count("parameter_match").alias("parameter_accuracy_denominator"),
        rate(F.col("forbidden_tool_violation")).alias("forbidden_tool_violation_rate"),
        F.avg("latency_ms").alias("latency_mean"),
        F.sum("latency_ms").alias("_latency"),
        F.sum("prompt_tokens").alias("prompt_total"),
        F.sum("output_tokens").alias("output_total"),
    )
    ranks = pick_ranks(df, keys, "latency_ms", {"latency_p50": 0.5, "latency_p95": 0.95}, ceil_rank_plus_one, bin_width)
    reasons = _counted(df, keys, "reason", ~F.col("strict_pass"), "failure_reasons")
    out = join_null_safe(join_null_safe(block, ranks, keys, "left"), reasons, keys, "left")
    out = out.withColumn(
        "output_tokens_per_second",
        F.when(F.col("_latency") > 0, F.col("output_total") / (F.col("_latency") / F.lit(1000.0))),
    ).withColumn("failure_reasons", F.coalesce("failure_reasons", F.create_map().cast("map<string,bigint>")))
    return out.drop("_latency", "_all")


def overlap_slices() -> Column:
    """Names of the overlap slices a record belongs to."""
    exact = F.col("exact_train")
    return F.array_compact(F.array(
        F.lit("all"),
        F.when(exact, F.lit("exact_train")),
        F.when(~exact, F.lit("non_exact_train")),
        F.when(~exact & F.col("all_atoms_seen_train"), F.lit("composition_seen_atoms")),
        F.when(F.col("has_novel_atom"), F.lit("has_novel_atom")),
    ))


def tool_names(expected: str = "expected") -> Column:
    """Distinct expected tool names; a plan without tools counts under ``reply``."""
    names = F.array_sort(F.array_distinct(F.array_compact(F.transform(expected, lambda t: t["name"]))))
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("reply")))


def metrics_by_slice(df: DataFrame, scalars: Sequence[str] = ("difficulty", "language", "level", "polarity"),
                     lists: Sequence[str] = ("expected_tools",), overlap: bool = True, bin_width: float = 1.0) -> DataFrame:
    """Metric blocks per (facet, value). Records are narrowed to metric columns before they are fanned out."""
    parts = [
        F.array(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c in scalars
    ] + [
        F.transform(c, lambda v: F.struct(F.lit(c).alias("facet"), v.cast("string").alias("value"))) for c in lists
    ]
    if overlap:
        parts.append(F.transform(overlap_slices(), lambda v: F.struct(F.lit("overlap").alias("facet"), v.alias("value"))))
    used = ["strict_pass", "valid_json", "contract_valid", "task_count_match", "ordered_kind_name_match",
            "parameter_match", "forbidden_tool_violation", "latency_ms", "prompt_tokens", "output_tokens", "reason"]
    fanned = df.select(*used, F.explode(F.concat(*parts)).alias("_f")).select(
        *used, F.col("_f.facet").alias("facet"), F.col("_f.value").alias("value")
    )
    return metrics(fanned, ["facet", "value"], bin_width)


def summarize_model(df: DataFrame, by: Sequence[str], wall_ms: float | None = None, bin_width: float = 1.0) -> DataFrame:
    """Extended quality and performance block per group, with step precision, recall and F1."""
    both_tokens = F.col("prompt_tokens").isNotNull() & F.col("output_tokens").isNotNull()
    seconds = wall_ms / 1000.0 if wall_ms and wall_ms > 0 else None
    n = F.count(F.lit(1))
    inputs = F.coalesce(F.sum(F.when(both_tokens, F.col("prompt_tokens"))), F.lit(0))
    outputs = F.coalesce(F.sum(F.when(both_tokens, F.col("output_tokens"))), F.lit(0))
    covered = F.nullif(F.count_if(both_tokens), F.lit(0))
    block = df.groupBy(*by).agg(
        n.alias("count"),
        F.count_if("compatible_pass").alias("compatible_pass"),
        rate(F.col("compatible_pass")).alias("compatible_accuracy"),
        rate(F.col("parser_valid")).alias("parser_valid_rate"),
        rate(F.col("tool_sequence_match")).alias("tool_sequence_accuracy"),
        F.count_if("strict_pass").alias("strict_pass"),
        rate(F.col("strict_pass")).alias("strict_accuracy"),
        rate(F.col("valid_json")).alias("valid_json_rate"),
        rate(F.col("contract_valid")).alias("contract_valid_rate"),
        F.try_divide(F.count_if("parameter_match"), F.nullif(F.count("parameter_match"), F.lit(0))).alias("parameter_accuracy"),
        F.count("parameter_match").alias("parameter_accuracy_denominator"),
        F.sum("aligned_kind_name_matches").alias("steps_matched"),
        F.sum("expected_step_count").alias("steps_expected"),
        F.sum("predicted_step_count").alias("steps_predicted"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.min("latency_ms").alias("latency_min"), F.avg("latency_ms").alias("latency_mean"),
        F.max("latency_ms").alias("latency_max"), F.sum("latency_ms").alias("_latency"),
        F.count_if(both_tokens).alias("token_rows"), rate(both_tokens).alias("token_coverage"),
        inputs.alias("input_total"), F.try_divide(inputs, covered).alias("input_mean"),
        outputs.alias("output_total"), F.try_divide(outputs, covered).alias("output_mean"),
    )
    p = F.try_divide("steps_matched", F.nullif("steps_predicted", F.lit(0)))
    r = F.try_divide("steps_matched", F.nullif("steps_expected", F.lit(0)))
    block = block.withColumn("step_precision", p).withColumn("step_recall", r)
    block = block.withColumn(
        "step_f1",
        F.when(
            F.col("step_precision") + F.col("step_recall") > 0,
            2 * F.col("step_precision") * F.col("step_recall") / (F.col("step_precision") + F.col("step_recall")),
        ),
    )
    per = lambda c: F.lit(None).cast("double") if seconds is None else c / F.lit(seconds)
    block = block.withColumn("requests_per_second", per(F.col("count"))).withColumn(
        "output_tokens_per_second", per(F.col("output_total"))
    ).withColumn("total_tokens_per_second", per(F.col("input_total") + F.col("output_total"))).withColumn(
        "service_output_tokens_per_second",
        F.when(F.col("_latency") > 0, F.col("output_total") / (F.col("_latency") / F.lit(1000.0))),
    ).drop("_latency")
    picks = {"latency_p50": 0.5, "latency_p90": 0.9, "latency_p95": 0.95, "latency_p99": 0.99}
    ranks = pick_ranks(df, by, "latency_ms", picks, ceil_rank, bin_width)
    reasons = _counted(df, by, "reason", ~F.col("strict_pass"), "failure_reasons")
    return join_null_safe(join_null_safe(block, ranks, by, "left"), reasons, by, "left")


def paired(df: DataFrame, left: str, right: str, by: Sequence[str] = (), case: str = "case_id",
           variant: str = "variant", passed: str = "strict_pass") -> DataFrame:
    """2x2 counts of two variants on shared cases. One grouping by case pairs the records; no self join."""
    sides = df.where(F.col(variant).isin(left, right)).groupBy(*by, case).agg(
        F.max(F.when(F.col(variant) == left, F.col(passed).cast("int"))).alias("l"),
        F.max(F.when(F.col(variant) == right, F.col(passed).cast("int"))).alias("r"),
    ).where(F.col("l").isNotNull() & F.col("r").isNotNull())
    l, r = F.col("l") == 1, F.col("r") == 1
    n = F.nullif(F.count(F.lit(1)), F.lit(0))
    return sides.groupBy(*by).agg(
        F.count(F.lit(1)).alias("paired_count"),
        F.count_if(l & r).alias("both_pass"), F.count_if(l & ~r).alias("left_only_pass"),
        F.count_if(~l & r).alias("right_only_pass"), F.count_if(~l & ~r).alias("both_fail"),
        F.try_divide(F.count_if(l), n).alias("left_accuracy"), F.try_divide(F.count_if(r), n).alias("right_accuracy"),
        F.try_divide(F.count_if(l) - F.count_if(r), n).alias("accuracy_delta"),
    )


def bootstrap_ci(pairs: DataFrame, samples: int = 2000, seed: int = 0) -> DataFrame:
    """Percentile interval of the paired delta, from the 2x2 counts.

    A resample of n differences in {-1, 0, 1} is a multinomial draw of the three counts, so a resample costs the
    same for ten cases or ten billion. Draws are seeded per resample number.
    """
    spark = pairs.sparkSession
    counts = pairs.select(
        "paired_count", F.col("left_only_pass").alias("up"), F.col("right_only_pass").alias("down"), "accuracy_delta"
    )
    resamples = spark.range(samples).withColumn("_k", F.lit(1)).join(counts.withColumn("_k", F.lit(1)), "_k")

    @F.pandas_udf("double")
    def resampled(number: pd.Series, n: pd.Series, up: pd.Series, down: pd.Series) -> pd.Series:
        def one(b, total, u, d):
            if total == 0:
                return None
            p = np.array([u, d, total - u - d], dtype=float) / total
            got = np.random.default_rng([seed, b]).multinomial(total, p)
            return (got[0] - got[1]) / total
        return pd.Series([one(*x) for x in zip(number, n, up, down)])

    means = resamples.select(resampled("id", "paired_count", "up", "down").alias("mean"))
    ends = pick_ranks(means, [], "mean", {"low": 0.025, "high": 0.975}, ceil_rank_plus_one, 0.001)
    # all differences equal: the interval is the observed delta itself
    flat = (F.col("up") == F.col("paired_count")) | (F.col("down") == F.col("paired_count")) | (
        (F.col("up") == 0) & (F.col("down") == 0)
    )
    one = counts.withColumn("_k", F.lit(1)).join(ends.withColumn("_k", F.lit(1)), "_k", "left")
    return one.select(
        "accuracy_delta", F.when(flat, F.col("accuracy_delta")).otherwise(F.col("low")).alias("ci_low"),
        F.when(flat, F.col("accuracy_delta")).otherwise(F.col("high")).alias("ci_high"),
    )


def mcnemar_p(a: Column, b: Column) -> Column:
    """Exact two-sided p of a discordant pair count a against b; ln-factorials from Stirling's series.

    The tail is summed downwards from min(a, b) over 50 * sqrt(n) terms; what lies beyond is 100 deviations off.
    """

    def ln_fact(x: Column) -> Column:
        small = F.aggregate(
            F.when((x >= 1) & (x < 32), F.sequence(F.lit(1), F.greatest(x, F.lit(1)).cast("int"))).otherwise(F.array(F.lit(1))),
            F.lit(0.0), lambda s, i: s + F.log(i.cast("double")),
        )
        z = (x + 1).cast("double")
        big = (
            (z - 0.5) * F.log(z) - z + 0.5 * F.log(F.lit(2 * np.pi)) + 1 / (12 * z) - 1 / (360 * z * z * z)
            + 1 / (1260 * z * z * z * z * z)
        )
        return F.when(x < 32, small).otherwise(big)

    n, k = a + b, F.least(a, b)
    low = F.greatest(F.lit(0), k - F.ceil(F.lit(50.0) * F.sqrt(n)))
    terms = F.transform(
        F.sequence(low.cast("bigint"), k.cast("bigint")),
        lambda i: F.exp(ln_fact(n) - ln_fact(i) - ln_fact(n - i) - n * F.log(F.lit(2.0))),
    )
    tail = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    return F.when(n > 0, F.least(F.lit(1.0), F.lit(2.0) * tail)).otherwise(F.lit(1.0))


def mcnemar(df: DataFrame, left: str, right: str, **kw) -> DataFrame:
    counts = paired(df, left, right, **kw)
    return counts.withColumn("p_value", mcnemar_p(F.col("left_only_pass"), F.col("right_only_pass")))


def accuracy_by_bucket(df: DataFrame, sim: str = "min_nn", seen: str = "signature_seen", unseen: str = "has_unseen",
                       passed: str = "strict_pass") -> DataFrame:
    """Pass counts per similarity bucket and seen/unseen mark; a row belongs to several buckets."""
    s = F.col(sim)
    marks = F.array_compact(F.array(
        F.when(s >= 0.8, F.lit("nn>=0.8")).when(s >= 0.5, F.lit("0.5<=nn<0.8")).otherwise(F.lit("nn<0.5")),
        F.when(F.col(seen) > 0, F.lit("signature seen")).otherwise(F.lit("signature unseen")),
        F.when(F.col(unseen), F.lit("values unseen")),
    ))
    return df.select(F.explode(marks).alias("bucket"), F.col(passed).alias("_p")).groupBy("bucket").agg(
        F.count_if("_p").alias("passed"), F.count(F.lit(1)).alias("rows"),
        rate(F.col("_p")).alias("accuracy"),
    )


def failures(df: DataFrame) -> DataFrame:
    return df.where(~F.col("strict_pass"))
