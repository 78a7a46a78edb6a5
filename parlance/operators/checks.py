"""Row validity: stage rules, media counts, role shape, supervision left after truncation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import count_of
from parlance.model import MEDIA


def stage_valid(stage: str, prompt: str = "_prompt", response: str = "_response") -> Column:
    answers = F.size(response)
    rule = {
        "sft": answers == 1,
        "pairwise": answers >= 2,
        "kto": answers >= 2,
        "unsupervised": F.lit(True),
    }[stage]
    return (F.size(prompt) % 2 == 1) & rule


def drop_invalid(df: DataFrame, stage: str) -> DataFrame:
    return df.where(stage_valid(stage))


def validate_media(df: DataFrame, messages: str = "messages", content: str = "content") -> DataFrame:
    """``media_ok``: per medium, placeholders in all turns equal the listed files."""
    rules = []
    for tag, _, column in MEDIA:
        listed = F.coalesce(F.size(F.coalesce(F.col(column), F.array().cast("array<string>"))), F.lit(0)) \
            if column in df.columns else F.lit(0)
        total = F.aggregate(
            messages, F.lit(0), lambda n, m: n + F.coalesce(count_of(m[content], tag), F.lit(0))
        )
        rules.append(total == listed)
    return df.withColumn("media_ok", rules[0] & rules[1] & rules[2])


def drop_unsupervised(df: DataFrame, cutoff: int, ids: str = "input_ids", weights: str = "loss_weights") -> DataFrame:
    """Over-long rows whose first ``cutoff`` tokens carry no loss are dropped."""
    trained = F.exists(F.slice(weights, 1, cutoff), lambda w: w > 1e-6)
    return df.where((F.size(ids) <= cutoff) | trained)


def drop_overlong(df: DataFrame, cutoff: int, ids: str = "input_ids") -> DataFrame:
    return df.where(F.size(ids) <= cutoff)


def role_shape_ok(roles: Sequence[str], messages: str = "messages") -> Column:
    return F.transform(messages, lambda m: m["role"]) == F.array(*[F.lit(r) for r in roles])


def assert_roles(df: DataFrame, roles: Sequence[str] = ("system", "user", "assistant"),
                 messages: str = "messages") -> DataFrame:
    """Fail the job on the first row of another shape; the frame passes through unchanged and stays lazy."""
    text = f"every row must be exactly {'/'.join(roles)}"
    guard = F.assert_true(role_shape_ok(roles, messages), text)
    return df.where(guard.isNull())


def kto_balance(df: DataFrame, response: str = "_response") -> DataFrame:
    """One row: desired and undesired counts and whether a class is missing."""
    desired = F.coalesce(F.get(F.col(response), F.lit(0))["content"], F.lit("")) != ""
    counts = df.agg(
        F.count_if(desired).alias("desired"), F.count_if(~desired).alias("undesired")
    )
    return counts.withColumn("one_class_only", (F.col("desired") == 0) | (F.col("undesired") == 0))
