"""Streaming forms: stateless alignment, hash-rate split, run-log status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.hashing import draw_uniform
from parlance.model import DatasetSpec
from parlance.operators.align import align
from parlance.operators.checks import drop_invalid

RUN_LOG = (
    "run string, current_steps long, total_steps long, loss double, eval_loss double, reward double, accuracy double, "
    "lr double, epoch double, percentage double, elapsed_time string, remaining_time string, throughput double, "
    "total_tokens long"
)


def align_stream(stream: DataFrame, spec: DatasetSpec, stage: str = "sft", keep=(),
                 screen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stateless: the batch operators work on the stream as they are."""
    rows = drop_invalid(align(stream, spec, keep), stage)
    return screen(rows) if screen else rows


def split_stream(stream: DataFrame, rate: float, key: str, seed=0) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by hash rate: a stream has no first n rows."""
    mark = draw_uniform(seed, F.col(key)) < rate
    return stream.where(~mark), stream.where(mark)


def monitor(logs: DataFrame, run: str = "run", step: str = "current_steps", total: str = "total_steps") -> DataFrame:
    """Latest status per run; state is one row per run. Use update mode on a stream."""
    fields = [c for c in logs.columns if c != run]
    last = logs.groupBy(run).agg(F.max_by(F.struct(*fields), F.col(step)).alias("_s"))
    out = last.select(run, *[F.col(f"_s.{c}").alias(c) for c in fields])
    # hundredths are rounded as a number of their own, as SQL does: Spark's round to two places goes by the decimal digits
    percent = F.when(F.col(total) != 0, F.round(F.col(step) / F.col(total) * 100 * 100) / 100).otherwise(F.lit(100.0))
    out = out.withColumn("percentage", percent)
    if {"elapsed_time", "remaining_time"} <= set(fields):
        out = out.withColumn("label", F.concat(
            F.lit("Running "), F.col(step), F.lit("/"), F.col(total), F.lit(": "), F.col("elapsed_time"),
            F.lit(" < "), F.col("remaining_time"),
        ))
    return out
