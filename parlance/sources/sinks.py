"""Exports: dialogue JSONL, releases, predictions, accept/reject tables, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.operators.checks import assert_roles
from parlance.operators.sampling import holdout

LAYOUTS = ("messages", "conversations", "text")


def export_records(df: DataFrame, layout: str = "messages", keep: Sequence[str] = ()) -> DataFrame:
    """Canonical rows as export records; rows without prompt or response are skipped."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown export layout {layout!r}")
    has_prompt = F.coalesce(F.size("_prompt") > 0, F.lit(False))
    if layout == "text":
        return df.where(has_prompt).select(*keep, F.get("_prompt", F.lit(0))["content"].alias("text"))
    rows = df.where(has_prompt & F.coalesce(F.size("_response") > 0, F.lit(False)))
    turns = F.concat("_prompt", "_response")
    system = F.coalesce("_system", F.lit(""))
    if layout == "messages":
        head = F.when(
            system != "", F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
        ).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
        return rows.select(
            *keep, F.concat(head, turns).alias("messages"), F.nullif(F.col("_tools"), F.lit("")).alias("tools")
        )

    def name(role: Column) -> Column:
        return F.concat(F.upper(F.substring(role, 1, 1)), F.lower(F.substring(role, 2, 1000)))

    return rows.select(
        *keep, system.alias("system"),
        F.transform(turns, lambda m: F.struct(name(m["role"]).alias("from"), m["content"].alias("value"))).alias("conversations"),
        F.lit("User").alias("mask"),
    )


def export_jsonl(df: DataFrame, path: str, layout: str = "messages") -> None:
    """Null members are left out of the written objects."""
    export_records(df, layout).write.option("ignoreNullFields", True).json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    df.select("prompt", "predict", "label").write.option("ignoreNullFields", False).json(path)


def split_accept_reject(df: DataFrame, issues: str = "issues") -> tuple[DataFrame, DataFrame]:
    """Each row goes to exactly one table; rejects keep their reasons."""
    clean = F.coalesce(F.size(issues), F.lit(0)) == 0
    return df.where(clean).drop(issues), df.where(~clean)


def content_digest(df: DataFrame, column: str = "messages", digits: int = 4) -> DataFrame:
    """One row: the root of a hash tree over a table's rows, the same for any order and partitioning.

    A row is the SHA-256 of its JSON. Equal rows are one entry with their number, so a row held by a third of the table is
    merged before the shuffle. Entries lie under the first ``digits`` hex digits of their hash, which are spread evenly:
    take one digit more for each 16 times as many rows. A node is the digest of its entries in order, its parent of two
    digits less the digest of its nodes, up to the root. Any row that is changed, added or left out changes the root.
    """
    row = F.sha2(F.to_json(F.struct(column), {"ignoreNullFields": "false"}), 256)
    nodes = df.select(row.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).select(
        F.substring("_h", 1, digits).alias("_at"), F.concat_ws(":", "_h", "_n").alias("_h")
    )
    for left in [*range(digits - 2, 0, -2), 0]:
        runs = nodes.groupBy("_at").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("_h")), ","), 256).alias("_d"))
        # sorted with its place, a node's digest stays where its digits put it
        nodes = runs.select(F.substring("_at", 1, left).alias("_at"), F.concat_ws("=", "_at", "_d").alias("_h"))
    return nodes.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("_h")), ","), 256).alias("digest"))


def release_tables(df: DataFrame, key: str, val_size: int = 1000, min_level: int = 2, seed: int = 0,
                   level: str = "level", messages: str = "messages") -> tuple[DataFrame, DataFrame]:
    """(train, validation): validation rows only from ``min_level`` up; every row must be system/user/assistant."""
    checked = assert_roles(df, messages=messages)
    return holdout(checked, val_size, F.col(level) >= min_level, key, seed)


def manifest(train: DataFrame, validation: DataFrame, build_id: str, seed: int, level: str = "level") -> DataFrame:
    """(section, name, rows): split sizes and level counts over both splits."""
    both = train.select(level, F.lit("train").alias("_s")).unionAll(validation.select(level, F.lit("validation").alias("_s")))
    pairs = F.explode(F.array(
        F.struct(F.lit("splits").alias("section"), F.col("_s").alias("name")),
        F.struct(F.lit("levels").alias("section"), F.col(level).cast("string").alias("name")),
    ))
    return both.select(pairs.alias("p")).groupBy("p.section", "p.name").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "build_id", F.lit(build_id)
    ).withColumn("seed", F.lit(seed))


def release(df: DataFrame, root: str, build_id: str, seed: int, key: str, val_size: int = 1000, min_level: int = 2,
            level: str = "level", messages: str = "messages") -> str:
    """Write train and validation JSONL and the manifest below a digest-named folder; returns the folder."""
    train, val = release_tables(df, key, val_size, min_level, seed, level, messages)
    digest = content_digest(train, messages).first()["digest"]
    out = f"{root.rstrip('/')}/v{build_id.replace('.', '-')}-{digest[:8]}"
    train.select(messages).write.json(f"{out}/train")
    val.select(messages).write.json(f"{out}/validation")
    manifest(train, val, build_id, seed, level).coalesce(1).write.json(f"{out}/manifest")
    return out


def preview(df: DataFrame, key: str, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 0) in key order, with the table's row count."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(key).offset(page * size).limit(size).withColumn("total", total)
