"""Merkle manifest of a dataset with nested-interval labels, in DataFrame operations only.

A row is a leaf. The leaves of a group are numbered from 0 in the order of their keys; every node carries the interval
[lo, hi) of the leaf numbers it covers. Up the tree, each 8 consecutive nodes become the digest of their digests until one
is left, and the groups' last nodes, ordered by group, become a root the same way. Down the tree, the nodes of a level meet
their parents by a join on the cell of the parent's level that their interval falls into, and by containment; the
siblings of a node are what its parent's children hold outside its own interval. Proofs go down with the parents, so they are
held once for eight leaves and never shuffled per leaf. A level is written to the shared folder before the next is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.functions.ranks import join_null_safe
from parlance.llm.tables import saved

FAN = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIDES = "struct<left:array<binary>,right:array<binary>>"


def framed(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """SHA-256 of the texts joined, as binary; nodes are stored so and hashed as hex text."""
    return F.unhex(F.sha2(F.concat(*texts), 256))


def hexed(node: Column) -> Column:
    return F.lower(F.hex(node))


def joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, hexed), "")


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``place``, the 0-based position in the order of the named columns, nulls first.

    Rows are dealt by ranges of the order and counted by task; only one count a task meets in one place.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = saved(rows.select(*df.columns, F.shiftright("_at", 33).alias("_task"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_at")), "ordered")
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row for each task of the sort
    return rows.join(F.broadcast(offsets), "_task").select(*df.columns, (F.col("_before") + F.col("_at")).alias("place"))


def tree_levels(leaves: DataFrame) -> list[DataFrame]:
    """Levels 1, 2, ... over leaves (tree, n, lo, node, ...): tables (tree, n, lo, hi, node, children), a row for each node.

    ``n`` is the number of leaves of the tree, ``children`` what lies below, in order: lo, hi, node and, on level 1, the
    leaves' other columns. A tree ends at the level where a node covers [0, n); a lone leaf is passed on as it is.
    """
    rest = [c for c in leaves.columns if c not in ("tree", "n", "lo", "node")]
    largest = leaves.agg(F.max("n")).first()[0] or 1
    nodes, width, levels = leaves.withColumn("hi", F.col("lo") + 1), 1, []
    while width < largest or not levels:
        child = F.struct("lo", "hi", "node", *(rest if not levels else ()))
        width *= FAN
        runs = nodes.groupBy("tree", "n", F.floor(F.col("lo") / width).alias("cell")).agg(
            F.array_sort(F.collect_list(child)).alias("children")
        )
        made = digest(joined(F.transform("children", lambda c: c["node"])))
        levels.append(saved(runs.select(
            "tree", "n", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            F.when(F.col("n") == 1, F.col("children")[0]["node"]).otherwise(made).alias("node"), "children",
        ), f"level{len(levels) + 1}"))
        nodes = levels[-1].where(F.col("n") > width).select("tree", "n", "lo", "hi", "node")
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, node): the last node of every tree."""
    found = [level.where("lo = 0 AND hi = n").select("tree", "node") for level in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """(left, right): the nodes of a parent's children before and after the interval [lo, hi)."""
    sides = (F.filter(children, lambda c: c["hi"] <= lo), F.filter(children, lambda c: c["lo"] >= hi))
    return F.struct(*[F.transform(s, lambda c: c["node"]).alias(a) for s, a in zip(sides, ("left", "right"))])


def proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """A row for each leaf of the trees: its columns, ``path`` with the siblings of each level from the leaf up, and what
    ``above`` (tree, path, ...) has of its tree, whose path continues that of the leaf."""
    extra = [c for c in above.columns if c not in ("tree", "path")]
    state = None
    for k in range(len(levels), 0, -1):
        level = levels[k - 1]
        here = level.where("lo = 0 AND hi = n").join(above, "tree").select("tree", "n", "lo", "hi", "children", "path", *extra)
        if state is not None:
            width = FAN ** (k + 1)
            cell = F.floor(F.col("lo") / width)
            parents = state.select(
                F.col("tree").alias("_tree"), cell.alias("_cell"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                F.col("children").alias("_children"), "path", *extra,
            )
            inside = (F.col("tree") == F.col("_tree")) & (cell == F.col("_cell"))
            inside = inside & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            step = _siblings(F.col("_children"), F.col("lo"), F.col("hi"))
            below = level.where("hi - lo < n").join(parents, inside).select(
                "tree", "n", "lo", "hi", "children", F.concat(F.array(step), "path").alias("path"), *extra
            )
            here = here.unionByName(below)
        state = here
    leaves = state.withColumn("leaf", F.explode("children"))
    step = _siblings(F.col("children"), F.col("leaf.lo"), F.col("leaf.hi"))
    path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array(step), "path"))
    return leaves.select("tree", "leaf.*", path.alias("path"), *extra)


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(joined(s["left"]), joined(s["right"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(joined(s["left"]), hexed(node), joined(s["right"])))


def leaves_of(df: DataFrame, key: str, group: str, fields: Sequence[str], tampered: dict[str, Column] | None = None,
              when: Column | None = None) -> DataFrame:
    """(key, grp, node, other): the digest of the framed fields, and that of the changed fields where ``when`` holds."""
    own = digest(*[framed(F.col(f)) for f in fields])
    changed = digest(*[framed((tampered or {}).get(f, F.col(f))) for f in fields])
    other = F.when(when, changed) if when is not None else F.lit(None).cast("binary")
    return df.select(F.col(key).alias("key"), F.col(group).alias("grp"), own.alias("node"), other.alias("other"))


def forest(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """(levels of the groups' trees, levels of the tree over the groups, groups) for leaves (key, grp, node, ...).

    Groups: (grp, tree, start, n), numbered in their order. Rows of equal key are ordered by their digests.
    """
    placed = numbered(leaves, ["grp", "key", "node"])
    sizes = placed.groupBy("grp").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    groups = saved(numbered(sizes, ["grp"]).withColumnRenamed("place", "tree"), "groups")
    rest = [c for c in leaves.columns if c not in ("grp", "node")]
    own = join_null_safe(placed, groups, ["grp"]).select(
        "tree", "n", (F.col("place") - F.col("start")).alias("lo"), "node", *rest
    )
    levels = tree_levels(own)
    subroots = tops(levels).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("lo"), "node")
    upper = tree_levels(subroots.withColumn("n", F.lit(groups.count()).cast("long")))
    return levels, upper, groups


def manifest(df: DataFrame, key: str = "doc_id", group: str = "lang",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """All nodes of the trees: (grp, level, lo, hi, node), level 0 the leaves; grp null and level -1 the root."""
    levels, upper, groups = forest(leaves_of(df, key, group, fields))
    bottom = levels[0].select("tree", F.explode("children").alias("c")).select("tree", F.lit(0).alias("level"), "c.lo", "c.hi", "c.node")
    for k, level in enumerate(levels, 1):
        bottom = bottom.unionByName(level.where("n > 1").select("tree", F.lit(k).alias("level"), "lo", "hi", "node"))
    root = tops(upper).select(
        F.lit(None).cast(groups.schema["grp"].dataType).alias("grp"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("lo"),
        F.lit(None).cast("long").alias("hi"), "node",
    )
    rows = bottom.join(groups.select("tree", "grp"), "tree").select("grp", "level", "lo", "hi", "node").unionByName(root)
    return rows.withColumn("node", hexed(F.col("node")))


def verified_leaves(df: DataFrame, key: str = "doc_id", group: str = "lang",
                    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text",
                    one_in: int = 3) -> DataFrame:
    """One row per row of ``df``: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``one_in`` divides the unsigned CRC-32 of the key's decimal text, the leaf is tampered with before the root is folded
    anew: A-Z of its text become lower case. Null keys are not tampered with and come first, as do null groups; null
    fields count as ``-``, an empty text as ``0:``. Rows of equal key and text are leaves of their own, side by side. Long texts are
    hashed where they are read and never moved; an empty table gives no row. Columns other than ``fields`` are not read.
    """
    lower = F.translate(F.col(text), UPPER, UPPER.lower())
    tamper = F.crc32(F.col(key).cast("string").cast("binary")) % one_in == 0
    levels, upper, _ = forest(leaves_of(df, key, group, fields, {text: lower}, tamper))
    nothing = F.array().cast(f"array<{SIDES}>")
    root = tops(upper).select("tree", F.col("node").alias("root"), nothing.alias("path"))
    above = proofs(upper, root).select(F.col("lo").alias("tree"), F.col("node").alias("subroot"), "root", "path")
    rows = proofs(levels, saved(above, "above"))
    found = folded(F.coalesce("other", "node"), F.col("path"))
    return rows.select(
        F.col("key").alias(key), hexed(F.col("node")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        hexed(found).alias("folded_root"), F.coalesce(found == F.col("root"), F.lit(False)).alias("verified"),
    )
