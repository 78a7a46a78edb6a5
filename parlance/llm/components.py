"""Connected components by distributed hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.tables import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node reachable.

    Each round a node and the root it points to take the smallest label next to them, then every node jumps to
    its label's label; the number of rounds grows with the logarithm of the longest path. Labels are written to
    the shared folder each round. Edges with a null end or equal ends make no link.
    """
    linked = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v")
    both = saved(linked.unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = saved(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        .select("node", F.least("node", "low").alias("root"), F.lit(True).alias("moved")), "labels",
    )
    while not labels.where("moved").isEmpty():
        old = labels.select("node", "root")
        near = both.join(old.select(F.col("node").alias("v"), F.col("root").alias("low")), "v").groupBy("u").agg(
            F.min("low").alias("low")
        )
        seen = old.join(near.withColumnRenamed("u", "node"), "node").where("low < root")
        hooks = seen.select("node", "low").unionByName(seen.select(F.col("root").alias("node"), "low")).groupBy(
            "node"
        ).agg(F.min("low").alias("low"))
        hooked = old.join(hooks, "node", "left").select(
            "node", F.col("root").alias("was"), F.least("root", "low").alias("root")
        )
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = saved(
            hooked.join(up, "root", "left").select(
                "node", F.least("root", "top").alias("root"),
                (F.least("root", "top") != F.col("was")).alias("moved"),
            ), "labels",
        )
    return labels.select("node", "root")
