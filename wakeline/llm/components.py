"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the component's smallest node.

    Each round hangs every node and its neighbours under the smallest node
    it knows, first the larger neighbours, then the smaller ones, until no
    edge changes. A node's neighbours are never gathered: their minimum is a
    partial aggregate, and hubs are rows of a join that Spark can split.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        done = cut_lineage(small.select("e.u", "e.v").where("u <> v").distinct())
        same = done.count() == edges.count() and done.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = done
        if same:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
