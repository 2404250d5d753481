"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours; partial sums meet before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b): root is the smallest node of the component.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each moves links to smaller
    neighbours, the number of rounds grows as a logarithm of the nodes, and links never become
    more.  Every round is written to the checkpoint folder.  Links of a node to itself join nothing.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = cut_lineage(large)
        small = large.join(_least(large), "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = cut_lineage(small)
        # equal sums of scrambled links mean the same links
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
