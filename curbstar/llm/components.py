"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows ``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node.

    Each round hooks every node's larger neighbours to its smallest neighbour, then does the same
    with the smaller ones, until the links form stars. The number of rounds grows with the
    logarithm of the longest chain; a node with very many links is pre-aggregated before each
    shuffle. Links from a node to itself are ignored; no links give no rows.
    """
    edges = scratch.write(
        f"{name}-0",
        links.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
    )
    seen, round_no = None, 0
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, round_no = mark, round_no + 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least.select("u", F.least("u", "m").alias("m")), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = scratch.write(f"{name}-{round_no}-large", large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), "m")
        edges_next = scratch.write(
            f"{name}-{round_no}", least.union(small).toDF("u", "v").where("u != v").distinct()
        )
        scratch.drop(f"{name}-{round_no}-large")
        edges = edges_next
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.toDF("node", "root").union(roots.select("node", F.col("node").alias("root")))
