"""Connected components of a link table, as repeated joins on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` (two long columns) → ``(node, label)``: the least node reachable, for every linked node.

    Alternates two rewrites until no link changes: every larger neighbour of a node is
    linked to the node's least neighbour, then every smaller one and the node itself.
    Each round is two aggregations and two joins on the node; no neighbour list is ever
    gathered, so a hub is only a skewed join key, which adaptive execution splits. Rounds
    grow with the logarithm of the longest path. Every round is written to the shared folder.
    Self links and repeated links are fine; nodes without a link to another are not returned.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_min, "u")
        edges = staged(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(small_min.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
