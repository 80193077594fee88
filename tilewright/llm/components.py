"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage


def _with_least(pairs: DataFrame, itself: bool) -> DataFrame:
    """``u, v, m``: m is the least of u and, over all its rows, v. Counts per u are combined before the shuffle."""
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    least = least.withColumn("m", F.least("u", "m")) if itself else least
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge; the root is the component's least node.

    Each round rewires every node's larger neighbours, then its smaller ones, to
    the least node it knows; the number of rounds grows with the logarithm of the
    longest chain. Edges are written to the shared folder after each half round.
    A hub is never gathered: its neighbours are only aggregated and joined. Loops,
    repeated edges and null nodes are ignored; no edges give no rows.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = stage(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stage(large, "large-star")
        small = _with_least(large, False)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u != v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())
