"""Connected components of a graph of links, by alternating large-star and small-star rounds.

A round is one aggregate and one join over the edges; the number of rounds grows with the logarithm of the longest chain.  Every
round is checkpointed to the shared folder, so a lost executor costs a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _state(edges: DataFrame) -> tuple:
    """Size and digest of an edge list."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that a link names; root is the smallest node of its component."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, state = cut_lineage(edges), None
    while (now := _state(edges)) != state and now[0]:
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = _smallest(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()
