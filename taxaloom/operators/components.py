"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import cut_lineage, stored

#: Links that a task joins to trees at once; it holds their nodes.
CHUNK = 200_000


def _trees(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v), chunk by chunk, to (node, root): every node of the chunk with the smallest node it is joined to by links of the chunk."""
    up: dict = {}

    def top(x):
        while (y := up[x]) != x:
            up[x] = x = up[y]
        return x

    def shut() -> pa.RecordBatch:
        nodes = list(up)
        return pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(map(top, nodes), kind)], names=["node", "root"])

    held = 0
    for batch in batches:
        kind = batch.column(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            up.setdefault(u, u)
            up.setdefault(v, v)
            a, b = top(u), top(v)
            if a != b:
                up[max(a, b)] = min(a, b)
        held += batch.num_rows
        if held >= chunk:
            yield shut()
            up, held = {}, 0
    if up:
        yield shut()


def _round(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours, then its smaller ones, to the smallest node it knows. Links point to smaller nodes."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    met = large.join(least, "u")
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, u: str, v: str, chunk: int = CHUNK) -> tuple[DataFrame, int]:
    """(node, root) of every node that is linked to another, the root being the smallest node of the component, and the rounds it took.

    Links are sorted and joined to trees ``chunk`` by chunk inside the tasks, so links between near nodes are done with at once. Trees that share a node
    are linked by their roots, and only these links contract to stars, in a number of rounds that grows with the logarithm of the longest path. A round
    is a few joins of links; the smallest neighbour is an aggregate, so a node with many links is combined before the shuffle and its join is split by
    adaptive execution.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    given = stored(links.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")))
    kind = given.schema["u"].dataType.simpleString()
    dealt = given.repartitionByRange("u", "v").sortWithinPartitions("u", "v")
    trees = stored(dealt.mapInArrow(lambda batches: _trees(batches, chunk), f"node {kind}, root {kind}"))
    least = stored(trees.groupBy("node").agg(F.min("root").alias("least"), F.max("root").alias("most")))
    # a node of several trees links the roots of them all to the smallest one
    shared = least.where("least <> most").select("node", "least")
    found = cut_lineage(trees.join(shared, "node").where("root <> least").select(F.col("root").alias("u"), F.col("least").alias("v")).distinct())
    before, rounds = None, 0
    while (now := state(found)) != before and now[0]:
        before, rounds = now, rounds + 1
        found = cut_lineage(_round(found))
    tops = found.select(F.col("u").alias("least"), F.col("v").alias("_top"))
    return stored(least.join(tops, "least", "left").select("node", F.coalesce("_top", "least").alias("root"))), rounds
