"""Merkle manifest of a table: a root over all rows, and for every row the proof that leads from its leaf to the root.

The rows of a group are leaves of one tree in the order of their keys; every ``fanout`` nodes in a row become their hash, until one, the subroot, is
left; the subroots are leaves of the last tree in the order of their groups, null first.  Leaves are placed by sorting ranges (no group meets in one
task) and cut into blocks of ``fanout ** block_levels``, the partitions of the exchange.  A block hashes its own leaves and then takes part in a
butterfly: in round r the blocks that differ in digit r of their number swap the roots of the subtrees they stand in, and each of them hashes the
parent for itself.  So after the last round every block holds the siblings of all its ancestors, and nothing is sent down again.  Where the last
subtree is ragged its members stand in for those it lacks.  A round is one shuffle of a row per block with at most ``fanout`` rows in a group.

The place of rows with equal keys is decided by their leaves; rows equal in both may swap places, which changes no hash.  A null key comes before all
others, a null group is a group of its own.  Texts are hashed where they are read and move nowhere.  Other columns pass through, whatever their
names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.ordering import running_total
from .common import free_name, prepare, stored

FANOUT = 8
BLOCK_LEVELS = 4  # 4,096 leaves a block

PROOF = "array<struct<spot: int, siblings: string>>"
_HEX = 64  # characters of a digest


def leaf_of(*values: Column) -> Column:
    """Hash of a row: each value as its UTF-8 byte count, a colon and itself, or ``-`` where it is null."""
    parts = [F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(
        F.substr(step["siblings"], F.lit(1), step["spot"] * _HEX), node, F.substr(step["siblings"], step["spot"] * _HEX + 1)), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: step["siblings"]), "")


def _parents(nodes: list[str], fanout: int) -> list[str]:
    return [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]


def _levels(leaves: list[str], n: int, fanout: int, height: int) -> list[list[str]]:
    """The levels of a block of a tree of ``n`` leaves, from the leaves up to the block's own root."""
    levels = [leaves]
    while len(levels) <= height and n > fanout ** (len(levels) - 1):
        levels.append(_parents(levels[-1], fanout))
    return levels


def _block_root(table: pa.Table, fanout: int, height: int) -> pa.Table:
    table = table.sort_by("p")
    n = table["n"][0].as_py()
    root = _levels(table["leaf"].to_pylist(), n, fanout, height)[-1][0]
    return pa.table({"t": table["t"][:1], "b": table["b"][:1], "n": table["n"][:1], "node": [root]})


def _siblings(nodes: list[str], fanout: int) -> list[str]:
    """For every node the other nodes of its run."""
    runs = ("".join(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout))
    return [run[:_HEX * j] + run[_HEX * (j + 1):] for run in runs for j in range(len(run) // _HEX)]


def _prove(rows: pa.Table, upper: pa.Table, wanted: list[str], fanout: int, height: int) -> pa.Table:
    """Proofs of the leaves of a block: their siblings within it, then those that the block holds already."""
    rows = rows.sort_by("p")
    if not rows.num_rows:
        return rows.select(wanted)
    count, n = rows.num_rows, rows["n"][0].as_py()
    below = _levels(rows["leaf"].to_pylist(), n, fanout, height)[:-1]
    above = upper["proof"][0].as_py()
    texts, spots, at = [], [], []
    own = np.arange(count)
    for nodes in below:
        at.append(len(texts) + own)
        texts += _siblings(nodes, fanout)
        spots.append(own % fanout)
        own = own // fanout
    for step in above:
        at.append(np.full(count, len(texts)))
        texts.append(step["siblings"])
        spots.append(np.full(count, step["spot"]))
    deep = len(at)
    steps = np.stack(at, 1).ravel() if deep else np.empty(0, np.int64)
    flat = pa.StructArray.from_arrays([pa.array(np.stack(spots, 1).ravel().astype(np.int32) if deep else [], pa.int32()),
                                       pa.array(texts, pa.string()).take(pa.array(steps))], names=["spot", "siblings"])
    proofs = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * deep, pa.int32()), flat)
    out = rows.append_column("proof", proofs)
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([upper[name][0].as_py()] * count, pa.string()))
    return out.select(wanted)


def _swap(blocks: DataFrame, r: int, fanout: int) -> DataFrame:
    """One round: every block learns the siblings of its ancestor ``r`` levels above the block roots, and hashes the next one."""
    lower = fanout ** r
    width = F.ceil(F.col("blocks") / lower)
    index, low = F.floor(F.col("b") / lower), F.col("b") % lower
    members = F.col("blocks") - (width - 1) * lower  # of the last subtree of this level
    stands_in = (index == width - 1) & (members < lower) & (index % fanout > 0)
    lanes = F.when(stands_in, F.sequence(low, F.lit(lower - 1).cast("long"), members)).otherwise(F.array(low))
    sent = blocks.select("t", "b", "blocks", "node", "proof", (index % fanout).cast("int").alias("digit"), F.floor(index / fanout).alias("run"), low.alias("low"), F.explode(lanes).alias("lane"))
    own = F.col("lane") == F.col("low")
    member = F.struct("digit", "node", own.alias("own"), "b", "blocks", F.when(own, F.col("proof")).alias("proof"))
    met = sent.groupBy("t", "run", "lane").agg(F.array_sort(F.collect_list(member)).alias("met"))  # at most fanout members
    nodes = F.array_join(F.transform("met", lambda m: m["node"]), "")
    out = met.select("t", "met", F.sha2(nodes, 256).alias("parent"), F.explode(F.filter("met", lambda m: m["own"])).alias("me"))
    others = F.array_join(F.transform(F.filter("met", lambda m: m["digit"] != F.col("me.digit")), lambda m: m["node"]), "")
    step = F.array(F.struct(F.col("me.digit").alias("spot"), others.alias("siblings")))
    more = F.ceil(F.col("me.blocks") / lower) > 1  # else the tree was finished in an earlier round
    return out.select("t", "me.b", "me.blocks", F.when(more, F.col("parent")).otherwise(F.col("me.node")).alias("node"),
                      F.when(more, F.concat("me.proof", step)).otherwise(F.col("me.proof")).alias("proof"))


def _butterfly(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """One row per block: tree, block, the root of the tree and the siblings of all ancestors of the block."""
    size = fanout ** height
    kind = placed.schema["t"].dataType.simpleString()
    roots = placed.select("t", "b", "n", "p", "leaf").groupBy("t", "b").applyInArrow(lambda x: _block_root(x, fanout, height), f"t {kind}, b long, n long, node string")
    blocks = stored(roots.select("t", "b", F.ceil(F.col("n") / size).alias("blocks"), "node", F.array().cast(PROOF).alias("proof")))
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    rounds = 0
    while most > fanout ** rounds:
        blocks = _swap(blocks, rounds, fanout)
        rounds += 1
    return stored(blocks) if rounds else blocks


def _proofs(placed: DataFrame, blocks: DataFrame, columns: list[str], fanout: int, height: int) -> DataFrame:
    """``columns`` of the placed leaves, subroot, root and proof."""
    fields = [placed.schema[c] for c in columns]
    schema = StructType([*fields, *StructType.fromDDL(f"subroot string, root string, proof {PROOF}").fields])
    sides = placed.groupBy("t", "b").cogroup(blocks.groupBy("t", "b"))
    return sides.applyInArrow(lambda rows, upper: _prove(rows, upper, schema.names, fanout, height), schema)


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "lang", leaf: str = "leaf", fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """All columns of ``rows`` and a struct ``merkle`` (the last column): place in the group, subroot, root, proof. Give narrow rows: they are written and sorted."""
    prepare(rows.sparkSession)
    columns = rows.columns
    size = fanout ** block_levels
    # trees are named so that names order as groups do: null first, then by bytes
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    given = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], name.alias("t"), F.col(leaf).alias("leaf"))

    def in_blocks(leaves: DataFrame, by: str) -> DataFrame:
        return running_total(leaves, ["t"], by, ties=["leaf"], name="p", whole="n").withColumn("b", F.floor(F.col("p") / size))

    placed = in_blocks(stored(given), f"c{columns.index(key)}")
    blocks = _butterfly(placed, fanout, block_levels)
    # the last tree: one leaf for each group, in the order of the names
    subroots = blocks.where("b = 0").select(F.lit("").alias("t"), F.col("t").alias("tree"), F.col("node").alias("leaf"))
    above = in_blocks(subroots, "tree")
    tops = _butterfly(above, fanout, block_levels).select("t", "b", "proof", F.col("node").alias("root"), F.lit(None).cast("string").alias("subroot"))
    tops = _proofs(above, tops, ["tree"], fanout, block_levels).select(F.col("tree").alias("t"), "root", F.col("proof").alias("_top"))
    upper = blocks.join(tops, "t").select("t", "b", "root", F.col("node").alias("subroot"), F.concat("proof", "_top").alias("proof"))
    out = _proofs(placed, upper, [*[f"c{i}" for i in range(len(columns))], "p"], fanout, block_levels)
    merkle = F.struct(F.col("p").alias("place"), "subroot", "root", "proof")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], merkle.alias(free_name(columns, "merkle")))
