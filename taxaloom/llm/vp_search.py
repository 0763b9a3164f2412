"""Nearest neighbours by largest inner product, with vantage-point trees over shards.

Inner products become distances: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have |x' - q'|^2 = M^2 + |q|^2 - 2 x.q.
Vectors are dealt to shards of about ``SHARD_ROWS`` by their id.  A task builds one tree for its shard, each node splitting its vectors at the
median distance from a vantage point, and walks it with a block of queries at once.  A query enters the far side of a node only if
``slack * |d - median|`` is less than its current k-th distance: the triangle inequality, relaxed by a factor; factor one restores exact search.
Every query meets every shard and every vector is in a tree; a shard returns its k best, and the best k of all shards are kept.  Leaves
are scored in double precision on the original vectors, so scores and ties are exact.

Equal vectors of a shard are one point of its tree with their ids in order.  Vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors are compared with vectors of the same length only.  Repeated rows of one id are
one candidate.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, prepare, stored

K = 20
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 96
SLACK = 1.0


class Tree:
    """Vantage-point tree over the rows of a matrix; nodes are tuples, leaves index arrays."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 5) -> None:
        self.points, self.leaf, self.rng = points, leaf, np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        centre = self.points[self.rng.choice(rows)]
        d = np.sqrt(((self.points[rows] - centre) ** 2).sum(axis=1))
        median = float(np.median(d))
        near = d <= median
        if near.all():
            order = np.argsort(d, kind="stable")
            near = np.zeros(len(rows), bool)
            near[order[:len(rows) // 2]] = True
            median = float(d[order[len(rows) // 2 - 1]])
        return centre, median, self._grow(rows[near]), self._grow(rows[~near])


class Walk:
    """Search of one tree with a block of queries: ``best`` holds each query's k largest products, ``found`` the points that gave them."""

    def __init__(self, tree: Tree, vectors: np.ndarray, queries: np.ndarray, bound: float, k: int, slack: float) -> None:
        self.tree, self.vectors, self.queries, self.slack, self.k = tree, vectors, queries, slack, k
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1)
        self.lift = bound * bound + (queries ** 2).sum(axis=1)
        self.places = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        if len(queries):
            self._enter(tree.root, np.arange(len(queries)))

    def _reach(self, who: np.ndarray) -> np.ndarray:
        """Distance within which a point would still be among the k best; rounding cannot shrink it."""
        worst = self.best[who, -1]
        square = np.where(np.isinf(worst), np.inf, self.lift[who] - 2 * worst)
        return np.sqrt(np.maximum(square, 0)) + 1e-6 * np.sqrt(self.lift[who])

    def _enter(self, node, who: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            self._score(node, who)
            return
        centre, median, near, far = node
        d = np.sqrt(((self.places[who] - centre) ** 2).sum(axis=1))
        inside = d <= median
        for first, second, mine in ((near, far, inside), (far, near, ~inside)):
            if mine.any():
                self._enter(first, who[mine])
                left = who[mine][self.slack * np.abs(d[mine] - median) <= self._reach(who[mine])]
                if len(left):
                    self._enter(second, left)

    def _score(self, rows: np.ndarray, who: np.ndarray) -> None:
        for lo in range(0, len(who), 256):
            part = who[lo:lo + 256]
            # one order of additions for every pair, so equal vectors have equal scores
            scores = np.einsum("id,jd->ij", self.queries[part], self.vectors[rows], optimize=False)
            every = np.concatenate([self.best[part], scores], axis=1)
            names = np.concatenate([self.found[part], np.broadcast_to(rows, scores.shape)], axis=1)
            order = np.lexsort((names, -every), axis=1)[:, :self.k]
            self.best[part] = np.take_along_axis(every, order, axis=1)
            self.found[part] = np.take_along_axis(names, order, axis=1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1)


EMPTY = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def _search(vectors: pa.Table, queries: pa.Table, k: int, slack: float, leaf: int) -> pa.Table:
    if not vectors.num_rows or not queries.num_rows:
        return EMPTY
    x, ids = _matrix(vectors.column("vector")), vectors.column("id").to_numpy()
    order = np.lexsort((ids, *x.T[::-1]))
    x, ids = x[order], ids[order]
    fresh = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
    start = np.flatnonzero(fresh)
    points, ends = x[start], np.concatenate([start[1:], [len(ids)]])
    # points are numbered by their smallest id, so that ties of different vectors fall to it
    by_id = np.argsort(ids[start], kind="stable")
    points, start, ends = points[by_id], start[by_id], ends[by_id]
    norms = (points ** 2).sum(axis=1)
    bound = float(np.sqrt(norms.max()))
    lifted = np.concatenate([points, np.sqrt(np.maximum(bound * bound - norms, 0))[:, None]], axis=1)
    q, names = _matrix(queries.column("vector")), queries.column("id").to_numpy()
    # one place more than k: the query itself may hold one
    walk = Walk(Tree(lifted, leaf), points, q, bound, k + 1, slack)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, name in enumerate(names):
        got, scores = [], []
        for point, score in zip(walk.found[i], walk.best[i]):
            if point < 0:
                break
            own = ids[start[point]:min(ends[point], start[point] + k + 1)]
            got.append(own)
            scores.append(np.full(len(own), score))
        if not got:
            continue
        found, score = np.concatenate(got), np.concatenate(scores)
        keep = found != name
        found, score = found[keep], score[keep]
        top = np.lexsort((found, -score))[:k]
        out.append((np.full(len(top), name), found[top], score[top]))
    if not out:
        return EMPTY
    a, b, c = (np.concatenate(x) for x in zip(*out))
    return pa.table({"query_id": a, "vec_id": b, "score": c})


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def search(table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, slack: float = SLACK,
           shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf: int = LEAF) -> DataFrame:
    """The k nearest of every query row: query_id, rank, vec_id, score."""
    prepare(table.sparkSession)
    clean = table.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    clean = stored(clean.dropDuplicates(["id"]))
    sizes = clean.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = parts_for(sizes[0], shard_rows), parts_for(sizes[1], query_rows)
    dim, spot = F.size("vector").alias("dim"), F.xxhash64("id")
    held = clean.select(dim, F.pmod(spot, F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "vector")
    asked = clean.where("asks").select(dim, F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")).alias("shard"), F.pmod(spot, F.lit(blocks)).cast("int").alias("block"), "id", "vector")
    keys = ("dim", "shard", "block")
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(lambda v, q: _search(v, q, k, slack, leaf), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
