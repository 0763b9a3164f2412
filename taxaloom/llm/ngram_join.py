"""Similarity self-join on word n-gram sets: MinHash bands for candidates, exact Jaccard on the full sets for links.

Texts with one set of n-grams are one class, joined once; the class counts its members.  Band hashes of the classes are shuffled, and
classes that share a band are candidates.  A band that at most ``PAIRED`` classes share gives pairs, each compared once.  Larger bands are
not expanded into pairs: the classes that they connect form a group, the group is dealt into blocks of about ``BLOCK`` classes, and every
two blocks meet in a task that counts common n-grams as a matrix product and returns one row a class: how many rows it is linked to, and a
class it hangs together with.  So rows grow with the classes of a group times its blocks, not with its pairs, and no link is left out.

The band count is chosen for ``RECALL`` at the threshold; links above it are found with higher probability still.  Found links are exact.
Texts of one to four words have one n-gram, the whole word sequence; texts without words (null, empty, blank) link to nothing.  Rows with a
null key are returned with null class and no links.  Repeated rows are copies of each other.  An empty table gives an empty result; only
the key and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import in_batches, prepare, stored
from .components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 128
PAIRED = 32
BLOCK = 256
COLUMNS = 4096


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold is found with the wanted probability."""
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = threshold ** rows
        bands = max(1, math.ceil(math.log1p(-recall) / math.log1p(-hit))) if 1e-12 < hit < 1 else most + 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def shingles(words: kernels.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the distinct n-grams of every text, sorted by both."""
    h, at = words.windows(n)
    owner = words.owner()[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        total = kernels.mix(words.counts[short].astype(np.uint64))
        for j in range(n - 1):
            has = words.counts[short] > j
            total[has] = (total[has] ^ (total[has] >> kernels.U(33))) * kernels.ODD[6] + words.hashes[words.spans[short[has]] + j]
        h, owner = np.concatenate([h, kernels.mix(total)]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], h[fresh]


def _set_digests(owner: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """16 bytes for each text's set, and the set's size."""
    sizes = np.bincount(owner, minlength=rows)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    one, two = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    full = sizes > 0
    if full.any():
        one[full] = np.add.reduceat(kernels.mix(h ^ kernels.ODD[0]), first[full])
        two[full] = np.add.reduceat(kernels.mix(h ^ kernels.ODD[2]), first[full])
    return np.stack([kernels.mix(one + sizes.astype(np.uint64)), two], axis=1), sizes


def _binary16(pairs: np.ndarray, missing: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(pairs.astype(">u8")).tobytes()
    return pa.array([None if m else raw[i * 16:i * 16 + 16] for i, m in enumerate(missing)], pa.binary())


def _signed(batch: pa.RecordBatch, n: int, bands: int, rows: int, with_bands: bool) -> pa.RecordBatch:
    """key, cid, size and band hashes (or the text itself) of a batch (key, text)."""
    flat, borders = kernels.text_bytes(batch.column(1))
    odd = np.random.default_rng(7).integers(1, 2**63, bands * rows, dtype=np.uint64) * kernels.U(2) + kernels.U(1)
    salt = np.random.default_rng(8).integers(1, 2**63, bands * rows, dtype=np.uint64)
    ids, sizes, hashes = [], [], []
    for lo, hi in kernels.slices(borders):
        words = kernels.Words(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])
        owner, h = shingles(words, n)
        digest, size = _set_digests(owner, h, hi - lo)
        ids.append(digest)
        sizes.append(size)
        if with_bands:
            full = np.flatnonzero(size)
            first = (np.cumsum(size) - size)[full]
            out = np.zeros((hi - lo, bands), np.uint64)
            for band in range(bands if len(full) else 0):
                total = np.full(len(full), kernels.U(band + 1)) * kernels.ODD[7]
                for k in range(band * rows, band * rows + rows):
                    low = np.minimum.reduceat((h ^ salt[k]) * odd[k], first)
                    total = kernels.mix(total + low)
                out[full, band] = total
            hashes.append(out)
    size = np.concatenate(sizes)
    columns = [batch.column(0), _binary16(np.concatenate(ids), size == 0), pa.array(size)]
    if with_bands:
        grid = np.concatenate(hashes)[size > 0]
        offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(grid.ravel().view(np.int64))))
    else:
        columns.append(batch.column(1))
    return pa.RecordBatch.from_arrays(columns, names=["key", "cid", "size", "bands" if with_bands else "text"])


def _differences(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
    """a, b, size of the symmetric difference, for a batch (a, b, text_a, text_b)."""
    found = []
    (one, at_one), (two, at_two) = (kernels.text_bytes(batch.column(i)) for i in (2, 3))
    for lo, hi in kernels.slices(at_one + at_two):
        sets = []
        for flat, borders in ((one, at_one), (two, at_two)):
            words = kernels.Words(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])
            sets.append(shingles(words, n))
        owner, h = (np.concatenate(x) for x in zip(*sets))
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        shared = np.flatnonzero((h[1:] == h[:-1]) & (owner[1:] == owner[:-1]))
        found.append(np.bincount(owner, minlength=hi - lo) - 2 * np.bincount(owner[shared], minlength=hi - lo))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(found))], names=["a", "b", "d"])


def _measured(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Exact d of every pair (a, b) of classes."""
    left = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(in_batches(_differences, n), "a binary, b binary, d long")


def _block_links(table: pa.Table, n: int, near: int, far: int) -> pa.Table:
    """Links between the two blocks of a task (or inside one): per class the linked rows, and the smallest class it hangs together with."""
    order = np.argsort(table.column("cid").to_numpy(zero_copy_only=False))
    table = table.take(pa.array(order))
    flat, borders = kernels.text_bytes(table.column("text"))
    owners, hashes = [], []
    for lo, hi in kernels.slices(borders):
        words = kernels.Words(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])
        owner, h = shingles(words, n)
        owners.append(owner + lo)
        hashes.append(h)
    owner, rows = np.concatenate(owners), table.num_rows
    sizes = np.bincount(owner, minlength=rows)
    _, column, held = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    common = held > 1                                     # n-grams of one text alone take no part in an intersection
    place = np.cumsum(common) - 1
    owner, column = owner[common[column]], place[column[common[column]]]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    shared = np.zeros((rows, rows), np.float32)
    for lo in range(0, int(common.sum()), COLUMNS):
        part = slice(*np.searchsorted(column, [lo, lo + COLUMNS]))
        held_by = np.zeros((rows, COLUMNS), np.float32)
        held_by[owner[part], column[part] - lo] = 1
        shared += held_by @ held_by.T
    both = sizes[:, None] + sizes[None, :]
    linked = far * (both - 2 * shared.astype(np.int64)) <= near * both
    np.fill_diagonal(linked, False)
    block, one, two = (table.column(c).to_numpy() for c in ("block", "one", "two"))
    if one[0] != two[0]:                                  # pairs inside a block belong to the task of that block alone
        linked &= block[:, None] != block[None, :]
    reach = linked @ table.column("m").to_numpy()
    label, before = np.arange(rows), None
    while before is None or (label != before).any():
        before = label
        label = np.minimum(label, np.where(linked, label[None, :], rows).min(axis=1))
    cids = table.column("cid").combine_chunks()
    some = np.flatnonzero(reach)
    return pa.table({"cid": cids.take(pa.array(some)), "k": pa.array(reach[some], pa.int64()), "near": cids.take(pa.array(label[some]))})


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
         paired: int = PAIRED, block: int = BLOCK) -> DataFrame:
    """One row per input row: key, class_id (smallest key of its component of links), copy_id (smallest key with the same n-gram set),
    n_links (rows linked to it, copies included), n_grams."""
    prepare(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    t = Fraction(threshold).limit_denominator(10_000)
    near, far = int(t.denominator - t.numerator), int(t.denominator + t.numerator)  # J >= t: far * d <= near * (|A| + |B|), d the symmetric difference
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    signed = stored(narrow.mapInArrow(in_batches(_signed, n, bands, rows, True), f"key {kind}, cid binary, size long, bands array<long>"))
    named = signed.where("cid IS NOT NULL AND key IS NOT NULL")
    classes = stored(named.groupBy("cid").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("m"), F.first("size").alias("size")))

    # candidates: classes that share a band
    heads = named.join(classes.select("cid", F.col("rep").alias("key")), ["cid", "key"], "left_semi").dropDuplicates(["cid"])
    listed = heads.select("cid", "size", F.explode("bands").alias("band"))
    bands_of = listed.groupBy("band").agg(F.min("cid").alias("pivot"), F.count(F.lit(1)).alias("c")).where("c > 1")
    placed = stored(listed.join(bands_of, "band"))
    groups = stored(components(placed.where(F.col("c") > paired), "cid", "pivot"))
    few = placed.where(F.col("c") <= paired)
    one, two = few.select("band", F.col("cid").alias("a"), F.col("size").alias("size_a")), few.select("band", F.col("cid").alias("b"), F.col("size").alias("size_b"))
    fits = F.lit(t.numerator) * F.greatest("size_a", "size_b") <= F.lit(t.denominator) * F.least("size_a", "size_b")
    pairs = one.join(two, "band").where("a < b").where(fits).select("a", "b").distinct()
    of = [groups.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    pairs = pairs.join(of[0], "a", "left").join(of[1], "b", "left").where("root_a IS NULL OR root_b IS NULL OR root_a <> root_b").select("a", "b")
    pairs = stored(pairs)

    # whole texts of the candidates
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(groups.select("node")).distinct()
    # the keys grow with the corpus, so they are never broadcast, however few they are
    keys = wanted.join(classes, "cid").select(F.col("rep").alias("key")).distinct().hint("merge")
    texts = narrow.join(keys, "key", "left_semi")
    texts = stored(texts.mapInArrow(in_batches(_signed, n, bands, rows, False), f"key {kind}, cid binary, size long, text string")
                   .where("cid IS NOT NULL").select("cid", "text").dropDuplicates(["cid"]))
    sizes = classes.select("cid", "size", "m")

    # links of pairs, and of blocks
    side = [sizes.select(F.col("cid").alias(c), F.col("size").alias(f"size_{c}"), F.col("m").alias(f"m_{c}")) for c in ("a", "b")]
    close = _measured(pairs, texts, n).join(side[0], "a").join(side[1], "b").where(F.lit(far) * F.col("d") <= F.lit(near) * (F.col("size_a") + F.col("size_b")))
    close = stored(close.select("a", "b", "m_a", "m_b"))
    spread = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = groups.join(spread, "root").select("root", "blocks", F.col("node").alias("cid"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    dealt = dealt.join(texts, "cid").join(sizes.select("cid", "m"), "cid")
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("root", "cid", "m", "text", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    inside = stored(met.groupBy("root", "one", "two").applyInArrow(lambda x: _block_links(x, n, near, far), "cid binary, k long, near binary"))

    # results by class, then by row
    counts = inside.select("cid", "k").union(close.select("a", "m_b")).union(close.select("b", "m_a")).groupBy("cid").agg(F.sum("k").alias("k"))
    roots = components(inside.select(F.col("cid").alias("a"), F.col("near").alias("b")).union(close.select("a", "b")), "a", "b")
    linked = classes.join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    linked = linked.select("cid", "rep", F.coalesce("root", "cid").alias("root"), (F.col("m") + F.coalesce("k", F.lit(0)) - 1).alias("n_links"))
    tops = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    found = signed.select("key", "cid", "size").join(linked.join(tops, "root").drop("root"), "cid", "left")
    known = F.col("key").isNotNull()
    return found.select(
        F.col("key").alias(key), F.when(known, F.coalesce("class_id", "key")).alias("class_id"), F.when(known, F.coalesce("rep", "key")).alias("copy_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"), F.col("size").alias("n_grams"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class of near duplicates stays, the one with the smallest key; rows with a null key stay, and so do rows that repeat the kept key."""
    found = join(docs, key, text, **options)
    gone = found.where(F.col("class_id") < F.col(key)).select(F.col(key).alias("_gone")).distinct()
    left = docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")
    return left.select(*docs.columns)
