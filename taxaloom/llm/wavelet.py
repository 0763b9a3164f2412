"""Token ids as wavelet matrices, one compressed file for each shard of consecutive documents.

A wavelet matrix holds a sequence as one bit plane for every bit of an id; a plane is the next bit of all ids, zeros sorted before ones for the
plane below.  With counts of ones at every ``BLOCK_BITS`` bits the file answers access, rank (occurrences before a place), select (place of an
occurrence) and count in one step a plane, without unpacking.  Documents are sorted by key with a range shuffle; a task fills shards of about
``SHARD_TOKENS`` ids with whole documents and writes each as one binary value.

Null and empty texts are the end id alone.  Repeated keys are ordered by their text, null keys come first.  A text longer than a shard has a
shard of its own.  An empty table writes no shard.  Only the key (an integer) and the text are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import in_batches, parts_for, prepare, text_bytes_total

MAGIC = b"WVM1"
HEAD = struct.Struct("<4sIQQ")            # magic, planes, documents, ids
BLOCK_BITS = 512
SHARD_TOKENS = 1 << 20
DECODED = 1 << 17                         # ids that are put in place at a time
PART_BYTES = 24 << 20
END = 0
VOCABULARY = "byte_bpe_50k.json"
NO_KEY = -(1 << 63)


class WaveletMatrix:
    """Bit planes from the highest bit down; ``zeros[k]`` ids have bit 0 in plane k."""

    def __init__(self, n: int, planes: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.planes, self.zeros, self.ones = n, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray, depth: int) -> "WaveletMatrix":
        n = len(ids)
        width = -(-n // BLOCK_BITS) * (BLOCK_BITS // 8)
        planes = np.zeros((depth, width), np.uint8)
        zeros = np.zeros(depth, np.int64)
        order = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        for k in range(depth):
            bit = order & order.dtype.type(1 << depth - 1 - k) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[k, :len(packed)] = packed
            zeros[k] = n - np.count_nonzero(bit)
            below = np.empty_like(order)
            np.compress(~bit, order, out=below[:zeros[k]])
            np.compress(bit, order, out=below[zeros[k]:])
            order = below
        per_block = np.bitwise_count(planes).reshape(depth, -1, BLOCK_BITS // 8).sum(axis=2, dtype=np.uint32)
        ones = np.concatenate([np.zeros((depth, 1), np.uint32), np.cumsum(per_block, axis=1, dtype=np.uint32)], axis=1)
        return cls(n, planes, zeros, ones)

    def _rank1(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each place."""
        block = at // BLOCK_BITS
        found = self.ones[k][block].astype(np.int64)
        for byte in range(BLOCK_BITS // 8):          # whole bytes of the block, then the bits of the last one
            spot = block * (BLOCK_BITS // 8) + byte
            room = np.clip(at - spot * 8, 0, 8)
            has = room > 0
            if not has.any():
                break
            kept = self.planes[k][np.minimum(spot[has], self.planes.shape[1] - 1)] & ((np.uint16(1) << room[has].astype(np.uint16)) - 1).astype(np.uint8)
            found[has] += np.bitwise_count(kept)
        return found

    def _bit(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[k][at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the given places."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for k in range(len(self.planes)):
            bit, one = self._bit(k, at), self._rank1(k, at)
            out = (out << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit, self.zeros[k] + one, at - one)
        return out

    def _narrow(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        ends = np.array([lo, hi], np.int64)
        depth = len(self.planes)
        for k in range(depth):
            one = self._rank1(k, ends)
            ends = self.zeros[k] + one if token >> (depth - 1 - k) & 1 else ends - one
        return int(ends[0]), int(ends[1])

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in places lo to hi."""
        first, last = self._narrow(token, lo, self.n if hi is None else hi)
        return last - first if token >> len(self.planes) == 0 else 0

    def rank(self, token: int, at: int) -> int:
        return self.count(token, 0, at)

    def select(self, token: int, nth: int) -> int:
        """Place of the nth occurrence (from 0) of a token; -1 if there are fewer."""
        if not 0 <= nth < self.count(token):
            return -1
        depth = len(self.planes)
        at = self._narrow(token, 0, self.n)[0] + nth
        for k in reversed(range(depth)):
            bit = token >> (depth - 1 - k) & 1
            at = self._select_bit(k, bit, at - int(self.zeros[k]) if bit else at)
        return at

    def _select_bit(self, k: int, bit: int, nth: int) -> int:
        held = self.ones[k].astype(np.int64)
        held = held if bit else np.arange(len(held)) * BLOCK_BITS - held
        block = int(np.searchsorted(held, nth, "right")) - 1
        size = BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[k][block * size:(block + 1) * size], bitorder="little") == bit
        return block * BLOCK_BITS + int(np.flatnonzero(bits)[nth - held[block]])

    def decode(self) -> np.ndarray:
        """All ids in order, planes from the lowest up."""
        depth = len(self.planes)
        kind = np.uint16 if depth <= 16 else np.uint32
        low = np.zeros(self.n, kind)
        for k in reversed(range(depth)):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            out, zero, one = np.empty(self.n, kind), 0, int(self.zeros[k])
            for lo in range(0, self.n, DECODED):
                part, into = bit[lo:lo + DECODED], out[lo:lo + DECODED]
                ones = np.flatnonzero(part)
                into[np.flatnonzero(~part)] = low[zero:zero + len(part) - len(ones)]
                into[ones] = low[one:one + len(ones)] | kind(1 << (depth - 1 - k))
                zero, one = zero + len(part) - len(ones), one + len(ones)
            low = out
        return low.astype(np.uint32)


def to_bytes(matrix: WaveletMatrix, keys: np.ndarray, borders: np.ndarray) -> bytes:
    """One file: head, keys, borders of the documents, zeros, counts of ones, bit planes."""
    parts = [HEAD.pack(MAGIC, len(matrix.planes), len(keys), matrix.n), keys.astype("<i8"), borders.astype("<u8"), matrix.zeros.astype("<u8"), matrix.ones.astype("<u4"), matrix.planes]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts)


def from_bytes(raw: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    magic, depth, docs, n = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a wavelet matrix file")
    at, blocks = HEAD.size, -(-n // BLOCK_BITS)

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    keys, borders, zeros = take("<i8", docs), take("<u8", docs + 1).astype(np.int64), take("<u8", depth).astype(np.int64)
    ones = take("<u4", depth * (blocks + 1)).reshape(depth, -1)
    planes = take("u1", depth * blocks * (BLOCK_BITS // 8)).reshape(depth, -1)
    return WaveletMatrix(n, planes, zeros, ones), keys, borders


FILES = "part int, shard int, first_key long, n_docs long, n_tokens long, file binary"


def _write_shards(batches: Iterator[pa.RecordBatch], path: str, end: int, depth: int, limit: int) -> Iterator[pa.RecordBatch]:
    part, shard = TaskContext.get().partitionId(), 0
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def shut() -> pa.RecordBatch:
        nonlocal shard, waiting
        keys, ids = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
        borders = np.concatenate([[0], np.cumsum(np.concatenate([w[2] for w in waiting]))])
        raw = to_bytes(WaveletMatrix.build(ids, depth), keys, borders)
        row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array(keys[:1]), pa.array([len(keys)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([raw], pa.binary())],
                                         names=["part", "shard", "first_key", "n_docs", "n_tokens", "file"])
        shard, waiting = shard + 1, []
        return row

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, borders = tokens.with_end(*tokens.encoder(path, True).encode(batch.column(1)), end)
        keys = batch.column(0).fill_null(NO_KEY).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(keys):
            room = limit - sum(len(w[1]) for w in waiting)
            to = int(np.searchsorted(borders, borders[at] + room, "right")) - 1
            if to <= at:
                if waiting:
                    yield shut()
                    continue
                to = at + 1                   # a text longer than a shard
            waiting.append((keys[at:to], ids[borders[at]:borders[to]], np.diff(borders[at:to + 1])))
            at = to
    if waiting:
        yield shut()


def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end: int = END, shard_tokens: int = SHARD_TOKENS, depth: int = 16) -> None:
    """Write the shards to ``folder``: a Parquet table with one file image a row."""
    prepare(docs.sparkSession)
    parts = parts_for(text_bytes_total(docs, text), PART_BYTES)
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    dealt = narrow.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    path = vocabulary or tokens.public_path(VOCABULARY)
    dealt.mapInArrow(lambda batches: _write_shards(batches, path, end, depth, shard_tokens), FILES).write.parquet(folder)


def _read_shards(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for part, shard, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
        matrix, keys, borders = from_bytes(raw)
        ids = matrix.decode().astype("<u4")
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(borders[:-1], borders[1:])]
        n = len(keys)
        out.append((np.full(n, part, np.int32), np.full(n, shard, np.int32), keys, borders[:-1], np.diff(borders), np.array(crc, np.int64)))
    columns = [np.concatenate(c) for c in zip(*out)]
    keys = pa.array(columns[2], mask=columns[2] == NO_KEY)
    arrays = [pa.array(columns[0]), pa.array(columns[1]), keys, *map(pa.array, columns[3:])]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "shard", "key", "local", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """One row a document, decoded from the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    prepare(spark)
    files = spark.read.schema(FILES).parquet(folder)
    shards = files.select("part", "shard", "n_tokens")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row a range of keys
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select("part", "shard", (F.col("_base") + F.col("_in")).alias("_offset"))
    decoded = files.select("part", "shard", "file").mapInArrow(in_batches(_read_shards), "part int, shard int, key long, local long, n_tokens long, ids_crc32 long")
    return decoded.join(offsets, ["part", "shard"]).select(F.col("key").alias(key), (F.col("_offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
