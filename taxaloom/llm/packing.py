"""Best-fit packing planned on the histogram of lengths.

Texts become token ids with an end id; those longer than a sequence are cut into full pieces and a rest.  The histogram of piece lengths has
at most ``capacity`` rows, whatever the corpus, so the plan is made on the driver: lengths from long to short, each placed into the open
sequences with the least room that suffices, all pieces of one length at a time.  The plan is a list of runs "ranks of a length -> sequences";
runs become slots, and the pieces, ranked within their length, take their slots by a join on (length, rank).  Ranks are sums over hash ranges
of a length plus a rank inside one range, so one common length does not meet in a task.

Null and empty texts are one end id.  Null keys, repeated rows and drawn copies are pieces like others.  An empty table gives an empty
result.  Only the key and the text are read; other columns may have any name.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import in_batches, parts_for, prepare, stored

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
RANGE_ROWS = 2000
SLOTS_PER_ROW = 100_000


def _pieces(batch: pa.RecordBatch, path: str, end: int, capacity: int, with_ids: bool) -> pa.RecordBatch:
    ids, borders = tokens.with_end(*tokens.encoder(path, False).encode(batch.column(1)), end)
    sizes = np.diff(borders)
    count = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(sizes[row] - start, capacity)
    first = borders[:-1][row] + start
    little = ids.astype("<u4")
    crc = [zlib.crc32(little[a:a + n].tobytes()) for a, n in zip(first, length)]
    columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
    names = ["key", "piece", "start", "length", "ids_crc32"]
    if with_ids:  # pieces lie end to end in the order of the texts
        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([first, [len(ids)]]).astype(np.int32)), pa.array(ids.astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def cut_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end: int = END, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for every piece: key, piece, start, length, ids_crc32, and the ids on request."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(key).alias("key"), text)
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return narrow.mapInArrow(in_batches(_pieces, vocabulary or tokens.public_path(VOCABULARY), end, capacity, with_ids), schema)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, pieces to a sequence, offset) of a best-fit-decreasing packing.

    Sequences with equal room are kept as intervals of ids. A piece goes where least room is left over; if room for a second one of its
    length remains, that sequence is the best fit for the next piece too, so a sequence takes as many as fit.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []                     # rooms with open sequences, ascending
    used = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_by_room:
                bisect.insort(rooms, room)
            open_by_room[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            spot = bisect.bisect_left(rooms, length)
            if spot == len(rooms):
                each = capacity // length
                room, first, n = capacity, used, -(-left // each)
                used += n
            else:
                room = rooms[spot]
                first, n = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(spot)
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if left and n:                    # fewer than a sequence takes
                runs.append((length, rank, left, first, left, capacity - room))
                put(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            put(room, first, n)
    return runs


def slots(spark: SparkSession, runs: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """(length, rank) -> sequence_id, offset for every piece; runs are cut so that one row of the plan makes a bounded number of slots."""
    cut = [(length, rank, at, min(SLOTS_PER_ROW, count - at), first, each, offset) for length, rank, count, first, each, offset in runs for at in range(0, count, SLOTS_PER_ROW)]
    plan = spark.createDataFrame(cut, "length long, first_rank long, at long, n long, first long, each long, base long")
    place = plan.select("*", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("i"))
    return place.select("length", (F.col("first_rank") + F.col("i")).alias("rank"), (F.col("first") + F.floor(F.col("i") / F.col("each"))).alias("sequence_id"),
                        (F.col("base") + F.col("i") % F.col("each") * F.col("length")).alias("offset"))


def ranked(pieces: DataFrame, total: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rank`` from 0 within a length."""
    ranges = parts_for(total, range_rows)
    dealt = pieces.withColumn("_range", F.pmod(F.xxhash64("key", "piece"), F.lit(ranges)))
    before = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("_n")).select("length", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_range").orderBy("key", "piece", "ids_crc32"))
    return dealt.withColumn("_in", inside).join(offsets, ["length", "_range"]).withColumn("rank", F.col("_before") + F.col("_in") - 1).drop("_range", "_in", "_before")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end: int = END, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there; sequences are filled from 0 without gaps."""
    spark = docs.sparkSession
    pieces = stored(cut_pieces(docs, key, text, vocabulary, end, capacity, with_ids))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}  # at most ``capacity`` rows
    placed = ranked(pieces, sum(histogram.values())).join(slots(spark, best_fit(histogram, capacity)), ["length", "rank"])
    return placed.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
