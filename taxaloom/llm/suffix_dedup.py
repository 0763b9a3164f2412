"""Removal of long repeated byte strings with run-compressed Burrows-Wheeler indexes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller key.  One index over the whole
corpus would not fit a task, so the strings are dealt out first, and exactly:

1.  Anchors.  Every string of ``LENGTH`` bytes contains its minimal ``GRAM``-byte hash; equal strings contain the same one.  Documents
    are dealt to batches; a batch sends the distinct anchor hashes with the number of documents that hold them to buckets of hashes, and
    learns which anchors other documents share.
2.  Contexts.  For shared anchors it sends the distinct contexts (the bytes that strings around the anchor can reach) with the smallest
    key that has them.  All strings that could be equal meet in one bucket.
3.  Index.  A bucket leaves out contexts that stand alone and takes the others in parts of whole anchors, as equal strings have the same
    one.  For each part it sorts the suffixes, keeps their Burrows-Wheeler transform as runs with samples at the ends of the runs of equal
    ``LENGTH``-byte prefixes (the smallest key of the run), and streams every context backwards through it: each step gives the matching
    statistic "at least LENGTH bytes match a document of a smaller key" for one string.
4.  A batch receives one mask a context, marks the strings and cuts the bytes.

An anchor with more than ``HOT`` documents does not meet in one task: each of its strings is dealt by its own 128-bit hash, with the
smallest key of the batch.  Batches read the same shuffled texts three times instead of sending them three times.

Every batch sends a row to nearly every bucket.  So that these rows do not grow with the square of the input, batches and buckets grow
with it up to a size that a task's memory allows, instead of only becoming more.

Null texts are empty, matches never cross documents, equal keys never match each other.  Rows with a null key neither lose nor cause
anything.  Texts of any length are one unit of a batch.  Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import kernels
from .common import free_name, parts_for, prepare, text_bytes_total

U = np.uint64
LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM          # bytes of a string that can lie on one side of its anchor
WIDE = LENGTH + SPAN          # bytes of a context
BATCH_BYTES = 1 << 20         # of a batch at least, and at most
BATCH_MOST = 4 << 20
BATCHES = 512                 # more only when all are of the largest size
BUCKET_ANCHORS = 250_000      # of a bucket at least, and at most
BUCKET_MOST = 1_000_000
BUCKETS = 256
HOT = 20_000
CHUNK = 100_000
LOWER = U(2**40 - 1)          # bits of a hash by which no bucket is told from another
PLACES = 1 << 15              # of a text whose hashes are compared at a time: they stay in the processor's cache
INDEXED = 1 << 11             # contexts of an index, if they have several anchors
END = 0xFF                    # never a byte of UTF-8
NO_KEY = np.iinfo(np.int64).max


class Batch:
    """Texts of one batch with their anchors. Everything derived is in an order that the texts' order does not change."""

    def __init__(self, texts: pa.ChunkedArray, keys: pa.ChunkedArray) -> None:
        flat, self.borders = kernels.text_bytes(texts)
        self.padded = np.concatenate([np.full(SPAN, END, np.uint8), flat, np.full(WIDE, END, np.uint8)])
        self.flat, n = self.padded[SPAN:SPAN + len(flat)], len(flat)
        self.keys = keys.combine_chunks().fill_null(NO_KEY).cast(pa.int64()).to_numpy(zero_copy_only=False)
        self.stop = np.where(self.keys == NO_KEY, self.borders[:-1], self.borders[1:])   # no string of a row reaches beyond
        parts = [self._anchors(lo, min(lo + PLACES, n)) for lo in range(0, n, PLACES)]
        self.at = np.concatenate([np.zeros(0, np.int64), *[at for at, _ in parts]])
        # minimal hashes crowd at small values; scrambled again they fill all buckets alike. The low byte is used for counts
        self.hash = kernels.mix(np.concatenate([np.zeros(0, np.uint64), *[grams for _, grams in parts]])) & U(2**64 - 256)
        self.row = self.rows(self.at)
        self.known, self.slot = np.unique(self.hash, return_inverse=True)

    def _anchors(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from lo to hi whose GRAM bytes have the minimal hash of a string that covers them, and the hashes."""
        first, last = max(lo - SPAN, 0), min(hi + SPAN, len(self.flat))
        if last - first < LENGTH:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        a, b = np.searchsorted(self.borders, [first, last - 1], "right")
        room = np.repeat((self.stop[a - 1:b] - first).astype(np.int32), np.diff(np.clip(self.borders[a - 1:b + 1], first, last))) - np.arange(last - first, dtype=np.int32)
        grams = kernels.gram_hashes(self.padded[SPAN + first:], last - first, GRAM)
        grams[room < GRAM] = U(2**64 - 1)
        low = kernels.sliding(grams, SPAN + 1, np.minimum)[:hi - first]      # minimum over the string at each place
        low[room[:len(low)] < LENGTH] = U(0)
        covering = np.zeros(SPAN + hi - lo, np.uint64)                      # by places from lo - SPAN
        covering[first - lo + SPAN:first - lo + SPAN + len(low)] = low
        own = slice(lo - first, hi - first)
        at = np.flatnonzero((kernels.sliding(covering, SPAN + 1, np.maximum) == grams[own]) & (room[own] >= GRAM))
        return at + lo, grams[own][at]

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, places, "right") - 1

    def whole(self, places: np.ndarray) -> np.ndarray:
        """Of places in rising order, those where a string starts."""
        return places[self.stop[self.rows(places)] - places >= LENGTH]

    def counts(self) -> np.ndarray:
        """Distinct anchors with the number of documents that hold them in the low byte, as ``_short`` has it."""
        pair = np.sort(self.slot * len(self.borders) + self.row)
        pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else pair
        return self.known | _short(np.bincount(pair // len(self.borders), minlength=len(self.known)))

    def contexts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts of the chosen anchors: one anchor of each, smallest key, bucket hash; and for each chosen anchor its context."""
        tags = np.zeros((len(chosen), 2), np.uint64)
        for lo in range(0, len(chosen), CHUNK):
            tags[lo:lo + CHUNK] = _row_hashes(self.context_bytes(chosen[lo:lo + CHUNK]))
        keys, hashes = self.keys[self.row[chosen]], self.hash[chosen]
        # equal contexts have the same anchor; its upper bits, which deal to buckets, and half a tag nearly always tell contexts apart
        short = (hashes & ~LOWER) | (tags[:, 0] & LOWER)
        order = np.argsort(short)
        differ = (tags[order][1:] != tags[order][:-1]).any(axis=1)
        if (differ & (short[order][1:] == short[order][:-1])).any():
            order = np.lexsort((tags[:, 1], tags[:, 0], hashes))
            differ = (tags[order][1:] != tags[order][:-1]).any(axis=1)
        fresh = np.concatenate([np.ones(min(1, len(order)), bool), differ])
        starts = np.flatnonzero(fresh)
        which = np.zeros(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        low = np.minimum.reduceat(keys[order], starts) if len(starts) else keys
        return chosen[order[starts]], low, hashes[order[starts]], which

    def context_bytes(self, chosen: np.ndarray) -> np.ndarray:
        at, row = self.at[chosen], self.row[chosen]
        return self._cut(at, np.minimum(at - self.borders[row], SPAN), np.minimum(self.stop[row] - at, LENGTH))

    def _cut(self, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        wide = np.lib.stride_tricks.sliding_window_view(self.padded, WIDE)[at]
        edge, place = np.flatnonzero((before < SPAN) | (after < LENGTH)), np.arange(WIDE)
        wide[edge] = np.where((place < (SPAN - before[edge])[:, None]) | (place >= (SPAN + after[edge])[:, None]), np.uint8(END), wide[edge])
        return wide


def _short(n: np.ndarray) -> np.ndarray:
    """Counts in a byte: exact below 128, beyond that in steps of an eighth of a doubling."""
    steps = 128 + np.floor(8 * np.log2(np.maximum(n, 128) / 128))
    return np.where(n < 128, n, np.minimum(steps, 255)).astype(np.uint64)


def _long(n: np.ndarray) -> np.ndarray:
    """Counts, as good as ``_short`` keeps them."""
    return np.where(n < U(128), n, 128 * np.exp2((n.astype(np.float64) - 128) / 8))


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view("<u8")
    one, two = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
    for j in range(words.shape[1]):
        one = kernels.mix(one + words[:, j] * kernels.ODD[j % 8])
        two = (two ^ (two >> U(29))) * kernels.ODD[4] + words[:, j] * kernels.ODD[(j + 3) % 8]
    return np.stack([one, kernels.mix(two)], axis=1)


def _by_bucket(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes dealt by their top bits."""
    top = (hashes >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cut = np.concatenate([[0], np.flatnonzero(top[1:] != top[:-1]) + 1, [len(top)]]) if len(top) else [0]
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield int(top[lo]), int(lo), int(hi)


ROWS = "batch long, kind int, bucket long, body binary"


def _table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    batch, kind, bucket, body = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"batch": pa.array(batch, pa.int64()), "kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int64()), "body": pa.array(body, pa.binary())})


# kinds of rows: 0 anchors and their replies, 1 contexts and masks, 2 strings of hot anchors and their replies

def _send_anchors(table: pa.Table, names: tuple[str, str, str], bits: int) -> pa.Table:
    batch = Batch(table.column(names[1]), table.column(names[0]))
    number, counts = table.column(names[2])[0].as_py(), batch.counts()
    return _table([(number, 0, bucket, counts[lo:hi].tobytes()) for bucket, lo, hi in _by_bucket(batch.known, bits)])


def _ordered(table: pa.Table) -> Iterator[tuple[int, int, int, bytes]]:
    return zip(*(table.column(c).to_pylist() for c in ("batch", "kind", "bucket", "body")))


def _share_anchors(table: pa.Table, hot: int) -> pa.Table:
    """For every list of anchors: one bit each, held by two documents or more; and one bit each, held by more than ``hot``."""
    sent = list(_ordered(table))
    parts = [np.frombuffer(body, np.uint64) for *_, body in sent]
    every = np.concatenate(parts)
    known, slot = np.unique(every & U(2**64 - 256), return_inverse=True)
    total = np.bincount(slot, weights=_long(every & U(255)), minlength=len(known))[slot]
    rows, lo = [], 0
    for (batch, _, bucket, _), part in zip(sent, parts):
        n = total[lo:lo + len(part)]
        rows.append((batch, 0, bucket, np.packbits(n > 1).tobytes() + np.packbits(n > hot).tobytes()))
        lo += len(part)
    return _table(rows)


def _flags(batch: Batch, replies: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the batch's distinct anchors: which are shared, which are hot."""
    by = {bucket: body for _, kind, bucket, body in _ordered(replies) if kind == 0}
    shared, hot = np.zeros(len(batch.known), bool), np.zeros(len(batch.known), bool)
    for bucket, lo, hi in _by_bucket(batch.known, bits):
        raw = np.frombuffer(by[bucket], np.uint8)
        half = len(raw) // 2
        shared[lo:hi] = np.unpackbits(raw[:half])[:hi - lo]
        hot[lo:hi] = np.unpackbits(raw[half:])[:hi - lo]
    return shared & ~hot, shared & hot


def _hot_strings(batch: Batch, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all strings around hot anchors, their 128-bit hashes in sorted order of the distinct ones, and the distinct one of each."""
    at = batch.at[hot[batch.slot]]
    near = (at[:, None] - np.arange(SPAN + 1)).ravel()
    near = batch.whole(np.unique(near[near >= 0]))
    tags = np.zeros((len(near), 2), np.uint64)
    for lo in range(0, len(near), CHUNK):
        part = near[lo:lo + CHUNK]
        rows = np.lib.stride_tricks.sliding_window_view(batch.flat, LENGTH)[part]
        tags[lo:lo + CHUNK] = _row_hashes(_words(rows))
    keys = batch.keys[batch.rows(near)]
    order = np.lexsort((keys, tags[:, 1], tags[:, 0]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (tags[order][1:] != tags[order][:-1]).any(axis=1)
    which = np.zeros(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    first = order[fresh]
    return near, which, np.concatenate([tags[first], keys[first].view(np.uint64)[:, None]], axis=1)


def _send_contexts(table: pa.Table, replies: pa.Table, names: tuple[str, str, str], bits: int) -> pa.Table:
    if not table.num_rows:
        return _table([])
    batch = Batch(table.column(names[1]), table.column(names[0]))
    number = table.column(names[2])[0].as_py()
    shared, hot = _flags(batch, replies, bits)
    each, keys, hashes, _ = batch.contexts(np.flatnonzero(shared[batch.slot]))
    text = batch.context_bytes(each)
    rows = [(number, 1, bucket, text[lo:hi].tobytes() + keys[lo:hi].tobytes()) for bucket, lo, hi in _by_bucket(hashes, bits)]
    if hot.any():
        strings = _hot_strings(batch, hot)[2]
        rows += [(number, 2, bucket, strings[lo:hi].tobytes()) for bucket, lo, hi in _by_bucket(strings[:, 0], bits)]
    return _table(rows)


class Marks:
    """Rows at which something begins, as bits; which of these a row belongs to is counted."""

    def __init__(self, begins: np.ndarray) -> None:
        self.bits = np.packbits(np.append(begins, np.zeros(-len(begins) % 64, bool)), bitorder="little").view("<u8")
        self.before = np.cumsum(np.bitwise_count(self.bits), dtype=np.int64) - np.bitwise_count(self.bits) - 1

    def of(self, rows: np.ndarray) -> np.ndarray:
        word = rows >> 6
        upto = (U(2) << (rows & 63).astype(np.uint64)) - U(1)
        return self.before[word] + np.bitwise_count(self.bits[word] & upto)


def _in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their values, equal ones as they stand; and the values in order. Joined to one number they are sorted much faster."""
    bits = U(len(values).bit_length())
    if int(values.max()) >> (64 - int(bits)):
        order = np.argsort(values, kind="stable")
        return order, values[order]
    both = np.sort((values << bits) | np.arange(len(values), dtype=np.uint64))
    return (both & ((U(1) << bits) - U(1))).astype(np.int32), both >> bits


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of short texts, each with its key."""

    def __init__(self, contexts: np.ndarray, keys: np.ndarray) -> None:
        inside = contexts != END
        sizes = inside.sum(axis=1)
        n = int((sizes + 1).sum())
        mark = np.ones((len(sizes), 1), bool)
        text = np.append(contexts, np.where(mark, np.uint8(END), np.uint8(0)), axis=1)[np.append(inside, mark, axis=1)]
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
        left = (np.cumsum(sizes + 1) - 1).astype(np.int32)[owner] - np.arange(n, dtype=np.int32)   # bytes before the end mark
        self.sizes, self.keys, self.n = sizes, keys, n
        order, prefixes, have = self._order(text, left, n)
        # the transform and its runs
        before = text[order - 1]
        begins = np.concatenate([[True], before[1:] != before[:-1]])
        self.run, self.runs = np.flatnonzero(begins), Marks(begins)
        self.letter = before[self.run]
        length = np.diff(np.append(self.run, n))
        by_letter = np.argsort(self.letter, kind="stable")
        self.base = np.empty(len(self.run), np.int64)                      # row to which a run's first row steps
        self.base[by_letter] = np.cumsum(length[by_letter]) - length[by_letter]
        # runs of rows with equal LENGTH-byte prefixes, sampled: the smallest key of the run. No shorter suffix stands between them
        remain = left[order]
        rows = np.flatnonzero(remain >= LENGTH)
        places = order[rows]
        front, back = prefixes[places], prefixes[places + (LENGTH - have)]
        first = np.flatnonzero(np.concatenate([[True], (front[1:] != front[:-1]) | (back[1:] != back[:-1])])) if len(rows) else rows
        begins[:] = False
        begins[rows[first]] = True
        self.same = Marks(begins)
        self.sample = np.minimum.reduceat(keys[owner[places]], first) if len(rows) else keys[:0]
        ends = np.flatnonzero(remain == 0)
        self.mark_rows = np.empty(len(sizes), np.int64)
        self.mark_rows[owner[order[ends]]] = ends

    @staticmethod
    def _order(text: np.ndarray, left: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Suffixes in order, equal ones in the order of their texts; and ranks by their first bytes, so many that two such ranks cover LENGTH bytes."""
        bits = n.bit_length()
        known = np.bincount(text, minlength=256) > 0
        code, width = (np.cumsum(known) - 1).astype(np.uint64)[text], max(1, int(known.sum() - 1).bit_length())

        def then(front: np.ndarray, at: int, back: np.ndarray, size: int, none: int) -> np.ndarray:
            """The values of places, and after them in so many bits the values of the places further on; none behind the end mark."""
            on = np.append(back[at:], np.zeros(min(at, n), back.dtype))
            return (front.astype(np.uint64) << U(size)) | np.where(left >= at, on, back.dtype.type(none)).astype(np.uint64)

        packed, have, end = code, 1, int(known.sum()) - 1
        for digit in f"{min(LENGTH, (64 - bits) // width):b}"[1:]:
            packed, end, have = then(packed, have, packed, width * have, end), end << (width * have) | end, 2 * have
            if digit == "1":
                packed, end, have = then(packed, have, code, width, int(known.sum()) - 1), end << width | (int(known.sum()) - 1), have + 1
        prefixes, covered = None, 0
        while True:
            order, values = _in_order(packed)
            if have > WIDE:
                return order, prefixes, covered
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(np.concatenate([[1], values[1:] != values[:-1]]))
            if LENGTH <= 2 * have <= 2 * LENGTH:
                prefixes, covered = rank, have
            packed, have = then(rank, have, rank, bits, 0), 2 * have

    def step(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one byte longer."""
        run = self.runs.of(row)
        return self.base[run] + row - self.run[run]

    def earlier(self) -> np.ndarray:
        """For every text and string start: whether its next LENGTH bytes match a text of a smaller key. All texts step in parallel."""
        out = np.zeros((len(self.sizes), SPAN + 1), bool)
        row = self.mark_rows.copy()
        alive = np.arange(len(row))
        for have in range(1, WIDE + 1):
            alive = alive[self.sizes[alive] >= have]
            row[alive] = self.step(row[alive])
            if have >= LENGTH:
                start = self.sizes[alive] - have
                ok = start <= SPAN
                found = self.sample[self.same.of(row[alive[ok]])] < self.keys[alive[ok]]
                out[alive[ok], start[ok]] = found
        return out


def _first_of(groups: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Smallest key of each row's group."""
    low = np.full(groups.max() + 1 if len(groups) else 0, NO_KEY)
    np.minimum.at(low, groups, keys)
    return low[groups]


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows filled up to whole words of eight bytes."""
    return np.concatenate([rows, np.zeros((len(rows), -rows.shape[1] % 8), np.uint8)], axis=1)


def _equal(tags: np.ndarray) -> np.ndarray:
    """Number of the group of equal hashes of 128 bits; half of the bits nearly always tells."""
    _, group = np.unique(tags[:, 0], return_inverse=True)
    second = np.zeros(len(tags), np.uint64)
    second[group] = tags[:, 1]
    if (second[group] != tags[:, 1]).any():
        _, group = np.unique(np.ascontiguousarray(tags).view([("a", "<u8"), ("b", "<u8")]).ravel(), return_inverse=True)
    return group


def _parts(rows: np.ndarray, anchor: np.ndarray) -> Iterator[np.ndarray]:
    """Rows by anchor, in parts of ``INDEXED`` or of one anchor; an anchor is never parted."""
    order = np.argsort(anchor)
    starts = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]])) if len(order) else order
    ends, lo = np.append(starts[1:], len(order)), 0
    while lo < len(order):
        hi = int(ends[max(np.searchsorted(ends, lo + INDEXED, "right") - 1, np.searchsorted(ends, lo, "right"))])
        yield rows[np.sort(order[lo:hi])]
        lo = hi


def _may_match(text: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Contexts that share half of the bytes around their anchor, on one side, with another context of it; equal strings need that."""
    out = np.zeros(len(text), bool)
    half = SPAN // 2
    for side in (text[:, SPAN - half:SPAN], text[:, SPAN + GRAM:SPAN + GRAM + half]):
        whole = np.flatnonzero((side != END).all(axis=1))
        key = _row_hashes(_words(side[whole]))[:, 0] + kernels.mix(anchor[whole] + U(1))
        _, which, held = np.unique(key, return_inverse=True, return_counts=True)
        out[whole[held[which] > 1]] = True
    return out


def _answer(table: pa.Table) -> pa.Table:
    """Masks of contexts (bit j: the string that starts j bytes before the anchor goes), and bits of strings."""
    sent = [x for x in _ordered(table) if x[1] == 1]
    rows = []
    if sent:
        counts = [len(body) // (WIDE + 8) for *_, body in sent]
        text = np.concatenate([np.frombuffer(body, np.uint8, n * WIDE).reshape(n, WIDE) for n, (*_, body) in zip(counts, sent)])
        keys = np.concatenate([np.frombuffer(body, np.int64, n, n * WIDE) for n, (*_, body) in zip(counts, sent)])
        whole = _equal(_row_hashes(text))
        mask = np.full(len(keys), 2**(SPAN + 1) - 1, np.uint32)
        lead = np.flatnonzero(keys == _first_of(whole, keys))               # the first document of each context
        mask[lead] = 0
        _, one = np.unique(whole[lead], return_index=True)
        one = lead[one]
        anchor = _row_hashes(_words(text[one, SPAN:SPAN + GRAM]))[:, 0]
        fit = _may_match(text[one], anchor)
        by_whole = np.zeros(len(keys), np.uint32)
        for chosen in _parts(one[fit], anchor[fit]):
            part = text[chosen]
            before = (part[:, :SPAN] != END).sum(axis=1)
            found = RunIndex(part, keys[chosen]).earlier()
            bits = np.zeros(len(chosen), np.uint32)
            for start in range(SPAN + 1):
                on = np.flatnonzero(found[:, start] & (start <= before))
                bits[on] |= np.uint32(1) << (before[on] - start).astype(np.uint32)
            by_whole[whole[chosen]] = bits
        mask[lead] = by_whole[whole[lead]]
        lo = 0
        for n, (batch, _, bucket, _) in zip(counts, sent):
            rows.append((batch, 1, bucket, mask[lo:lo + n].tobytes()))
            lo += n
    sent = [x for x in _ordered(table) if x[1] == 2]
    if sent:
        parts = [np.frombuffer(body, np.uint64).reshape(-1, 3) for *_, body in sent]
        every = np.concatenate(parts)
        group = _equal(every[:, :2])
        keys = np.ascontiguousarray(every[:, 2]).view(np.int64)
        gone, lo = _first_of(group, keys) < keys, 0
        for part, (batch, _, bucket, _) in zip(parts, sent):
            rows.append((batch, 2, bucket, np.packbits(gone[lo:lo + len(part)]).tobytes()))
            lo += len(part)
    return _table(rows)


def _marked(batch: Batch, replies: pa.Table, bits: int) -> np.ndarray:
    """Bytes of the batch that go."""
    shared, hot = _flags(batch, replies, bits)
    answers = {(kind, bucket): body for _, kind, bucket, body in _ordered(replies)}
    start = np.zeros(len(batch.flat) + 1, np.int8)
    chosen = np.flatnonzero(shared[batch.slot])
    if len(chosen):
        _, keys, hashes, which = batch.contexts(chosen)
        mask = np.concatenate([np.frombuffer(answers[1, bucket], np.uint32) for bucket, _, _ in _by_bucket(hashes, bits)])[which]
        at, row = batch.at[chosen], batch.row[chosen]
        mask[batch.keys[row] > keys[which]] = 2**(SPAN + 1) - 1
        some = mask > 0
        at, row, mask = at[some], row[some], mask[some]
        first, last = batch.borders[row], batch.stop[row] - LENGTH
        for j in range(SPAN + 1):
            start[(at - j)[((mask >> np.uint32(j)) & np.uint32(1) > 0) & (at - j >= first) & (at - j <= last)]] = 1
    if hot.any():
        near, which, strings = _hot_strings(batch, hot)
        gone = np.concatenate([np.unpackbits(np.frombuffer(answers[2, bucket], np.uint8))[:hi - lo] for bucket, lo, hi in _by_bucket(strings[:, 0], bits)] or [np.zeros(0, np.uint8)]).astype(bool)
        if len(near):
            keys = np.ascontiguousarray(strings[:, 2]).view(np.int64)
            out = gone[which] | (batch.keys[batch.rows(near)] > keys[which])
            start[near[out]] = 1
    on = np.flatnonzero(start)
    start[on + LENGTH] -= 1                      # no two strings start at one place
    return np.cumsum(start[:-1], dtype=np.int8) > 0


REPORT = StructType([
    StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()),
    StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))), StructField("kept_text", StringType())])


def _cut(table: pa.Table, replies: pa.Table, names: tuple[str, str, str], bits: int, wanted: list[str]) -> pa.Table:
    key, text, number = names
    if table.num_rows:
        batch = Batch(table.column(text), table.column(key))
        gone, borders = _marked(batch, replies, bits), batch.borders
        edge = np.zeros(len(gone) + 1, bool)
        edge[borders] = True
        starts = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone)[:-1]))
        ends = np.flatnonzero(gone & (edge[1:] | ~np.append(gone, False)[1:])) + 1
        spans = np.searchsorted(starts, borders)                   # runs of row i: spans[i]:spans[i + 1]
        removed = np.append(0, np.cumsum(ends - starts))[spans]
        left, kept = batch.flat[~gone], borders - removed
        bodies = [left[lo:hi].tobytes() for lo, hi in zip(kept[:-1], kept[1:])]
        report = {"n_bytes": np.diff(borders), "n_removed": np.diff(removed), "n_spans": np.diff(spans)}
        if "kept_sha256" in wanted:
            report["kept_sha256"] = [hashlib.sha256(body).hexdigest() for body in bodies]
        if "spans" in wanted:
            base = np.repeat(borders[:-1], np.diff(spans))
            report["spans"] = pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"]))
        if "kept_text" in wanted:
            report["kept_text"] = [body.decode("utf-8", "ignore") for body in bodies]
    else:
        report = {name: [] for name in wanted}
    out = table.drop_columns([number])
    for name in wanted:
        kind = pa.string() if name in ("kept_sha256", "kept_text") else pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])) if name == "spans" else pa.int64()
        out = out.append_column(f"{number}_{name}", pa.array(report[name], kind) if isinstance(report[name], (list, np.ndarray)) else report[name])
    return out


def _grown(total: int, least: int, most: int, wanted: int) -> int:
    """How many groups: of the least size until there are as many as wanted, then of a growing size, then of the largest."""
    return max(parts_for(total, most), min(parts_for(total, least), wanted))


def _dealt(total: int) -> tuple[int, int]:
    """Batches, and bits of the number of buckets, for so many bytes of text; one of 15 places is an anchor."""
    return _grown(total, BATCH_BYTES, BATCH_MOST, BATCHES), (_grown(total // 15, BUCKET_ANCHORS, BUCKET_MOST, BUCKETS) - 1).bit_length()


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", wanted: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"), hot: int = HOT) -> DataFrame:
    """All columns of ``docs`` and a struct column ``cut`` (the last one) with the wanted fields of ``REPORT`` (keys are integers)."""
    prepare(docs.sparkSession)
    number = free_name(docs.columns, "_batch")
    total = text_bytes_total(docs, text)
    batches, bits = _dealt(total)
    names = (key, text, number)
    dealt = docs.withColumn(number, F.pmod(F.xxhash64(F.col(key)), F.lit(batches)))
    texts = dealt.groupBy(number)

    anchors = texts.applyInArrow(lambda t: _send_anchors(t, names, bits), ROWS)
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: _share_anchors(t, hot), ROWS)
    contexts = texts.cogroup(shared.groupBy("batch")).applyInArrow(lambda t, r: _send_contexts(t, r, names, bits), ROWS)
    answers = contexts.groupBy("bucket").applyInArrow(_answer, ROWS)
    replies = shared.unionByName(answers).groupBy("batch")

    fields = [REPORT[name] for name in wanted]
    schema = StructType([*docs.schema.fields, *[StructField(f"{number}_{f.name}", f.dataType) for f in fields]])
    cut = texts.cogroup(replies).applyInArrow(lambda t, r: _cut(t, r, names, bits, list(wanted)), schema)
    report = F.struct(*[F.col(f"{number}_{f.name}").alias(f.name) for f in fields])
    return cut.select(*docs.columns, report.alias(free_name(docs.columns, "cut")))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of their text; a character of which a byte went goes whole. ``length`` follows the text."""
    out = dedup(docs, key, text, ("kept_text", "n_removed"))
    cut = F.col(out.columns[-1])
    new = F.when(cut["n_removed"] > 0, cut["kept_text"]).otherwise(F.col(text))
    columns = [new.alias(c) if c == text else F.coalesce(F.length(new), F.lit(0)).cast(docs.schema[c].dataType).alias(c) if c == length else F.col(c) for c in docs.columns]
    return out.select(*columns)
