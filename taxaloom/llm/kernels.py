"""Vectorised text kernels on Arrow buffers: words, hashes, windows.

Every kernel works on one slice of a batch: whole texts laid end to end, at most ``SLICE_BYTES`` long (or one longer text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                      0xFF51AFD7ED558CCD, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03)]
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> U(31))) * ODD[4]
    h = (h ^ (h >> U(29))) * ODD[1]
    return h ^ (h >> U(32))


def mix_int(x: int) -> int:
    return int(mix(np.array([x], np.uint64))[0])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and the borders of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).cast(kind) if pa.types.is_string(column.type) else column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[borders[0]:borders[-1]] if len(column) and data is not None else np.zeros(0, np.uint8)
    return flat, borders - borders[0] if len(column) else np.zeros(1, np.int64)


def slices(borders: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text has a range of its own."""
    n, at = len(borders) - 1, 0
    while at < n:
        to = int(np.searchsorted(borders, borders[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base, size = int(ODD[0]), 1 << (n - 1).bit_length()
            for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def range_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each range; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.get(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_RANDOM[flat] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * ODD[3])


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of one slice."""

    def __init__(self, flat: np.ndarray, borders: np.ndarray) -> None:
        self.flat, self.borders, self.n = flat, borders, len(borders) - 1
        inside = ~_SEPARATOR[flat]
        first = np.zeros(len(flat) + 1, bool)
        first[borders] = True
        before = np.concatenate([[False], inside[:-1]]) if len(flat) else inside
        after = np.concatenate([inside[1:], [False]]) if len(flat) else inside
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.spans = np.searchsorted(self.starts, borders)  # words of text i: spans[i]:spans[i + 1]
        self.counts = np.diff(self.spans)
        self.inside = inside
        self._hashes: np.ndarray | None = None

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = range_hashes(self.flat, self.starts, self.ends)
        return self._hashes

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words within one text, and the index of each window's first word."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = (h * ODD[5]) ^ (h >> U(33))
            h += self.hashes[j:j + n] * ODD[j % 8]
        owner = self.owner()
        at = np.flatnonzero(owner[:n] == owner[size - 1:])
        return mix(h[at]), at

    def per_text(self, marked: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.concatenate([[0], np.cumsum(marked)])
        return total[self.borders[1:]] - total[self.borders[:-1]]

    def code_points(self) -> np.ndarray:
        """Code points inside words, by text."""
        return self.per_text(self.inside & ~_CONTINUED[self.flat])

    def per_word(self, marked: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marked)])
        return total[self.ends] - total[self.starts]


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of every window of ``width`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = best(out[:len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return best(out[:len(out) - rest], out[rest:]) if rest else out


def gram_hashes(padded: np.ndarray, n: int, k: int) -> np.ndarray:
    """Hashes of the k bytes (8 or more) that start at each of the first n positions; ``padded`` has 8 spare bytes or more behind them."""
    word = np.ndarray(n + k - 8, "<u8", padded, 0, (1,)) * ODD[0]
    word ^= word >> U(32)
    h = word[:n] * ODD[1]
    for i, at in enumerate([*range(8, k - 8, 8), k - 8]):
        h += word[at:at + n] * ODD[2 + i % 6]
    h ^= h >> U(32)
    h *= ODD[4]
    return h
