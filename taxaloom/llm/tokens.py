"""Token ids of whole texts, by a public tokenizer, with one encoding for each distinct unit of a batch.

A text is cut where the tokenizer cuts it whatever stands around: a *unit* never takes part in a token of another unit.  For the byte-level
vocabulary these are single spaces and line feeds between characters that are certainly not white space, and the ends of letters before ASCII
punctuation; for the word vocabulary any ASCII white space.  Distinct units of a batch are encoded once and remembered by the worker, at most
``REMEMBERED`` of them.  As a line feed stands alone, new units of the byte-level vocabulary go to the tokenizer as the lines of a few texts.
"""

from __future__ import annotations

import os
import string
from itertools import chain

import numpy as np
import pyarrow as pa

from . import kernels

REMEMBERED = 2_000_000
#: units that one text for the tokenizer is joined from
JOINED = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
# a lead byte of two-byte characters that are never white space
_PLAIN_LEAD = (np.arange(256) >= 0xC3) & (np.arange(256) <= 0xDF)
_PLAIN_ASCII = (np.arange(256) < 0x80) & ~_SPACE
_LETTER = np.isin(np.arange(256), np.frombuffer(string.ascii_letters.encode(), np.uint8))
_PUNCTUATION = np.isin(np.arange(256), np.frombuffer(string.punctuation.encode(), np.uint8))
# second bytes of the letters among the characters of lead byte 0xC3; the other two are signs
_LATIN = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0) & (np.arange(256) != 0x97) & (np.arange(256) != 0xB7)
# bytes of characters that may be white space
_DOUBTFUL = _SPACE | (np.arange(256) == 0xC2) | (np.arange(256) >= 0xE0)


def public_path(name: str) -> str:
    """Place of a public vocabulary file; imported where it is needed, so that only tokenizing needs the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def spaced_units(flat: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of byte-level vocabularies: a space belongs to the word behind it, a line feed stands alone, punctuation begins after letters."""
    n = len(flat)
    edge = np.full(2, 0x20, np.uint8)
    padded = np.concatenate([edge, flat, edge])
    before, before2, after = padded[1:n + 1], padded[:n], padded[3:n + 3]
    plain_before = _PLAIN_ASCII[before] | ((before >= 0x80) & (before < 0xC0) & _PLAIN_LEAD[before2])
    plain_after = _PLAIN_ASCII[after] | _PLAIN_LEAD[after]
    first = np.zeros(n + 1, bool)
    first[borders] = True
    lone = plain_before & plain_after & ~first[:-1] & ~first[1:]
    cut = first.copy()
    cut[:-1] |= lone & ((flat == 0x20) | (flat == 0x0A))
    cut[1:] |= lone & (flat == 0x0A)
    # a run of letters is cut before whatever follows it; the bytes before a text are those of another one, but it is cut there anyway
    cut[:-1] |= _PUNCTUATION[flat] & (_LETTER[before] | (_LATIN[before] & (before2 == 0xC3)))
    at = np.flatnonzero(cut)
    return at[:-1], at[1:]


def word_units(flat: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = kernels.Words(flat, borders)
    return words.starts, words.ends


class UnitEncoder:
    """Encodes texts through their distinct units; one for each worker and vocabulary."""

    def __init__(self, path: str, spaced: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cut = spaced_units if spaced else word_units
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids if spaced else []
        self.feed = feed[0] if len(feed) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units laid end to end, and how many each has."""
        raw = flat.tobytes()
        # only ids are asked for, so the tokenizer need not follow offsets
        found = [e.ids for e in self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(starts, ends)], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _encoded_lines(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for units without white space but for a space before them, as lines of ``JOINED`` units each."""
        lengths = ends - starts + 1
        at = np.cumsum(lengths) - lengths
        lines = flat[np.minimum(np.repeat(starts - at, lengths) + np.arange(lengths.sum()), len(flat) - 1)]
        lines[at + lengths - 1] = 0x0A
        raw, borders = lines.tobytes(), np.append(at[::JOINED], len(lines))
        found = self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(borders[:-1], borders[1:])], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        feed = ids == self.feed
        closed = np.flatnonzero(feed)
        return ids[~feed], np.diff(closed, prepend=-1) - 1

    def _learn(self, hashes: np.ndarray, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        plain = np.zeros(len(starts), bool)
        if self.feed is not None:
            doubtful = np.concatenate([[0], np.cumsum(_DOUBTFUL[flat])])
            inner = starts + (flat[starts] == 0x20)
            plain = (doubtful[ends] == doubtful[inner]) & (inner < ends)
        for chosen, encoded in ((plain, self._encoded_lines), (~plain, self._encoded)):
            if not chosen.any():
                continue
            ids, sizes = encoded(flat, starts[chosen], ends[chosen])
            where = len(self.ids) + np.cumsum(sizes) - sizes
            at = np.searchsorted(self.hashes, hashes[chosen])
            self.hashes, self.where, self.sizes = (np.insert(old, at, new) for old, new in ((self.hashes, hashes[chosen]), (self.where, where), (self.sizes, sizes)))
            self.ids = np.concatenate([self.ids, ids])

    def _slice(self, flat: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = self.cut(flat, borders)
        hashes, first, which = np.unique(kernels.range_hashes(flat, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool) if not len(self.hashes) else self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes
        if new.any():
            self._learn(hashes[new], flat, starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.hashes, hashes)
        at = at[which]
        sizes = self.sizes[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.where[at] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, borders)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and the borders of the texts; null is empty."""
        flat, borders = kernels.text_bytes(column)
        ids, cuts, done = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
        for lo, hi in kernels.slices(borders):
            part, at = self._slice(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])
            ids.append(part)
            cuts.append(at[1:] + done)
            done += len(part)
        return np.concatenate(ids), np.concatenate(cuts)


_KNOWN: dict[tuple[str, bool], UnitEncoder] = {}


def encoder(path: str, spaced: bool) -> UnitEncoder:
    if (path, spaced) not in _KNOWN:
        _KNOWN[path, spaced] = UnitEncoder(path, spaced)
    return _KNOWN[path, spaced]


def with_end(ids: np.ndarray, borders: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids followed by the end id."""
    n = len(borders) - 1
    out = np.full(len(ids) + n, end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(borders))] = ids
    return out, borders + np.arange(n + 1)
