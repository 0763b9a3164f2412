"""Licence detection by ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z) and read as words (ASCII letters and digits, and everything beyond ASCII), so comment signs, line breaks and punctuation
do not matter.  A rule runs only on texts that hold all its keywords; most texts hold none and cost one pass over their words.  A detection is an
interval of words.  It is suppressed where another one covers its interval and has a higher priority, or the same priority and more words, or the same
priority and interval and stands first in the table.  The phrases of ``license_rules.BASE`` are rules like the others but never suppressed.

Every row is judged for itself: nothing is shuffled, so hot keys, ties and repeated rows cost nothing.  Null and empty texts have no words and no
detection, their score is 0.  Very long texts are read whole; a row holds its detections only after suppression.  Suppression sorts and sweeps, so a
text full of notices costs n log n.  Other columns pass through, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import license_rules
from .common import free_name, in_batches, prepare

FOUND = "array<struct<label: string, rule: string, priority: int, base: boolean, start_word: long, end_word: long, start_char: long, end_char: long>>"
REPORT = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found {FOUND}"

#: Bytes of a text as the rules see them: letters lower-cased, everything that parts words a blank. Bytes of a text keep their places.
_SEEN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


class Rule:
    """A signature: what it says, how it ranks, what a text must hold before the pattern runs."""

    def __init__(self, number: int, label: str, priority: int, keywords: str, pattern: str, base: bool, nth: int):
        for _ in range(2):  # fragments may name fragments
            for name, fragment in license_rules.FRAGMENTS.items():
                pattern = pattern.replace(name, fragment)
        self.number, self.label, self.priority, self.base, self.name = number, label, priority, base, f"{label}#{nth}"
        self.keywords = [frozenset(w.encode() for w in part.split("|")) for part in keywords.split()]
        self.source = pattern
        self.pattern = re.compile(b" (?:" + pattern.encode() + b")(?= )")

    def gate(self, words: set[bytes]) -> bool:
        return all(not k.isdisjoint(words) for k in self.keywords)


class Rules:
    """All rules, found by their first keyword."""

    def __init__(self) -> None:
        given = [(r, True) for r in license_rules.BASE] + [(r, False) for r in license_rules.RULES]
        self.all: list[Rule] = []
        seen: dict[str, int] = {}
        for number, ((label, priority, keywords, pattern), base) in enumerate(given):
            seen[label] = seen.get(label, 0) + 1
            self.all.append(Rule(number, label, priority, keywords, pattern, base, seen[label]))
        self.first: dict[bytes, list[Rule]] = {}
        for rule in self.all:
            for word in rule.keywords[0]:
                self.first.setdefault(word, []).append(rule)

    def gated(self, words: set[bytes]) -> list[Rule]:
        """Rules whose keywords are all in the text, in the order of the table."""
        met = {r.number: r for w in self.first.keys() & words for r in self.first[w]}
        return [met[i] for i in sorted(met) if met[i].gate(words)]


@functools.cache
def rules() -> Rules:
    """Compiled once in a process."""
    return Rules()


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections (first word, word behind the last, rule) that no better one covers, and the base ones, by place."""
    ordered = sorted(found, key=lambda d: (-d[2].priority, d[0], -d[1], d[2].number))
    kept: list[tuple[int, int, Rule]] = []
    above_start, above_end = np.empty(0, np.int64), np.empty(0, np.int64)  # of higher priorities: starts, and the farthest end so far
    i = 0
    while i < len(ordered):
        j = i
        while j < len(ordered) and ordered[j][2].priority == ordered[i][2].priority:
            j += 1
        level = ordered[i:j]
        starts, ends = np.array([d[0] for d in level]), np.array([d[1] for d in level])
        # within a level the order is by start, then the longest: whatever covers an interval stands before it
        reach = np.concatenate([[-1], np.maximum.accumulate(ends)[:-1]])
        spot = np.searchsorted(above_start, starts, side="right") - 1
        over = np.where(spot >= 0, above_end[np.maximum(spot, 0)] if len(above_end) else -1, -1)
        kept += [d for d, gone in zip(level, (reach >= ends) | (over >= ends)) if d[2].base or not gone]
        joined = np.concatenate([above_start, starts])
        order = np.argsort(joined, kind="stable")
        above_end = np.maximum.accumulate(np.concatenate([above_end, ends])[order])
        above_start = joined[order]
        i = j
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].number))


def detect(text: str | None) -> tuple[list[bytes], list[tuple[int, int, Rule]], bytes]:
    """Words of a text, its detections before suppression, and the bytes as the rules see them."""
    seen = (text or "").encode().translate(_SEEN)
    words = seen.split()
    gated = rules().gated(set(words))
    if not gated:
        return words, [], seen
    joined = b" " + b" ".join(words) + b" "
    starts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)  # the blank before word i is number i
    spans = [(r, m.span()) for r in gated for m in r.pattern.finditer(joined)]
    if not spans:
        return words, [], seen
    places = np.searchsorted(starts, np.array([s for _, s in spans]))
    return words, [(int(a), int(b), r) for (a, b), (r, _) in zip(places, spans)], seen


def _labels(found: Iterable[Rule]) -> str:
    return ",".join(sorted({r.label for r in found}))


def judge(text: str | None) -> tuple:
    """The report of one text, in the order of ``REPORT``."""
    words, found, seen = detect(text)
    if not found:
        return len(words), 0, None, None, "", "", 0.0, []
    kept = suppress(found)
    base = [d for d in kept if d[2].base]
    sure: dict[str, float] = {}
    for _, _, rule in kept:
        sure[rule.label] = max(sure.get(rule.label, 0.0), license_rules.CONFIDENCE[rule.priority])
    doubt = 1.0
    for label in sorted(sure):
        doubt *= 1 - sure[label]
    # places in the text: bytes of the words, then code points before these bytes
    spans = np.array([m.span() for m in _WORD.finditer(seen)])
    chars = np.cumsum((np.frombuffer((text or "").encode(), np.uint8) & 0xC0) != 0x80)
    chars = np.concatenate([[0], chars])
    listed = [(r.label, r.name, r.priority, r.base, a, b, int(chars[spans[a][0]]), int(chars[spans[b - 1][1]])) for a, b, r in kept]
    starts = [d[0] for d in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), _labels(d[2] for d in base),
            _labels(d[2] for d in kept), round(1 - doubt, 6), listed)


_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
          pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("priority", pa.int32()), ("base", pa.bool_()), ("start_word", pa.int64()),
                              ("end_word", pa.int64()), ("start_char", pa.int64()), ("end_char", pa.int64())]))]


def _scan(batch: pa.RecordBatch, text_at: int) -> pa.RecordBatch:
    report = zip(*[judge(t) for t in batch.column(text_at).to_pylist()])
    names = _KINDS[-1].value_type
    columns = [[[dict(zip((f.name for f in names), d)) for d in row] for row in c] if k == _KINDS[-1] else c for c, k in zip(report, _KINDS)]
    arrays = [*batch.columns, *[pa.array(c, k) for c, k in zip(columns, _KINDS)]]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``licences`` (the last column): counts, places and labels of the base phrases, all labels, score, detections."""
    prepare(docs.sparkSession)
    width = len(docs.columns)
    given = docs.toDF(*[f"c{i}" for i in range(width)])
    report = StructType.fromDDL(REPORT)
    schema = StructType([*given.schema.fields, *[StructField(f"c{width + i}", f.dataType) for i, f in enumerate(report.fields)]])
    out = given.mapInArrow(in_batches(_scan, docs.columns.index(text)), schema)
    licences = F.struct(*[F.col(f"c{width + i}").alias(f.name) for i, f in enumerate(report.fields)])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], licences.alias(free_name(docs.columns, "licences")))
