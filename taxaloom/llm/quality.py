"""Quality rules as a short-circuit cascade.

Each rule rejects texts by one limit.  ``plan_cascade`` times every rule and counts its rejections on a sample of
``SAMPLE_ROWS`` texts and orders the rules by rejection per cost; inside a batch a rule is computed only for the texts that all
rules before it kept.  The verdict is a conjunction, so the order changes the work, never the result.

Null and empty texts have no words and fail the base rule.  Texts of any length are judged whole.  Repeated rows are judged alike,
an empty table gives an empty result, and ``keep_clean`` passes every other column through untouched, whatever its name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels
from .common import prepare, in_batches

#: Documents that the planner reads to estimate cost and selectivity.
SAMPLE_ROWS = 2000
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_ASCII_UPPER = (np.arange(256) >= ord("A")) & (np.arange(256) <= ord("Z"))
_ASCII_LOWER = (np.arange(256) >= ord("a")) & (np.arange(256) <= ord("z"))


class Texts:
    """The texts of one slice with the measures that rules share, each computed when it is first asked for."""

    def __init__(self, flat: np.ndarray, borders: np.ndarray) -> None:
        self.flat, self.borders = flat, borders
        self._known: dict[str, np.ndarray] = {}

    def __getattr__(self, name: str) -> np.ndarray:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = getattr(self, f"_{name}")()
        return self._known[name]

    def take(self, rows: np.ndarray) -> "Texts":
        sizes = np.diff(self.borders)[rows]
        borders = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.borders[:-1][rows] - borders[:-1], sizes) + np.arange(borders[-1])
        return Texts(self.flat[at], borders)

    def _words(self) -> kernels.Words:
        return kernels.Words(self.flat, self.borders)

    def _n_words(self) -> np.ndarray:
        return self.words.counts

    def _word_chars(self) -> np.ndarray:
        return self.words.code_points()

    def _n_symbols(self) -> np.ndarray:
        return self.words.per_text(_SYMBOL[self.flat])

    def _lines(self) -> np.ndarray:
        """Per text: lines that have a word, and those of them that equal an earlier line."""
        out = np.zeros((len(self.borders) - 1, 2), np.int64)
        raw = self.flat.tobytes()
        for i in range(len(out)):
            lines = [x for x in raw[self.borders[i]:self.borders[i + 1]].split(b"\n") if x.strip(b" \t\n\v\f\r")]
            out[i] = len(lines), len(lines) - len(set(lines))
        return out

    def _n_dup_lines(self) -> np.ndarray:
        return self.lines[:, 1]

    def _n_repeat_words(self) -> np.ndarray:
        """Words covered by a window of eight words that the text holds twice or more."""
        w = self.words
        h, at = w.windows(WINDOW)
        owner = w.owner()
        key = h + kernels.mix(owner[at].astype(np.uint64) + kernels.U(1)) if len(at) else h
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(at) else at
        steps = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(steps, twice, 1)
        np.add.at(steps, twice + WINDOW, -1)
        covered = np.cumsum(steps[:-1]) > 0
        return np.bincount(owner[covered], minlength=w.n)

    def _upper_words(self) -> np.ndarray:
        """Words with two capitals or more and no small letter (Latin letters)."""
        before = np.concatenate([[0], self.flat[:-1]]) if len(self.flat) else self.flat
        latin = before == 0xC3
        lower = _ASCII_LOWER[self.flat] | (latin & (self.flat >= 0x9F) & (self.flat != 0xB7))
        upper = _ASCII_UPPER[self.flat] | (latin & (self.flat >= 0x80) & (self.flat < 0x9F) & (self.flat != 0x97))
        w = self.words
        return np.bincount(w.owner()[(w.per_word(upper) >= 2) & (w.per_word(lower) == 0)], minlength=w.n)

    def _stutters(self) -> np.ndarray:
        """Words equal to the word before them."""
        w = self.words
        owner = w.owner()
        again = np.flatnonzero((w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
        return np.bincount(owner[again], minlength=w.n)

    def _distinct_words(self) -> np.ndarray:
        w = self.words
        owner = w.owner()
        pairs = np.lexsort((w.hashes, owner))
        h, o = w.hashes[pairs], owner[pairs]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[fresh], minlength=w.n)


@dataclass(frozen=True)
class Rule:
    """``rejects(texts)`` gives one boolean a text; texts without words never reach a rule of the cascade."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


#: Limits lie far outside what running prose of any language shows.
RULES = (
    Rule("symbols", lambda t: t.n_symbols * 5 > t.n_words),
    Rule("shouting", lambda t: t.upper_words * 2 > t.n_words),
    Rule("word_length", lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 14 * t.n_words)),
    Rule("repeated_lines", lambda t: t.n_dup_lines * 5 > t.lines[:, 0] * 2),
    Rule("stutter", lambda t: t.stutters * 4 > t.n_words),
    Rule("few_distinct_words", lambda t: t.distinct_words * 10 < t.n_words),
)


def base_failed(t: Texts) -> np.ndarray:
    return (t.n_words < MIN_WORDS) | (100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words)


def plan_cascade(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by falling rejection per second, measured on at most ``rows`` texts of the first partitions."""
    sample = docs.select(text).limit(rows).toArrow().column(0)
    flat, borders = kernels.text_bytes(sample)
    cost, rejected = dict.fromkeys((r.name for r in rules), 1e-9), dict.fromkeys((r.name for r in rules), 0)
    for lo, hi in kernels.slices(borders):
        part = flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo]
        for rule in rules:
            texts = Texts(*part)
            _ = texts.words  # splitting into words is paid once, by all rules
            start = time.thread_time()
            rejected[rule.name] += int(np.sum(rule.rejects(texts)[texts.n_words > 0]))
            cost[rule.name] += time.thread_time() - start
    return sorted(cost, key=lambda name: (-rejected[name] / cost[name], name))


def _judge(texts: Texts, order: Sequence[Rule]) -> tuple[np.ndarray, np.ndarray]:
    """Verdict of the base rule and of the cascade; a rule is computed for the texts that are still alive."""
    failed = base_failed(texts)
    left, rows, alive = texts, np.arange(len(failed)), np.flatnonzero(~failed)  # rows: of ``left``; alive: places in ``left``
    for rule in order:
        if not len(alive):
            break
        if len(alive) < 0.9 * len(rows):  # above that, the measures at hand are cheaper than a new split into words
            left, rows = left.take(alive), rows[alive]
            alive = np.arange(len(rows))
        alive = alive[~rule.rejects(left)[alive]]
    kept = np.zeros(len(failed), bool)
    kept[rows[alive]] = True
    return failed, kept


def _each_slice(column: pa.Array):
    flat, borders = kernels.text_bytes(column)
    for lo, hi in kernels.slices(borders):
        yield Texts(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(batch: pa.RecordBatch, order: list[Rule]) -> pa.RecordBatch:
    rows = []
    for texts in _each_slice(batch.column(1)):
        measures = [getattr(texts, name) for name in MEASURES]
        rows.append([*measures, *_judge(texts, order)])
    columns = [np.concatenate(c) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=[batch.schema.names[0], *MEASURES, "base_failed", "kept"])


def _filtered(batch: pa.RecordBatch, at: int, order: list[Rule]) -> pa.RecordBatch:
    kept = np.concatenate([_judge(texts, order)[1] for texts in _each_slice(batch.column(at))])
    return batch.filter(pa.array(kept))


def _ordered(names: Sequence[str], rules: Sequence[Rule]) -> list[Rule]:
    known = {r.name: r for r in rules}
    return [known[n] for n in names]


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Key, the measures, the base verdict and the verdict of the cascade for every row."""
    prepare(docs.sparkSession)
    order = _ordered(plan_cascade(docs, text, rules), rules)
    narrow = docs.select(key, text)
    kind = narrow.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in MEASURES) + ", base_failed boolean, kept boolean"
    return narrow.mapInArrow(in_batches(_measured, order), schema)


def keep_clean(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows whose text passes the base rule and every rule of the cascade, all columns unchanged."""
    prepare(docs.sparkSession)
    order = _ordered(plan_cascade(docs, text, rules), rules)
    return docs.mapInArrow(in_batches(_filtered, docs.columns.index(text), order), docs.schema)
