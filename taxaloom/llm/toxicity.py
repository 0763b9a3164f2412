"""Toxicity of whole texts after noisy-channel restoration of disguised words.

1.  A character trigram model is counted over all documents; its size depends on the alphabet, its counts on the corpus.
2.  Words that look disguised (a sign or digit inside a word, a letter three times, single letters or signs in a row) become lattices: every sign
    offers the letters it may stand for, a run of one letter offers one or two, separators offer nothing or, between single letters, the
    border of two words.  Viterbi decoding under the trigram model picks the reading of words of any length; it replaces the word if it reads
    like words of the corpus.  Only hexadecimal codes are left alone.
3.  Evidence is learned from at most ``SAMPLE`` labelled documents, the ones with the smallest hashed ids outside the held-out part, near
    copies counted once: words and word beginnings that toxic documents hold far more often than others.
4.  A document's evidence is the sum over its distinct words; a logistic curve fitted on the sample turns it into a score.

Only the text enters a score.  Null and empty texts have no evidence and get the curve's value there.  Rows without a label teach nothing; without
any label of one class the score is the share of toxic labels.  Null keys are scored and never learned from.  Repeated rows are scored alike, an empty table gives
an empty result, and no column but key and text is read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import in_batches, prepare, stored

#: Labelled documents that are learned from, at most.
SAMPLE = 20_000
#: Pieces of evidence kept, at most.
FEATURES = 20_000
BUCKETS = 1 << 22
BEGINNINGS = (4, 5, 6)
MIN_TOXIC = 8
MIN_ODDS = 2.5
MOST_ODDS = 6.0
THRESHOLD = 0.3
HELD_OUT = 2

# fixed values: letters that signs stand for
READINGS = {"4": "a", "@": "a", "8": "b", "(": "c", "3": "e", "6": "g", "9": "g", "1": "il", "!": "il", "|": "il", "0": "o", "5": "s", "$": "s", "7": "t", "+": "t", "2": "z", "*": "aeiou"}
GAPS = " .-_*"

CLASSES = 28                      # 0 border, 1-26 letters, 27 any other letter
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(97, 123)]] = np.arange(1, 27)
_CLASS[[*range(65, 91)]] = np.arange(1, 27)
_CLASS[0xC3:0xF5] = 27
_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_LETTER = (_CLASS > 0) | _CONTINUED
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in READINGS]] = True

_SIGNS = "".join(map(re.escape, READINGS))
_SPELLED = rf"(?<![^\W\d_])(?:[^\W\d_][ .\-_*]){{3,}}[^\W\d_](?![^\W\d_])"     # single letters in a row
_ONE = rf"(?:[^\W\d_]|[{_SIGNS}])"
_MIXED = rf"(?<![\w{_SIGNS}])(?:{_ONE}[ .\-_*]){{3,}}{_ONE}(?![\w{_SIGNS}])"      # single letters and signs in a row
_TOKEN = re.compile(rf"(?P<mixed>{_MIXED})|(?P<spelled>{_SPELLED})|[\w{_SIGNS}]++")
_SEPARATE = re.compile(rf"(?P<spelled>{_SPELLED})|[\w{_SIGNS}]++")
_SINGLE = re.compile(r"[^\W\d_]")
_CODE = re.compile(r"[0-9a-f]{9,}", re.I)
_DISGUISED = re.compile(rf"[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]|([^\W\d_])\1\1", re.I)


def _trigram_cells(batch: pa.RecordBatch) -> pa.RecordBatch:
    total = np.zeros(CLASSES ** 3, np.int64)
    flat, borders = kernels.text_bytes(batch.column(0))
    for lo, hi in kernels.slices(borders):
        part = flat[borders[lo]:borders[hi]]
        kept = ~_CONTINUED[part]
        at = np.searchsorted(np.flatnonzero(kept), borders[lo:hi] - borders[lo])
        c = np.insert(_CLASS[part[kept]], at, 0).astype(np.int64)     # texts do not run into each other
        if len(c) > 2:
            total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3)
    some = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a character class after two others, counted over all texts. At most CLASSES ** 3 counts reach the driver."""
    prepare(docs.sparkSession)
    cells = docs.select(text).mapInArrow(in_batches(_trigram_cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.full(CLASSES ** 3, 0.1)
    for row in cells:
        counts[row["cell"]] += row["n"]
    cube = counts.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(cube / cube.sum(axis=2, keepdims=True))


class Restorer:
    """Viterbi decoder of disguised words; remembers what it has read."""

    def __init__(self, model: np.ndarray) -> None:
        self.model, self.known = model.tolist(), {}
        usual = -float((np.exp(model) * model).sum(axis=2).mean())
        self.limit = -2.8 * usual          # mean log probability a letter below which a reading is no word

    def __call__(self, text: str) -> str:
        return _TOKEN.sub(self._restored, text)

    def _restored(self, m: re.Match) -> str:
        word = m.group(0)
        if m.groupdict().get("mixed"):
            read = self.read(word, True) if _SINGLE.search(word) else word
            return read if read != word else _SEPARATE.sub(self._restored, word)       # letters may still read well without the signs beside them
        return self.read(word, bool(m["spelled"])) if m["spelled"] or _DISGUISED.search(word) else word

    def read(self, word: str, spelled: bool = False) -> str:
        if len(word) > 100:          # seldom met twice
            return self._decode(word, spelled)
        if (word, spelled) not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word, spelled] = self._decode(word, spelled)
        return self.known[word, spelled]

    def _lattice(self, word: str, spelled: bool) -> list[list[tuple[str, float]]]:
        """Readings with channel log probabilities for every run of one character; gaps of a spelled run, at its odd places, may be borders of words."""
        out, at = [], 0
        for run, c in re.findall(r"((.)\2*)", word.lower(), re.S) if not spelled else [(c, c) for c in word.lower()]:
            gap, at = spelled and at % 2 == 1, at + len(run)
            if gap:
                out.append([("", -0.2), (" ", -1.6)])
            elif c.isalpha():
                out.append([(c, 0.0 if len(run) == 1 else -0.7)] + ([(c + c, -0.7 if len(run) == 2 else -0.9)] if len(run) > 1 else []))
            elif c in READINGS:
                letters = READINGS[c]
                options = [(x * k, -0.5 - math.log(len(letters)) - 0.3 * (k - 1)) for x in letters for k in ((1, 2) if len(run) > 1 else (1,))]
                out.append(options + ([("", -2.0)] if c in GAPS else [("", -9.0)]))
            elif c in GAPS:
                out.append([("", -0.2)])
            else:
                return []
        return out

    def _decode(self, word: str, spelled: bool) -> str:
        code = _CODE.fullmatch(word) and 2 * sum(c.isalpha() for c in word) < len(word)
        lattice = self._lattice(word, spelled) if not code else []
        if not lattice:
            return word
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}      # the reading is a chain of (letters, chain before)
        for options in lattice:
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, done) in states.items():
                for letters, cost in options:
                    x, y, total = a, b, score + cost
                    for c in letters:
                        z = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27
                        total += self.model[x][y][z]
                        x, y = y, z
                    if (x, y) not in step or step[x, y][0] < total:
                        step[x, y] = (total, (letters, done))
            states = step
        score, chain = max(((score + self.model[a][b][0], done) for (a, b), (score, done) in states.items()), key=lambda s: s[0])
        parts = []
        while chain:
            letters, chain = chain
            parts.append(letters)
        best = "".join(reversed(parts))
        return best if len(best) > 2 and score >= self.limit * (len(best) + 1) else word


def _suspects(flat: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Texts that may hold a disguised word."""
    n = len(flat)
    letter = np.concatenate([_LETTER[flat], np.zeros(5, bool)])
    before = np.concatenate([[False], letter[:n - 1]]) if n else letter[:0]
    after = letter[1:n + 1]
    hit = _SIGN[flat] & (before | after)
    low = np.concatenate([flat | 0x20, np.zeros(2, np.uint8)])
    hit |= letter[:n] & (low[:n] == low[1:n + 1]) & (low[:n] == low[2:n + 2])
    alone = ~before & ~after
    single, unit = np.concatenate([letter[:n] & alone, np.zeros(4, bool)]), np.concatenate([(letter[:n] | _SIGN[flat]) & alone, np.zeros(4, bool)])
    hit |= unit[:n] & unit[2:n + 2] & unit[4:n + 4] & (single[:n] | single[2:n + 2] | single[4:n + 4])
    total = np.concatenate([[0], np.cumsum(hit)])
    return np.flatnonzero(total[borders[1:]] > total[borders[:-1]])


def _features(texts: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature bucket) of every distinct word and word beginning of the restored texts, four columns a word."""
    flat, borders = kernels.text_bytes(texts)
    some = _suspects(flat, borders)
    if len(some):
        values = texts.to_pylist()
        for i in some:
            values[i] = restorer(values[i])
        flat, borders = kernels.text_bytes(pa.array(values, pa.string()))
    low = flat.copy()
    upper = (flat >= 65) & (flat <= 90)
    low[upper] += 32
    latin = np.concatenate([[False], flat[:-1] == 0xC3]) & (flat >= 0x80) & (flat < 0x9F) & (flat != 0x97) if len(flat) else upper
    low[latin] += 32
    spaced = np.where(_LETTER[flat], low, 0x20).astype(np.uint8)
    words = kernels.Words(spaced, borders)
    size = words.ends - words.starts
    columns = [words.hashes] + [np.where(size > k, kernels.range_hashes(spaced, words.starts, np.minimum(words.starts + k, words.ends)), kernels.U(0)) for k in BEGINNINGS]
    grid = np.stack(columns, axis=1)
    owner = words.owner()
    order = np.lexsort((words.hashes, owner))
    grid, owner = grid[order], owner[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (grid[1:, 0] != grid[:-1, 0]) | (owner[1:] != owner[:-1])
    grid = np.where(grid[fresh] == 0, -1, (grid[fresh] % kernels.U(BUCKETS)).astype(np.int64))
    return owner[fresh], grid


def _counted(batch: pa.RecordBatch, model: np.ndarray) -> pa.RecordBatch:
    """Per feature bucket: toxic and other documents of a batch (text, toxic) that hold it."""
    restorer, toxic = Restorer(model), batch.column(1).to_numpy(zero_copy_only=False)
    flat, borders = kernels.text_bytes(batch.column(0))
    found = []
    for lo, hi in kernels.slices(borders):
        owner, grid = _features(batch.column(0).slice(lo, hi - lo), restorer)
        pair = np.unique(np.stack([np.repeat(owner + lo, grid.shape[1]), grid.ravel()]), axis=1)
        pair = pair[:, pair[1] >= 0]
        found.append(pair)
    pair = np.concatenate(found, axis=1)
    bad = toxic[pair[0]] == 1
    buckets, which = np.unique(pair[1], return_inverse=True)
    n, t = np.bincount(which, minlength=len(buckets)), np.bincount(which[bad], minlength=len(buckets))
    return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(t), pa.array(n)], names=["bucket", "t", "n"])


def _seals(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The smallest hash of three words in a row: near copies mostly share it."""
    flat, borders = kernels.text_bytes(batch.column(1))
    out = np.zeros(batch.num_rows, np.int64)
    for lo, hi in kernels.slices(borders):
        words = kernels.Words(flat[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo])
        h, at = words.windows(3)
        low = np.full(hi - lo, kernels.U(2**64 - 1))
        np.minimum.at(low, words.owner()[at], h)
        short = low == kernels.U(2**64 - 1)
        low[short] = kernels.range_hashes(words.flat, words.borders[:-1][short], words.borders[1:][short])
        out[lo:hi] = low.view(np.int64)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["key", "text", "toxic", "seal"])


def evidence(owner: np.ndarray, grid: np.ndarray, n: int, buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over a text's distinct words of the strongest evidence in the word or its beginnings."""
    if not len(buckets):
        return np.zeros(n)
    at = np.minimum(np.searchsorted(buckets, grid), len(buckets) - 1)
    strongest = np.where(buckets[at] == grid, weights[at], 0.0).max(axis=1, initial=0.0)
    return np.bincount(owner, weights=strongest, minlength=n)


def _weighed(batch: pa.RecordBatch, model: np.ndarray, buckets: np.ndarray, weights: np.ndarray, curve: tuple[float, float] | None) -> pa.RecordBatch:
    """Key or label, and the evidence or score, of a batch (key or label, text)."""
    restorer, out = Restorer(model), []
    flat, borders = kernels.text_bytes(batch.column(1))
    for lo, hi in kernels.slices(borders):
        owner, grid = _features(batch.column(1).slice(lo, hi - lo), restorer)
        out.append(evidence(owner, grid, hi - lo, buckets, weights))
    value = np.concatenate(out)
    if curve is not None:
        value = 1 / (1 + np.exp(-np.clip(curve[0] * value + curve[1], -40, 40)))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["id", "value"])


def _curve(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression with a light pull to zero, by Newton steps."""
    x, w = np.stack([value, np.ones(len(value))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (label - p) - 0.05 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """key, held_out, score, predicted for every row."""
    spark = docs.sparkSession
    prepare(spark)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    model = language_model(narrow)
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).where("key IS NOT NULL AND toxic IN (0, 1)").where(~is_held_out(F.col("key")))
    chosen = marked.groupBy("key").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("key"), "key").limit(sample)
    # at most ``sample`` ids are broadcast
    learned = narrow.join(F.broadcast(chosen), "key").select("key", "text", "toxic")
    sealed = learned.mapInArrow(in_batches(_seals), f"key {kind}, text string, toxic int, seal long")
    learned = stored(sealed.dropDuplicates(["seal"]).select("key", "text", "toxic"))
    totals = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    buckets, weights, curve = np.zeros(0, np.int64), np.zeros(0), (0.0, math.log((bad + 0.5) / (good + 0.5)) if bad + good else 0.0)
    if bad and good:
        counts = learned.select("text", "toxic").mapInArrow(in_batches(_counted, model), "bucket long, t long, n long").groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
        odds = F.log((F.col("t") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (good + 1))
        top = counts.where(F.col("t") >= MIN_TOXIC).withColumn("w", odds).where(F.col("w") >= MIN_ODDS).orderBy(F.col("w").desc(), "bucket").limit(FEATURES).select("bucket", "w").toPandas().sort_values("bucket")
        buckets, weights = top["bucket"].to_numpy(np.int64), np.minimum(top["w"].to_numpy(np.float64), MOST_ODDS)
        seen = learned.select("toxic", "text").mapInArrow(in_batches(_weighed, model, buckets, weights, None), "id int, value double").toPandas()  # at most ``sample`` rows
        curve = _curve(seen["value"].to_numpy(), seen["id"].to_numpy(np.float64))
    scored = narrow.mapInArrow(in_batches(_weighed, model, buckets, weights, curve), f"id {kind}, value double")
    return scored.select(F.col("id").alias(key), is_held_out(F.col("id")).alias("held_out"), F.col("value").alias("score"), (F.col("value") >= THRESHOLD).cast("int").alias("predicted"))
