"""Removal of repeated lines, paragraphs or passages by global digests.

A unit is lower-cased, its white space is collapsed, and its digest is counted over all documents.  The occurrence with the smallest (key, text hash,
position) stays, every later one goes, with its place in the original text retained.  Every unit with a word is counted, however short.  Units are

* lines, or paragraphs between blank lines;
* passages: a line of ``least`` words or more is cut behind punctuation into clauses of at least ``least`` words; shorter lines that follow one another
  are joined up to the line end at which they hold as many.  What is left over with fewer words belongs to the unit before it.  So each word lies in
  one unit, a text that begins or ends inside a line is still met by the units within it, and words that many texts use alone are no unit.

Only digests are shuffled by digest, and the first occurrence is an aggregate, so a unit of a third of all documents is combined before the
shuffle; the join back is one that adaptive execution splits.  Null and empty texts have no units.  Very long texts are cut in linear time, a text
without a border is one unit.  Rows with a null key keep their text and cause nothing.  Repeated rows (same key and text) are one document: both keep
or lose the same units; of rows with one key and other texts the smaller text hash is first.  Other columns pass through; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import free_name, in_batches, prepare, stored

LEAST = 10
_BREAKS = {"line": re.compile("\n"), "paragraph": re.compile("\n(?:[ \t]*\n)+")}
_WHITE = re.compile(r"[ \t\n\v\f\r]+")
_WORD = re.compile(r"[^ \t\n\v\f\r]+")


def clause_pattern(least: int) -> str:
    """Pieces of a long line: up to punctuation behind at least ``least`` words, or all that is left."""
    return r"[ \t\n\v\f\r]*(?:[^ \t\n\v\f\r]+[ \t\n\v\f\r]+){%d,}?[^ \t\n\v\f\r]*[.!?,;:][ \t\n\v\f\r]+|[\s\S]+" % (least - 1)


def lines_pattern(least: int) -> str:
    """Pieces of a run of short lines: up to a line end behind at least ``least`` words, or all that is left."""
    return r"[ \t\n\v\f\r]*(?:[^ \t\n\v\f\r]+[ \t\n\v\f\r]+){%d,}?[^ \t\n\v\f\r]+[ \t\v\f\r]*\n|[\s\S]+" % (least - 1)


def _segments(text: str, least: int) -> Iterator[tuple[int, int, bool]]:
    """Long lines, and runs of short ones, with their line breaks: start, end, whether it is a long line."""
    start = at = 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        words = 0
        for words, _ in enumerate(_WORD.finditer(text, at, end), 1):
            if words == least:
                break
        if words == least:
            if start < at:
                yield start, at, False
            yield at, end, True
            start = end
        at = end
    if start < len(text):
        yield start, len(text), False


def _passages(text: str, least: int) -> list[tuple[int, int]]:
    """Units that part the whole text, each with the white space behind it."""
    clauses, lines = map(re.compile, (clause_pattern(least), lines_pattern(least)))
    out: list[tuple[int, int]] = []
    for a, b, long in _segments(text, least):
        for m in (clauses if long else lines).finditer(text[a:b]):
            start, end = a + m.start(), a + m.end()
            if out and len(_WORD.findall(text, start, end)) < least:
                out[-1] = (out[-1][0], end)
            else:
                out.append((start, end))
    return out


def _spans(text: str, unit: str, least: int) -> list[tuple[int, int]]:
    """Start and end of every unit, in code points."""
    if unit == "passage":
        return _passages(text, least)
    out, at = [], 0
    for m in _BREAKS[unit].finditer(text):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, len(text))]


def _normal(text: str) -> str:
    return _WHITE.sub(" ", text).strip(" ").lower()


def _units(batch: pa.RecordBatch, unit: str, least: int) -> pa.RecordBatch:
    row, number, digest = [], [], []
    for i, text in enumerate(batch.column(2).to_pylist()):
        for k, (a, b) in enumerate(_spans(text or "", unit, least)):
            if plain := _normal(text[a:b]) if b > a else "":
                row.append(i)
                number.append(k)
                digest.append(hashlib.blake2b(plain.encode(), digest_size=16).digest())
    at = pa.array(row, pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()), pa.array(digest, pa.binary())], names=["key", "seal", "unit", "digest"])


REPORT = "n_units long, n_removed long, removed_chars long, spans string, kept_text string"


def _cut(batch: pa.RecordBatch, at: int, width: int, unit: str, least: int) -> pa.RecordBatch:
    report: list[tuple] = []
    texts, gone = batch.column(at).to_pylist(), batch.column(width).to_pylist()
    for text, out in zip(texts, gone):
        text, out = text or "", set(out or ())
        spans = _spans(text, unit, least)
        counted = sum(1 for a, b in spans if _WORD.search(text, a, b))
        removed = [_trimmed(text, *spans[k]) if unit == "passage" else spans[k] for k in sorted(out)]
        report.append((counted, len(removed), sum(b - a for a, b in removed), ";".join(f"{a}-{b}" for a, b in removed), _kept(text, spans, out, unit)))
    columns = list(zip(*report))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    arrays = [batch.column(i) for i in range(width)] + [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """The place of a unit without the white space around it."""
    inside = text[a:b]
    return a + len(inside) - len(inside.lstrip(" \t\n\v\f\r")), a + len(inside.rstrip(" \t\n\v\f\r"))


def _kept(text: str, spans: list[tuple[int, int]], out: set[int], unit: str) -> str:
    """The units that stay: lines parted by line breaks, paragraphs each with the break before it, passages with the white space behind them."""
    stay = [(a, b, spans[k - 1][1] if k else 0) for k, (a, b) in enumerate(spans) if k not in out]
    if unit == "paragraph":
        return "".join(text[end:a] * (i > 0) + text[a:b] for i, (a, b, end) in enumerate(stay))
    return ("\n" if unit == "line" else "").join(text[a:b] for a, b, _ in stay)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line", least: int = LEAST) -> DataFrame:
    """All columns of ``docs`` and a struct ``cut`` (the last column): units counted, units and characters removed, their spans ("start-end;..."), the text kept."""
    prepare(docs.sparkSession)
    seal = F.xxhash64(F.col(text))
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("key"), seal.alias("seal"), F.col(text).alias("text")).where("key IS NOT NULL")
    units = stored(narrow.mapInArrow(in_batches(_units, unit, least), f"key {kind}, seal long, unit int, digest binary"))
    place = F.struct("key", "seal", "unit")
    firsts = units.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    firsts = stored(firsts)
    later = units.join(firsts, "digest").where(place > F.col("first"))
    gone = later.groupBy("key", "seal").agg(F.collect_set("unit").alias("_gone")).select(F.col("key").alias("_key"), F.col("seal").alias("_seal"), "_gone")
    n = len(docs.columns)
    given = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    k, t = f"c{docs.columns.index(key)}", f"c{docs.columns.index(text)}"
    met = given.join(gone, (F.col(k) == F.col("_key")) & (F.xxhash64(t) == F.col("_seal")), "left").select(*given.columns, "_gone")
    report = StructType.fromDDL(REPORT)
    schema = StructType(list(given.schema.fields))
    for i, field in enumerate(report.fields):
        schema = schema.add(f"c{n + i}", field.dataType)
    out = met.mapInArrow(in_batches(_cut, docs.columns.index(text), n, unit, least), schema)
    cut = F.struct(*[F.col(f"c{n + i}").alias(f.name) for i, f in enumerate(report.fields)])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], cut.alias(free_name(docs.columns, "cut")))
