"""Fill-in-the-middle rewriting: every text is cut into prefix, middle and suffix, whose order a draw by the key decides.

A unit is a run of ASCII letters or any other single code point.  All work on text is a pipeline of ``pyarrow.compute`` calls over whole batches: a
byte that no UTF-8 text holds is set behind every unit and the batch is split at it into list arrays; the lists are flattened beside the indices of
their rows, the ordinal of a unit in its row gives its role, each role is filtered out and its lists are rebuilt, and ``binary_join`` makes one
piece a row of them.  The draws are expressions on the JVM side, so an executor that is lost makes the same texts again.

``transform`` and ``restore`` map rows to rows and shuffle nothing, so hot keys, ties and repeated rows cost nothing: equal rows come out equal.  A
null text is an empty one; empty texts, and texts that hold one of the marks, stay plain.  A null key draws as the empty string.  Batches are bound
in bytes, and a very long text is a batch of its own with 64-bit offsets.  Other columns pass through, whatever their names; an empty table gives an
empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import free_name, in_batches, prepare

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "1"
PLAIN_FROM = 90  # of 100 draws, those from here on leave a text as it is
SUFFIX_FIRST_BELOW = 20  # of 100 rewritten texts, those below here begin with the suffix

#: A run of letters, another ASCII character, or a whole code point of several bytes.
_UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xff][\x80-\xbf]*)"
_BORDER = b"\xff"
_BYTES = pa.large_binary()

REPORT = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(key: Column, seed: str = SEED) -> Column:
    """Four numbers from 0 to 2^32 - 1 that depend on nothing but the key and the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])


def _bytes(*parts: pa.Array | bytes) -> pa.Array:
    """Element-wise concatenation of arrays and fixed strings."""
    fixed = [pa.scalar(p, _BYTES) if isinstance(p, bytes) else p for p in parts]
    return pc.binary_join_element_wise(*fixed, pa.scalar(b"", _BYTES))


def _lists(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The units of all rows in one array, the row of each, and how many each row has."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\1" + _BORDER)
    split = pc.split_pattern(marked, pattern=_BORDER)  # a row of n units gives n + 1 strings, the last one empty
    flat, parents = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), parents.filter(real), pc.subtract(pc.list_value_length(split), 1)


def _starts(counts: pa.Array) -> pa.Array:
    """Offsets of lists with the given lengths."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts.cast(pa.int64()))])


def _piece(units: pa.Array, wanted: pa.Array, counts: pa.Array) -> pa.Array:
    """The units with a role, rebuilt as one list a row and joined."""
    lists = pa.LargeListArray.from_arrays(_starts(counts), units.filter(wanted))
    return pc.binary_join(lists, pa.scalar(b"", _BYTES))


def _chars(piece: pa.Array) -> pa.Array:
    return pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64())


def _transform(batch: pa.RecordBatch, text_at: int, width: int, plain_from: int, suffix_first_below: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column(text_at).cast(_BYTES), b"")
    drawn = [pc.list_element(batch.column(width), i) for i in range(4)]
    units, parents, n = _lists(texts)
    n = n.cast(pa.int64())
    places = pc.add(n, 1).to_numpy()
    one, two = (pa.array(d.to_numpy() % places) for d in drawn[:2])
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)

    ordinal = pc.subtract(pa.array(np.arange(len(units))), _starts(n).take(parents))
    before, behind = pc.less(ordinal, low.take(parents)), pc.greater_equal(ordinal, high.take(parents))
    prefix = _piece(units, before, low)
    middle = _piece(units, pc.invert(pc.or_(before, behind)), pc.subtract(high, low))
    suffix = _piece(units, behind, pc.subtract(n, high))

    marked = [pc.match_substring(texts, pattern=m) for m in (PREFIX, SUFFIX, MIDDLE)]
    draw, turn = (pa.array(d.to_numpy() % 100) for d in drawn[2:])
    plain = pc.or_(pc.or_(pc.or_(*marked[:2]), marked[2]), pc.or_(pc.equal(n, 0), pc.greater_equal(draw, plain_from)))
    first = pc.less(turn, suffix_first_below)
    form = pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm"))
    psm = _bytes(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm = _bytes(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    output = pc.if_else(plain, texts, pc.if_else(first, spm, psm)).cast(pa.large_string())
    hidden = pa.scalar(None, pa.int64())
    report = [n, form, pc.if_else(plain, hidden, _chars(prefix)), pc.if_else(plain, hidden, _chars(middle)), output]
    arrays = [*batch.columns[:width], *report]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def _restore(batch: pa.RecordBatch, output_at: int, form_at: int, width: int) -> pa.RecordBatch:
    given, form = pc.fill_null(batch.column(output_at).cast(_BYTES), b""), batch.column(form_at)
    plain = pc.fill_null(pc.equal(form, "plain"), True)
    # a rewritten text holds every mark once, so its pieces are the strings behind them; a plain one becomes four empty strings here
    pieces = pc.split_pattern_regex(pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, given), pattern=b"<[PSM]>")
    one, two, middle = (pc.list_element(pieces, i) for i in (1, 2, 3))
    turned = pc.fill_null(pc.equal(form, "spm"), False)
    text = _bytes(pc.if_else(turned, two, one), middle, pc.if_else(turned, one, two))
    arrays = [*batch.columns[:width], pc.if_else(plain, given, text).cast(pa.large_string())]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def _numbered(df: DataFrame) -> DataFrame:
    """Columns by position, so that clashing names cannot matter."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, plain_from: int = PLAIN_FROM,
              suffix_first_below: int = SUFFIX_FIRST_BELOW) -> DataFrame:
    """All columns of ``docs`` and a struct ``fim`` (the last column): units, form (plain, psm, spm), code points of prefix and middle, the new text."""
    prepare(docs.sparkSession)
    width, at = len(docs.columns), docs.columns.index(text)
    given = _numbered(docs.select(*docs.columns, draws(F.col(key), seed)))
    report = StructType.fromDDL(REPORT)
    schema = StructType([*given.schema.fields[:width], *[StructField(f"c{width + i}", f.dataType) for i, f in enumerate(report.fields)]])
    out = given.mapInArrow(in_batches(_transform, at, width, plain_from, suffix_first_below), schema)
    fim = F.struct(*[F.col(f"c{width + i}").alias(f.name) for i, f in enumerate(report.fields)])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], fim.alias(free_name(docs.columns, "fim")))


def restore(rewritten: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """All columns of ``rewritten`` and ``restored`` (the last column): the text that a rewritten one was made of."""
    prepare(rewritten.sparkSession)
    columns = rewritten.columns
    given = _numbered(rewritten)
    schema = StructType([*given.schema.fields, StructField(f"c{len(columns)}", rewritten.schema[output].dataType)])
    out = given.mapInArrow(in_batches(_restore, columns.index(output), columns.index(form), len(columns)), schema)
    return out.toDF(*columns, free_name(columns, "restored"))
