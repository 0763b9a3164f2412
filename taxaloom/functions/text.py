"""Cleaning, parsing and formatting of single values."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as V
from .rules import blank, case_when

_NUMBER = r"(?U)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim_ws(c: Column) -> Column:
    """Strip all white space, not only blanks."""
    return F.btrim(c, F.lit(_WHITE_SPACE))


def nonblank(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.when(~blank(c), trim_ws(c))


def first_of(*cols: Column) -> Column:
    """First value that is not blank."""
    return F.coalesce(*[nonblank(c) for c in cols])


def lenient_double(c: Column) -> Column:
    """Number in a text cell, NULL otherwise; type suffixes such as ``5d`` and words such as ``nan`` are not numbers."""
    return F.when(c.rlike(_NUMBER), trim_ws(c).try_cast("double"))


def lenient_int(c: Column, default: int = 0) -> Column:
    """Integer part of a number in a text cell (``12.0`` -> 12), else the default."""
    return F.coalesce(lenient_double(c).try_cast("bigint"), F.lit(default).cast("bigint"))


def truthy(c: Column) -> Column:
    """Booleans that were written as text."""
    return F.coalesce(F.lower(trim_ws(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def clean_missing(c: Column, words: Sequence[str] = V.MISSING_WORDS, to: str = V.NOT_REPORTED) -> Column:
    """Missing words become one explicit text; the value is never collapsed to NULL."""
    text = F.coalesce(trim_ws(c), F.lit(""))
    return F.when(F.lower(text).isin(list(words)), F.lit(to)).otherwise(text)


def clip(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL for an empty whole (rounding belongs to the sink)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def share_text(part: Column, whole: Column) -> Column:
    """``12.3%``, or ``-`` when the whole is zero."""
    return F.coalesce(F.format_string("%.1f%%", F.bround(share(part, whole) * 100, 6)), F.lit("-"))


def normalize_id(c: Column) -> Column:
    """Lower-cased identifier; a DOI given as a link loses its host."""
    return F.regexp_replace(F.lower(trim_ws(c)), r"^https?://(dx\.)?doi\.org/", "")


def normalize_doi(c: Column) -> Column:
    return F.regexp_replace(normalize_id(c), r"/+$", "")


def paper_key(*cols: Column) -> Column:
    """Key of a paper: the first identifier that is not blank, normalised."""
    return normalize_id(first_of(*cols))


def safe_name(c: Column) -> Column:
    """Everything but letters, digits and underscore becomes ``_`` (any script)."""
    return F.regexp_replace(trim_ws(c), r"(?U)[^\w]+", "_")


def safe_file_name(c: Column) -> Column:
    """Characters a file system refuses become ``_``; an empty result becomes ``unnamed``."""
    cleaned = F.regexp_replace(F.regexp_replace(c, r"[<>:\"/\\|?*\x00-\x1f]", "_"), r"^[ .]+|[ .]+$", "")
    return F.when(cleaned == "", F.lit("unnamed")).otherwise(cleaned)


@F.pandas_udf(T.StringType())
def _without_diacritics(names: pd.Series) -> pd.Series:
    return names.map(
        lambda v: None if v is None else "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch))
    )


def ascii_surname(c: Column) -> Column:
    """First author of an author string as plain letters: accents off, trailing initials off."""
    first = trim_ws(F.element_at(F.split(c, ","), 1))
    plain = _without_diacritics(first)
    return F.regexp_replace(F.regexp_replace(plain, r"(^|\s)[A-Z]{1,3}$", ""), "[^A-Za-z]", "")


def _range_parts(text: Column) -> Column:
    pattern = "(?i)" + V.ACCESSION_RANGE
    part = lambda i: F.regexp_extract(text, pattern, i)
    return F.struct(text.alias("text"), F.upper(part(1)).alias("prefix"), part(2).try_cast("bigint").alias("lo"), part(3).try_cast("bigint").alias("hi"))


def accession_ranges(c: Column) -> Column:
    """Accession ranges of a cell (``SRR10-12`` or ``SRR10-SRR12``): array of (text, prefix, lo, hi). hi < lo or a blank bound marks a range nobody can expand."""
    return F.transform(F.regexp_extract_all(c, F.lit("(?i)" + V.ACCESSION_RANGE), F.lit(0)), _range_parts)


def expand_ranges(c: Column) -> Column:
    """Single accessions of a cell's ranges as one array, for cells of ordinary size; ``links.expand_range_rows`` makes rows of ranges of any size.

    A reversed range gives nothing, so that one bad cell does not stop a job; ``accession_ranges`` still shows it.
    """
    def expand(r: Column) -> Column:
        numbers = F.when(r["hi"] >= r["lo"], F.sequence(r["lo"], F.greatest(r["lo"], r["hi"]))).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda n: F.concat(r["prefix"], n.cast("string")))

    return F.flatten(F.transform(accession_ranges(c), expand))


def parse_accessions(c: Column) -> Column:
    """struct(supported, unsupported) accessions of a free-text cell, first-seen order, no repeats.

    Ranges are expanded; chunks (``;`` or new line) that describe another product are ignored.
    """
    range_pattern = "(?i)" + V.ACCESSION_RANGE
    chunks = F.filter(
        F.split(F.coalesce(c, F.lit("")), r"[;\n]"), lambda t: ~F.coalesce(t.rlike("(?i)" + V.SKIPPED_PRODUCT_CHUNK), F.lit(False))
    )

    def found(pattern: str, expanded: bool) -> Column:
        def of_chunk(text: Column) -> Column:
            single = F.regexp_extract_all(F.regexp_replace(text, range_pattern, " "), F.lit("(?i)" + pattern), F.lit(0))
            return F.concat(expand_ranges(text), single) if expanded else single

        return F.array_distinct(F.transform(F.flatten(F.transform(chunks, of_chunk)), lambda a: F.upper(a)))

    return F.struct(
        found(V.SUPPORTED_ACCESSION, True).alias("supported"), found(V.UNSUPPORTED_ACCESSION, False).alias("unsupported")
    )


def mate_of(c: Column) -> Column:
    """Mate a FASTQ file name stands for."""
    return case_when([(c.contains("_1."), F.lit("R1")), (c.contains("_2."), F.lit("R2"))], F.lit("single"))


def split_list(c: Column, sep: str = ";") -> Column:
    """``a; b;;a`` -> [a, b]: trimmed, blanks dropped, first-seen order."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), sep), lambda v: trim_ws(v))
    return F.array_distinct(F.filter(parts, lambda v: v != ""))


def union_values(a: Column, b: Column, sep: str = ";") -> Column:
    """Sorted union of two joined lists."""
    return F.array_join(F.array_sort(F.array_union(split_list(a, sep), split_list(b, sep))), sep)


def first_nonblank(row: Column, names: Sequence[str]) -> Column:
    """Value of the first listed column that is filled, in a row held as map(lower-cased header -> text)."""
    return F.coalesce(*[nonblank(F.try_element_at(row, F.lit(name))) for name in names])


def lower_keys(row: Column) -> Column:
    """Header names trimmed and lower-cased; of several spellings of one header the last one is kept."""
    def kept(keys: Column, values: Column) -> Column:
        last = lambda k, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), k)
        return F.map_from_entries(F.filter(F.arrays_zip(keys.alias("key"), values.alias("value")), lambda e, i: last(e["key"], i)))

    # a list of one binds the cleaned headers, so that they are cleaned once for each row; most rows hold each header once and need no search
    bound = F.array(F.transform(F.map_keys(row), lambda k: F.lower(trim_ws(k))))
    unique = lambda keys: F.size(F.array_distinct(keys)) == F.size(keys)
    return F.transform(bound, lambda keys: F.when(unique(keys), F.map_from_arrays(keys, F.map_values(row))).otherwise(kept(keys, F.map_values(row))))[0]


def flag_challenge_page(content: Column) -> Column:
    """True when the first 512 bytes of a downloaded file show it is a web page put in its place."""
    head = F.decode(F.substring(content, 1, 512), "ISO-8859-1")
    return F.coalesce(F.greatest(*[head.contains(sig) for sig in V.CHALLENGE_SIGNATURES]), F.lit(False))


def letter_suffix(n: Column) -> Column:
    """1 -> a, 26 -> z, 27 -> aa ... (bijective base 26, as many letters as a whole number needs)."""
    m = n.cast("bigint")
    powers = [26**k for k in range(14)]
    # shorter suffixes come first: how many there are of each width says how wide this one is, and its place among those as wide
    shorter = F.array(*[F.lit(sum(powers[1:k])).cast("bigint") for k in range(1, 15)])
    width = F.size(F.filter(shorter, lambda s: s < m))
    place = m - 1 - F.get(shorter, width - 1)
    digits = F.reverse(F.slice(F.array(*[F.lit(p).cast("bigint") for p in powers]), F.lit(1), width))
    letters = F.array_join(F.transform(digits, lambda p: F.char(F.lit(97) + F.call_function("div", place, p) % 26)), "")
    return F.when(m <= 0, F.lit("")).when(m > 0, letters)


