"""Sequence helpers: complement, degenerate matching, quality arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def revcomp(c: Column) -> Column:
    """Reverse complement with degenerate letters; anything else becomes N."""
    known = F.regexp_replace(c, f"[^{V.COMPLEMENT[0]}]", "N")
    return F.translate(F.reverse(known), *V.COMPLEMENT)


def _class_of(letter: str) -> str:
    return f"[{V.IUPAC.get(letter, letter)}]"


def mismatches(seq: Column, primer: str, offset: int | Column = 0) -> Column:
    """Letters of ``seq`` (from ``offset``) that the primer does not allow; NULL if the sequence is too short."""
    count = F.lit(0)
    for i, letter in enumerate(primer):
        here = F.substring(seq, F.lit(offset) + i + 1 if isinstance(offset, int) else offset + i + 1, F.lit(1))
        count = count + F.when(F.lit(V.IUPAC.get(letter, letter)).contains(here), 0).otherwise(1)
    need = F.length(seq) - (F.lit(offset) if isinstance(offset, int) else offset)
    return F.when(need >= len(primer), count)


def starts_like(seq: Column, primer: str, allow: int = 2) -> Column:
    """True when the sequence starts with the primer within ``allow`` mismatches."""
    return F.coalesce(mismatches(seq, primer) <= allow, F.lit(False))


def find_approx(seq: Column, primer: str, allow: int = 1) -> Column:
    """0-based first position where the primer fits within ``allow`` mismatches, else -1."""
    last = F.length(seq) - len(primer)
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    letters = F.array(*[F.lit(V.IUPAC.get(ch, ch)) for ch in primer])

    def fits(start: Column) -> Column:
        window = F.split(F.substring(seq, start + 1, F.lit(len(primer))), "")
        pairs = F.zip_with(letters, window, lambda p, s: F.when(p.contains(s), 0).otherwise(1))
        return F.aggregate(pairs, F.lit(0), lambda acc, x: acc + x) <= allow

    return F.coalesce(F.try_element_at(F.filter(places, fits), F.lit(1)), F.lit(-1))


def phred(qual: Column) -> Column:
    """Quality string (offset 33) as an array of scores."""
    return F.transform(F.filter(F.split(qual, ""), lambda ch: ch != ""), lambda ch: F.ascii(ch) - 33)


def error_rates(scores: Column) -> Column:
    """Error probability of each score."""
    return F.transform(scores, lambda q: F.pow(F.lit(10.0), -q.cast("double") / 10))


def passing_length(errors: Column, cap: float | Column) -> Column:
    """Longest prefix whose summed error stays within the cap.

    The running sum never falls, so "passes at cut L" is the same as "passing length >= L" and one
    number per read replaces a row per base.
    """
    limit = F.lit(cap) if isinstance(cap, (int, float)) else cap
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc: Column, e: Column) -> Column:
        total = acc["total"] + e
        go = acc["open"] & (total <= limit)
        return F.struct(total.alias("total"), F.when(go, acc["n"] + 1).otherwise(acc["n"]).alias("n"), go.alias("open"))

    return F.aggregate(errors, start, step)["n"]


def expected_error(scores: Column) -> Column:
    """Sum of error probabilities of an array of scores."""
    return F.aggregate(scores, F.lit(0.0), lambda acc, q: acc + F.pow(F.lit(10.0), -q.cast("double") / 10))
