"""Ordered rule lists compiled to Column expressions.

A rule list is ``[(label, pattern), ...]``.  Every function here returns one Column made of
built-in regex predicates, so a whole rule set stays inside code generation and short-circuits
at the first hit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]


def matches(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True where the pattern is found; NULL text never matches."""
    return F.coalesce(c.rlike(("(?i)" if ignore_case else "") + pattern), F.lit(False))


def case_when(branches: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """``CASE`` from (condition, value) pairs, tried in order."""
    if not branches:
        return otherwise
    (cond, value), *rest = branches
    chain = F.when(cond, value)
    for cond, value in rest:
        chain = chain.when(cond, value)
    return chain.otherwise(otherwise)


def blank(c: Column) -> Column:
    """True for NULL and for text of white space only."""
    return c.isNull() | ~F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def bucket(c: Column, rules: Rules, default: str = "Other / unclear", blank_label: str = "Not recorded") -> Column:
    """First matching rule wins; blank text keeps its own answer and is never forced into a class."""
    low = F.lower(c)
    branches = [(blank(c), F.lit(blank_label))]
    branches += [(low.rlike(pattern), F.lit(label)) for label, pattern in rules]
    return case_when(branches, F.lit(default))


def matching_labels(c: Column, rules: Rules, ignore_case: bool = True) -> Column:
    """Array of every matching label, in rule order."""
    return F.array_compact(F.array(*[F.when(matches(c, pattern, ignore_case), F.lit(label)) for label, pattern in rules]))


def all_matches(c: Column, rules: Rules, default: str = "", sep: str = ";", ignore_case: bool = True) -> Column:
    """Every matching label joined in rule order, or the default when nothing matches."""
    # replacing the empty text keeps this one evaluation of the patterns
    return F.regexp_replace(F.array_join(matching_labels(c, rules, ignore_case), sep), "^$", default)


def exactly_one(c: Column, rules: Rules) -> Column:
    """The matching label if one rule and no other matches, else NULL."""
    single = F.filter(F.array(matching_labels(c, rules, ignore_case=False)), lambda hits: F.size(hits) == 1)
    return F.try_element_at(F.try_element_at(single, F.lit(1)), F.lit(1))


def strip_pattern(c: Column, pattern: str) -> Column:
    """Replace each occurrence by one space (used to take negated terms out before matching)."""
    return F.regexp_replace(c, pattern, " ")


def strip_negations(c: Column, terms: str, joiners: str = r"(\s*[/,]\s*|\s+(or|and|nor)\s+)") -> Column:
    """Remove "not X", "un-X", "not X or Y, Z" as one negated list."""
    return strip_pattern(c, rf"\b(not|non|un)[-\s]*({terms})({joiners}({terms}))*")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def reasons(pairs: Sequence[tuple[Column, str | Column]], sep: str = ";") -> Column:
    """Texts of all conditions that hold, joined in the order given."""
    texts = [F.when(cond, text if isinstance(text, Column) else F.lit(text)) for cond, text in pairs]
    return F.array_join(F.array_compact(F.array(*texts)), sep)
