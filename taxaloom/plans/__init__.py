"""Composed jobs and the registered queries."""

from __future__ import annotations


def registered():
    """(queries, sql) of all query modules."""
    from . import catalog, cohort_queries, product_queries, source_queries, statistics_queries, table_queries, text_queries  # noqa: F401

    return dict(catalog.QUERIES), dict(catalog.SQL)
