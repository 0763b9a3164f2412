"""Registry of queries: name -> (DataFrame builder, SQL that states the same result)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables of one folder, opened lazily: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``fn(tables)`` under its own name, with the SQL it must agree with."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def n_rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def pick(k: str, values: Sequence[str | None]) -> str:
    """One of the values by a whole number; the same text in both engines."""
    texts = ["CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values]
    return f"CASE CAST(({k}) % {len(values)} AS INT) " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END"
