"""What the operators share: session settings for Arrow exchange, stored tables, sizes."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import cut_lineage, shared_folder, stored  # noqa: F401

#: Arrow batches carry whole texts; these bounds keep a batch of long texts small in a task's memory.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, and let Python workers find this package where the driver found it."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def in_batches(fn: Callable[..., pa.RecordBatch | None], *args) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn(batch, *args)`` over every Arrow batch of a partition."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch, *args)) is not None:
                yield out

    return run


def text_bytes_total(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column: one scan of that column, one number."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(total: int, each: int, least: int = 1) -> int:
    """How many groups of ``each`` a total needs."""
    return max(least, -(-total // each))


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores before it while a column's name begins like that."""
    while any(c.startswith(wanted) for c in columns):
        wanted = "_" + wanted
    return wanted
