"""Sinks. Large results stay Parquet; the text tables here are small end products.

A committed table is a folder of data folders and numbered pointers. A write makes a new data folder and then puts the next pointer in place, which
names all folders of the table; until then readers see the table as it was. A crash between any two steps leaves files nobody points to, which
``recover`` deletes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import append_new

_POINTERS = "_pointers"


def write_table(df: DataFrame, path: str, order: Sequence | None = None) -> None:
    """One CSV file with a header and a byte-order mark on its first column name; for summary tables only."""
    out = df.orderBy(*order) if order else df
    first, *rest = out.columns
    marked = out.select(F.col(f"`{first}`").alias("﻿" + first), *[F.col(f"`{c}`") for c in rest])
    marked.coalesce(1).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


# ---------------------------------------------------------------------------
# committed tables
# ---------------------------------------------------------------------------
class _Files:
    """The few steps on a file system that a commit is made of."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(folder))) if self.exists(folder) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"another writer has put {target} in place")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _current(files: _Files, path: str) -> tuple[int, list[str]]:
    """Number of the last pointer and the data folders it names."""
    numbers = [int(n) for n in files.names(f"{path}/{_POINTERS}") if n.isdigit()]
    if not numbers:
        return 0, []
    return max(numbers), files.read(f"{path}/{_POINTERS}/{max(numbers):012d}").split()


def _commit(df: DataFrame, path: str, keep: bool) -> int:
    """Write rows to a data folder of their own and point to it; returns how many rows the write itself counted."""
    files = _Files(df.sparkSession, path)
    number, folders = _current(files, path)
    folder = f"data-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{folder}")
    draft = f"{path}/{_POINTERS}/draft-{uuid.uuid4().hex}"
    files.write(draft, "\n".join([*(folders if keep else []), folder]))
    files.rename(draft, f"{path}/{_POINTERS}/{number + 1:012d}")
    return seen.get["n"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed table as the last complete write left it."""
    _, folders = _current(_Files(spark, path), path)
    if not folders:
        raise FileNotFoundError(f"no committed table at {path}")
    return spark.read.parquet(*[f"{path}/{f}" for f in folders])


def append_rows(new: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Append rows whose key is not on file yet; returns how many were written. The target is not counted."""
    spark = new.sparkSession
    _, folders = _current(_Files(spark, path), path)
    return _commit(append_new(new, read_table(spark, path), keys) if folders else new, path, keep=True)


def replace_table(df: DataFrame, path: str) -> int:
    """Put a new table in the place of the old one: readers see the one or the other. Old folders stay until ``recover``."""
    return _commit(df, path, keep=False)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Delete what no reader needs: folders of writes that did not end, folders and pointers of tables replaced. For times without a writer."""
    files = _Files(spark, path)
    number, folders = _current(files, path)
    useless = [f"{path}/{n}" for n in files.names(path) if n.startswith("data-") and n not in folders]
    useless += [f"{path}/{_POINTERS}/{n}" for n in files.names(f"{path}/{_POINTERS}") if not n.isdigit() or int(n) < number]
    for name in useless:
        files.delete(name)
    return useless


def split_outputs(df: DataFrame, column: str, path: str, fmt: str = "parquet") -> None:
    """One folder per value of the column in one write."""
    df.write.mode("overwrite").option("header", True).partitionBy(column).format(fmt).save(path)


def write_dense(lines: DataFrame, table: str, path: str) -> None:
    """Lines of ``reshape.dense_lines``: a folder per table, whose files in the order of their names are its matrix."""
    lines.select(table, "line").write.mode("overwrite").partitionBy(table).text(path)
