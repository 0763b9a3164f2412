"""Alignments and profiles: identity filter, interval coverage, detection, relative abundance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .ordering import running


def identity_filter(aln: DataFrame, min_identity: float) -> DataFrame:
    """Alignments whose edits fit the identity: nm <= (1 - id) * read length."""
    return aln.where(F.col("nm") <= (1 - min_identity) * F.col("read_len"))


def identity_counts(aln: DataFrame, keys: Sequence[str], keep: Column) -> DataFrame:
    """Alignments before and after a filter in one pass."""
    return aln.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_before"), F.count_if(F.coalesce(keep, F.lit(False))).alias("n_after"))


def union_length(intervals: DataFrame, keys: Sequence[str], ranges: int | None = None, start: str = "start", end: str = "end") -> DataFrame:
    """Length covered by half-open integer intervals per key, with their number and summed length.

    Of the intervals with one start the longest is kept, and each adds what lies beyond the farthest end so far. That end is a running maximum carried
    over sorted ranges, so an interval stays one row whatever its length, and neither a deep nor a long key meets in one task.
    """
    totals = intervals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_intervals"), F.sum(F.greatest(F.col(end) - F.col(start), F.lit(0))).alias("summed_length"))
    longest = intervals.where(F.col(end) > F.col(start)).groupBy(*keys, F.col(start).alias("_s")).agg(F.max(end).alias("_e"))
    reached = running(longest, keys, "_s", highs={"_reach": F.col("_e")}, ranges=ranges)
    new = F.greatest(F.col("_e") - F.greatest("_reach", "_s"), F.lit(0))
    covered = reached.groupBy(*keys).agg(F.sum(new).alias("covered_length"))
    return totals.join(covered, list(keys), "left").na.fill({"covered_length": 0})


def interval_coverage(aln: DataFrame, lengths: DataFrame) -> DataFrame:
    """Per (sample, genome): reads, covered bases, breadth, mean depth. lengths: genome, length."""
    base = union_length(aln, ["sample", "genome"]).join(lengths, "genome")
    return base.select("sample", "genome", F.col("n_intervals").alias("reads"), F.col("covered_length").alias("covered_bases"),
                       (F.col("covered_length") / F.col("length")).alias("breadth"), (F.col("summed_length") / F.col("length")).alias("mean_depth"))


def detect(cov: DataFrame, breadth: float = V.MIN_BREADTH, depth: float = V.MIN_DEPTH) -> DataFrame:
    return cov.where((F.col("breadth") >= breadth) & (F.col("mean_depth") >= depth))


def mapping_stats(cov: DataFrame, breadth: float = V.MIN_BREADTH, depth: float = V.MIN_DEPTH) -> DataFrame:
    """Per sample: genomes with any read and genomes detected."""
    hit = (F.col("breadth") >= breadth) & (F.col("mean_depth") >= depth)
    return cov.groupBy("sample").agg(F.count(F.lit(1)).alias("genomes_with_any_read"), F.count_if(hit).alias("genomes_detected"), F.sum("reads").alias("reads"))


def samples_detected(hits: DataFrame) -> DataFrame:
    return hits.select("genome", "sample").distinct().groupBy("genome").agg(F.count(F.lit(1)).alias("n_samples_detected"))


def relative_abundance(df: DataFrame, sample: Sequence[str], value: str, on_zero: str = "error", digits: int | None = None,
                       name: str = "relative_abundance") -> DataFrame:
    """Value over its own sample's total. The totals are a combined aggregate joined back, so a huge sample is not
    gathered in one task; a zero total raises or gives zero."""
    totals = df.groupBy(*sample).agg(F.sum(value).alias("_total"))
    joined = df.join(totals, list(sample))
    zero = F.raise_error(F.lit("a sample has a total of zero")).cast("double") if on_zero == "error" else F.lit(0.0)
    out = F.when(F.col("_total") != 0, F.col(value) / F.col("_total")).otherwise(zero)
    return joined.withColumn(name, F.bround(out, digits) if digits is not None else out).drop("_total")


def check_rows_sum(df: DataFrame, sample: Sequence[str], value: str = "relative_abundance", tolerance: float = 1e-9) -> DataFrame:
    """Samples whose shares do not add up to one."""
    return df.groupBy(*sample).agg(F.sum(value).alias("total")).where(F.abs(F.col("total") - 1) > tolerance)
