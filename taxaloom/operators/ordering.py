"""Order-dependent operators: first/last per key, ranks, running totals, samples, quantiles.

"First seen" is always an explicit order column, never the accident of partition order.  One-row-per-key
results are aggregates (combined before the shuffle).  Ranks and running totals do not put a key's rows
into one task: rows are sorted into ranges of (keys, order, ties) and written once, ranges are totalled with a
small aggregate, and only the rows of one range meet in a task, however many share a key or an order value.
"""

from __future__ import annotations

import functools
import operator
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import letter_suffix

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that outlive executors: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    if folder is None and context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
    return folder or _LOCAL_FOLDERS[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint of an iterative job."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


#: Rows and bytes of an Arrow batch of whole texts, so that a Python worker's memory depends on no number of rows.
TEXT_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of few bytes from here on; only a text beyond the bound makes a larger one."""
    for key, value in TEXT_BATCH.items():
        spark.conf.set(key, value)


_STORED: dict[str, list[str]] = {}


def scratch(spark: SparkSession) -> str:
    """Path for a folder of files that ``drop_stored`` deletes."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate table once where several outputs read it; readers prune columns and survive lost executors.

    The table stays until ``drop_stored``: results are lazy, so only the caller knows when they have been written.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Delete the intermediate tables this session has stored; call it when the results that read them are written. Returns how many went."""
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


#: Rows that one task of ``counted`` holds.
ROWS_A_TASK = 1 << 18


def counted(df: DataFrame, keys: Sequence[str], within: Sequence[str], name: str = "n") -> DataFrame:
    """How often each combination of ``keys`` occurs; afterwards rows that agree in ``within``, some of the keys, are in one task.

    For keys that hardly repeat: rows are dealt to as many tasks as keep each at about ``ROWS_A_TASK``, so that a task's memory is set neither by the
    splits of the files nor by the number of shuffle partitions. Equal rows are counted by part of the input first; a combination repeated without end
    comes together as one row for each part.
    """
    parts = max(1, -(-df.count() // ROWS_A_TASK))
    spread = df.select(*keys, F.spark_partition_id().alias("_from")).repartition(parts, *within, "_from")
    once = spread.groupBy(*keys, "_from").agg(F.count(F.lit(1)).alias("_n"))
    return once.repartition(parts, *within).groupBy(*keys).agg(F.sum("_n").alias(name))


def _row_struct(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in keys])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order."""
    picked = df.groupBy(*keys).agg(F.min_by(_row_struct(df, keys), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_state(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current state of an append-only ledger: the last row per key."""
    picked = df.groupBy(*keys).agg(F.max_by(_row_struct(df, keys), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def worst_of(df: DataFrame, keys: Sequence[str], label: str, severity: Sequence[str], sep: str = ";") -> DataFrame:
    """Per key the most severe label and all labels in order of severity (labels come from a fixed list)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in severity]), F.col(label))
    found = df.where(F.col(label).isin(list(severity))).groupBy(*keys).agg(
        *[F.bool_or(F.col(label) == s).alias(f"_has_{i}") for i, s in enumerate(severity)],
        F.min_by(label, rank).alias("primary"),
    )
    listed = F.array_compact(F.array(*[F.when(F.col(f"_has_{i}"), F.lit(s)) for i, s in enumerate(severity)]))
    return found.select(*keys, "primary", F.array_join(listed, sep).alias("all_labels"))


def dominant(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Most common value per key; ties go to the value seen first. Columns: keys, value, n."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("_first")
    )
    best = F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("_first")))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def top_k(df: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column]) -> DataFrame:
    """First k rows of each list. Spark prunes to k rows per list before it shuffles."""
    if not keys:
        return df.orderBy(*order).limit(k)
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).where(F.col("_spot") <= k).drop("_spot")


def top_k_fold(df: DataFrame, label: str, n: str, k: int = 5, order: str | None = None) -> DataFrame:
    """Largest k categories of a counted table, everything else as ``Other (m categories)``."""
    ties = F.col(order or label).asc()
    head = df.orderBy(F.col(n).desc(), ties).limit(k).select(F.col(label).alias("label"), F.col(n).alias("n"))
    # the broadcast side is the head: never more than k rows
    rest = df.join(F.broadcast(head.select(F.col("label").alias(label))), label, "left_anti")
    other = rest.agg(F.count(F.lit(1)).alias("m"), F.sum(n).alias("n")).where("m > 0")
    return head.unionByName(other.select(F.format_string("Other (%d categories)", F.col("m")).alias("label"), "n"))


def in_ranges(df: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` sorted by all of ``by``, written once, with ``_at``: the number of its range times 2^33 plus its place in the range.

    Spark samples the borders on the composite of all columns, so rows that agree in the first ones are still dealt evenly; only rows that agree in
    all of them meet. The number of ranges is the session's number of shuffle partitions, as for any other exchange, unless it is given. Sampling
    reads ``df`` once more: store it first where it is expensive and has no exchange of its own.
    """
    spread = df.repartitionByRange(*([ranges] if ranges else []), *by)
    return stored(spread.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return functools.reduce(operator.and_, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def running(df: DataFrame, keys: Sequence[str], order: str, sums: Mapping[str, Column] | None = None, highs: Mapping[str, Column] | None = None,
            ties: Sequence[str] = (), ranges: int | None = None, wholes: Mapping[str, str] | None = None) -> DataFrame:
    """Sums and maxima over the rows of the key that come before this row; a maximum over no row, or over nulls only, is null.

    ``sums`` and ``highs`` name the new columns, ``wholes`` names columns for whole sums of a key (new name -> name of the sum). Rows equal in keys, order
    and ties take their places in any order. Prefixes have two levels: inside a range over its rows, and over one row for each range of a key.
    """
    sums, highs, wholes = dict(sums or {}), dict(highs or {}), dict(wholes or {})
    given = df.withColumns({**{f"_w_{n}": c for n, c in sums.items()}, **{f"_w_{n}": c for n, c in highs.items()}})
    cut = in_ranges(given, [*keys, order, *ties], ranges).withColumn("_range", F.shiftrightunsigned("_at", 33))
    groups = [*keys, "_range"]
    found = cut.groupBy(*groups).agg(*[F.sum(f"_w_{n}").alias(f"_w_{n}") for n in sums], *[F.max(f"_w_{n}").alias(f"_w_{n}") for n in highs])
    one_key = Window.partitionBy(*keys or [F.lit(0)])
    before = one_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(f"_w_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums]
    carried += [F.max(f"_w_{n}").over(before).alias(f"_c_{n}") for n in highs]
    carried += [F.sum(f"_w_{n}").over(one_key).alias(f"_c_{new}") for new, n in wholes.items()]
    found = found.select(*[F.col(k).alias(f"_k_{k}") for k in groups], *carried)
    inner = Window.partitionBy(*groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumns({**{f"_i_{n}": F.coalesce(F.sum(f"_w_{n}").over(inner), F.lit(0)) for n in sums}, **{f"_i_{n}": F.max(f"_w_{n}").over(inner) for n in highs}})
    joined = cut.join(found, _null_safe(cut, found, [(k, f"_k_{k}") for k in groups]))
    return joined.select(*df.columns, *[(F.col(f"_c_{n}") + F.col(f"_i_{n}")).alias(n) for n in sums],
                         *[F.greatest(f"_c_{n}", f"_i_{n}").alias(n) for n in highs], *[F.col(f"_c_{n}").alias(n) for n in wholes])


def running_total(df: DataFrame, keys: Sequence[str], order: str, weight: Column | None = None, name: str = "total_before",
                  ties: Sequence[str] = (), ranges: int | None = None, whole: str | None = None) -> DataFrame:
    """Sum of ``weight`` over the rows of the key that come before this row, and, if ``whole`` names a column, over all rows of the key.

    Without a weight the sum is a place, which the sorted range knows already, so there is no second exchange.
    """
    if weight is not None:
        return running(df, keys, order, {name: weight}, ties=ties, ranges=ranges, wholes={whole: name} if whole else None)
    cut = in_ranges(df, [*keys, order, *ties], ranges).withColumn("_range", F.shiftrightunsigned("_at", 33))
    groups = [*keys, "_range"]
    found = cut.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # one row per range of a key meets in these windows, never the rows themselves
    one_key = Window.partitionBy(*keys or [F.lit(0)])
    offset = F.coalesce(F.sum("_n").over(one_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = found.select(*[F.col(k).alias(f"_k_{k}") for k in groups], offset.alias("_offset"), F.sum("_n").over(one_key).alias("_whole"), "_first")
    joined = cut.join(found, _null_safe(cut, found, [(k, f"_k_{k}") for k in groups]))
    return joined.select(*df.columns, (F.col("_offset") + F.col("_at") - F.col("_first")).alias(name), *([F.col("_whole").alias(whole)] if whole else []))


def machine_states(df: DataFrame, keys: Sequence[str], order: str, from_0: Column, from_1: Column, name: str = "state", ranges: int | None = None) -> DataFrame:
    """State (0 or 1) in which a machine of two states meets each row, in order, from state 0; a row sends 0 to ``from_0`` and 1 to ``from_1``.

    A row keeps, swaps or sets the state. So the state is what was set last, turned over as often as rows swapped since; both are prefixes, and a
    range of rows composes to one such map whatever its length.
    """
    lit = lambda c: c.cast("long")
    mapped = df.withColumns({"_f0": lit(from_0), "_f1": lit(from_1)})
    swaps = running(mapped, keys, order, {"_swaps": lit((F.col("_f0") == 1) & (F.col("_f1") == 0))}, ranges=ranges)
    # what a row sets, as it would have to be before all swaps to give this now
    set_here = F.when(F.col("_f0") == F.col("_f1"), F.struct(F.col(order).alias("o"), ((F.col("_f0") + F.col("_swaps")) % 2).alias("v")))
    done = running(swaps, keys, order, highs={"_set": set_here}, ranges=ranges)
    return done.select(*df.columns, ((F.coalesce("_set.v", F.lit(0)) + F.col("_swaps")) % 2).cast("int").alias(name))


def ranked(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), name: str = "ordinal", ranges: int | None = None) -> DataFrame:
    """1-based position of a row within its key."""
    out = running_total(df, keys, order, name=name, ties=ties, ranges=ranges)
    return out.withColumn(name, F.col(name).cast("bigint") + 1)


def positional_slice(df: DataFrame, spec: str, order: str) -> DataFrame:
    """``"10"`` = the first ten, ``"20-30"`` = rows 20 to 30 (1-based, inclusive) of the ordered list."""
    lo, _, hi = spec.partition("-")
    first, last = (int(lo), int(hi)) if hi else (1, int(lo))
    if first < 1 or last < first:
        raise ValueError(f"not a valid slice: {spec!r}")
    return ranked(df, [], order).where(F.col("ordinal").between(first, last)).drop("ordinal")


def take_next(df: DataFrame, n: int, order: str) -> DataFrame:
    """First n rows in source order."""
    return df.orderBy(order).limit(n)


def unique_names(df: DataFrame, base: str, order: str, name: str = "unique_name", sep: str = "") -> DataFrame:
    """First holder keeps the base name, later ones get a letter suffix in arrival order."""
    out = ranked(df, [base], order, name="_spot")
    suffix = letter_suffix(F.col("_spot") - 1)
    full = F.when(F.col("_spot") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit(sep), suffix))
    return out.withColumn(name, full).drop("_spot")


def systematic_sample(df: DataFrame, k: int, keys: Sequence[str], order: str) -> DataFrame:
    """k evenly spaced rows per key: positions round(i*(n-1)/max(k-1,1)), halves to even."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    spots = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(k), F.col("_n")).cast("int") - 1),
        lambda i: F.bround(i.cast("double") * (F.col("_n") - 1) / max(k - 1, 1)).cast("bigint"),
    )
    wanted = sizes.select(*keys, F.explode(F.array_distinct(spots)).alias("_spot"))
    placed = ranked(df, keys, order, name="_ordinal").withColumn("_spot", F.col("_ordinal") - 1)
    return placed.join(wanted, [*keys, "_spot"], "left_semi").select(*df.columns)


def counted_positions(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of a key with how many rows hold them (_c), how many come before (_before) and the key's rows (n)."""
    counted = df.select(*keys, F.col(value).alias("_v")).where("_v IS NOT NULL").groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return running_total(counted, keys, "_v", F.col("_c"), name="_before", whole="n")


def value_at(spot: Column) -> Column:
    """Aggregate over ``counted_positions``: the value at a 1-based position of the sorted rows."""
    return F.max(F.when((spot > F.col("_before")) & (spot <= F.col("_before") + F.col("_c")), F.col("_v")))


def exclusive_quantiles(df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int]) -> DataFrame:
    """Quantiles by the exclusive method (position i*(n+1)/100, clamped to the data), one row per (key, percent).

    Equal values are counted first, so what is ordered is the distinct values; keys with a single value have no quantile.
    """
    def spot(p: int) -> Column:
        return F.greatest(F.lit(1), F.least(F.floor(F.lit(p) * (F.col("n") + 1) / 100), F.col("n") - 1))

    ends = [agg for p in percents for agg in (value_at(spot(p)).alias(f"_lo{p}"), value_at(spot(p) + 1).alias(f"_hi{p}"))]
    found = counted_positions(df, keys, value).where("n >= 2").groupBy(*keys).agg(F.max("n").alias("n"), *ends)

    def between(p: int) -> Column:
        d = F.lit(p) * (F.col("n") + 1) - 100 * spot(p)
        return (F.col(f"_lo{p}") * (100 - d) + F.col(f"_hi{p}") * d) / 100

    pairs = F.array(*[F.struct(F.lit(p).alias("percent"), between(p).alias("quantile")) for p in percents])
    return found.select(*keys, "n", F.inline(pairs)).where("quantile IS NOT NULL")
