"""Viral dataset: which samples can answer what, blocks per paper, summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import any_of, case_when, matches, reasons
from ..functions.taxa import disease_bucket
from ..functions.text import lenient_double, nonblank
from .ordering import running_total, stored
from .reshape import is_nonzero
from .stats import counter_table


def stated(c: Column) -> Column:
    """True where a cell holds a usable label."""
    return nonblank(c).isNotNull() & ~matches(nonblank(c), V.NO_LABEL_VALUE, True)


def cell(row: Column, name: str) -> Column:
    return F.try_element_at(row, F.lit(name))


def resolve_labels(df: DataFrame, row: str = "row") -> DataFrame:
    """Add ``disease`` (first usable of the known columns) and ``source_label_fields`` (other label columns as k=v)."""
    m = F.col(row)
    disease = F.coalesce(*[F.when(stated(cell(m, c)), nonblank(cell(m, c))) for c in V.DISEASE_COLUMNS], F.lit(""))
    extra = F.filter(F.map_entries(m), lambda e: matches(e["key"], V.LABEL_COLUMN, True) & ~e["key"].isin(V.SAMPLE_COLUMNS) & nonblank(e["value"]).isNotNull())
    joined = F.array_join(F.transform(extra, lambda e: F.concat_ws("=", e["key"], nonblank(e["value"]))), "; ")
    return df.withColumns({"disease": disease, "source_label_fields": joined})


def usability_columns(subject: Column, timepoint: Column, group: Column) -> dict[str, Column]:
    """Level of a sample and what it can and cannot answer, from three yes/no facts."""
    level = case_when(
        [(subject & timepoint & group, F.lit("full")), (group & timepoint, F.lit("grouped_longitudinal")), (group, F.lit("grouped")),
         (subject | timepoint, F.lit("unlabelled_but_structured"))], F.lit("ids_only"))
    asks = [(group, "group comparison"), (subject & timepoint, "longitudinal / repeated measures"), (subject, "within-subject pairing")]
    can = F.concat_ws("; ", F.lit("; ".join(V.ALWAYS_ANSWERABLE)), F.nullif(reasons(asks, "; "), F.lit("")))
    return {"metadata_completeness": level, "can_answer": can, "cannot_answer": reasons([(~c, t) for c, t in asks], "; ")}


def usability(df: DataFrame, row: str = "row") -> DataFrame:
    m = F.col(row)
    group = stated(cell(m, "experimental_group")) | disease_bucket(cell(m, "disease_status")).isin("Case / disease", "Control / healthy") | any_of(
        [stated(cell(m, c)) for c in V.DISEASE_COLUMNS])
    return df.withColumns(usability_columns(stated(cell(m, "subject_id")), stated(cell(m, "timepoint")), group))


def matrix_type(df: DataFrame, recovery: dict[str, str] | None = None) -> DataFrame:
    """Viral-dedicated when the row rank is viral or all features are viral; recovery method from an override table.

    Input: paper_folder, row_rank, n_features, n_viral_features.
    """
    dedicated = (F.col("row_rank") == "vOTU / viral genome") | (F.col("n_viral_features") >= F.col("n_features"))
    method = F.lit(V.DEFAULT_RECOVERY)
    if recovery:
        pairs = [x for k, v in recovery.items() for x in (F.lit(k), F.lit(v))]
        method = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("paper_folder")), method)
    return df.withColumns({"matrix_type": F.when(dedicated, F.lit("viral_dedicated")).otherwise(F.lit("mixed")), "viral_recovery_method": method})


def blocks(cells: DataFrame, keys: list[str], sample: str, feature: str, value: str) -> DataFrame:
    """Per block: samples, features, cells, and nonzero / zero / blank cells with the nonzero share."""
    text = F.col(value).cast("string")
    zero = F.coalesce(lenient_double(text) == 0, F.lit(False))
    totals = cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(is_nonzero(F.col(value))).alias("n_nonzero"), F.count_if(zero).alias("n_zero"),
        F.count_if(nonblank(text).isNull()).alias("n_blank"))
    samples = cells.select(*keys, sample).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"))
    features = cells.select(*keys, feature).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_features"))
    out = totals.join(samples, keys).join(features, keys)
    return out.withColumn("share_nonzero", F.try_divide(F.col("n_nonzero"), F.col("n_cells")))


def block_places(members: DataFrame, block: str, member: str, name: str) -> DataFrame:
    """Members of all blocks with their global places: the block's offset (sizes of the blocks before it) plus the place inside the block."""
    inside = running_total(members.select(block, member).distinct(), [block], member, name="_local", whole="_size")
    sizes = inside.select(block, "_size").distinct()
    offsets = running_total(sizes, [], block, F.col("_size"), name="_offset").select(block, "_offset")
    return inside.join(offsets, block).select(block, member, (F.col("_offset") + F.col("_local")).cast("bigint").alias(name))


def block_diagonal(cells: DataFrame, block: str, sample: str, feature: str, value: str, samples: DataFrame | None = None,
                   features: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(coordinates, rows, columns) of one matrix of all blocks: block, row, col, value of every nonzero cell, and what each row and column stands for.

    Blocks share no row and no column, so the matrix is block-diagonal in the order of the blocks. ``samples`` and ``features`` (block, member) say
    which rows and columns there are, also those without a nonzero cell; the members that occur in ``cells`` otherwise.
    """
    rows = stored(block_places(cells if samples is None else samples, block, sample, "row"))
    columns = stored(block_places(cells if features is None else features, block, feature, "col"))
    placed = cells.where(is_nonzero(F.col(value))).join(rows, [block, sample]).join(columns, [block, feature])
    return placed.select(block, "row", "col", value), rows, columns


def completeness_text(samples: DataFrame, key: str = "paper_folder", level: str = "metadata_completeness") -> DataFrame:
    """Histogram of completeness levels per paper as text, most common first (five possible levels)."""
    counted = samples.groupBy(key, level).agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.concat_ws("=", level, "n").alias("t"))))
    return counted.groupBy(key).agg(F.array_join(F.transform(listed, lambda s: s["t"]), "; ").alias("completeness"))


def deepest_of(columns: list[str], none: str = "No taxonomy") -> Column:
    """Name of the last filled column."""
    hits = F.array_compact(F.array(*[F.when(nonblank(F.col(c).cast("string")).isNotNull(), F.lit(c)) for c in columns]))
    return F.coalesce(F.try_element_at(hits, F.lit(-1)), F.lit(none))


def viral_summaries(features: DataFrame, samples: DataFrame) -> dict[str, DataFrame]:
    """Deepest rank, disease status, recovery method and completeness, each with its share.

    features: rank columns, viral_recovery_method; samples: disease_status, metadata_completeness.
    """
    deep = deepest_of(V.VIRAL_RANKS)
    shown = F.when(deep.isin("No taxonomy"), deep).when(deep.isin("family", "kingdom", "species", "class"), F.initcap(deep)).otherwise(F.lit("Other ranks"))
    vlp = F.when(F.col("viral_recovery_method").contains("VLP"), F.lit("VLP-enriched virome")).otherwise(F.lit("bulk shotgun / incidental"))
    return {
        "viral_rank_depth": counter_table(features.withColumn("deepest_rank", shown), "deepest_rank"),
        "viral_disease_status": counter_table(samples.withColumn("status", disease_bucket(F.col("disease_status"))), "status"),
        "viral_recovery_method": counter_table(features.withColumn("recovery", vlp), "recovery"),
        "viral_metadata_completeness": counter_table(samples, "metadata_completeness"),
    }
