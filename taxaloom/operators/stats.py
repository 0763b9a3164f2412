"""Database-wide statistics over the rows of all papers at once.

Inputs with free headers are held as ``(paper_folder, row_idx, row map<text,text>)``; columns are found by their
lower-cased header, so one job serves every paper.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import blank, bucket, case_when, matches
from ..functions.taxa import (
    disease_bucket, feature_domain, host_of, ictv_rank, known_taxon, normalise_disease, paper_domain, unit_bucket,
)
from ..functions.text import first_nonblank, lenient_int, lower_keys, nonblank, share
from .ordering import counted_positions, dominant, stored, top_k, value_at

NOT_A_HOST_COLUMN = r"(^|_)host(_|$)"
KINGDOM_COLUMN = r"(^|_)(realm|kingdom|domain|superkingdom)(_|$)"
LINEAGE_COLUMN = r"taxonomy|lineage|taxon_path|classification"
NAME_COLUMN = r"^(cleaned_name|original_name|feature_id)$"
RANK_COLUMN = r"^(taxonomic_rank|feature_level)$"


def whole(df: DataFrame, agg: Column) -> Column:
    """Scalar of an aggregate over the whole table (one value, computed once)."""
    return df.agg(agg).scalar()


def with_share(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    return df.withColumn(name, share(F.col(value), whole(df, F.sum(value))))


def counter_table(df: DataFrame, key: str, value: str = "n", weight: str | None = None) -> DataFrame:
    """Count (or weigh) rows per value of a column, with the share of the total."""
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return with_share(df.groupBy(key).agg(measure.alias(value)), value)


def counter_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``counter_table`` of several columns in one pass over the rows: column, label, n, share."""
    labels = F.coalesce(*[F.when(F.grouping(c) == 0, F.struct(F.lit(c).alias("column"), F.col(c).alias("label"))) for c in columns])
    counted = df.groupingSets([[c] for c in columns], *columns).agg(F.count(F.lit(1)).alias("n"), labels.alias("_l"))
    # every grouping set counts each row once; its sum is over as many rows as there are labels
    total = F.sum("n").over(Window.partitionBy("_l.column"))
    return counted.select("_l.column", "_l.label", "n", share(F.col("n"), total).alias("share"))


def median_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact median per key from counted distinct values (no per-key list of all rows)."""
    lo, hi = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    return counted_positions(df, keys, value).groupBy(*keys).agg(((value_at(lo) + value_at(hi)) / 2).alias("median"), F.max("n").alias("n"))


# ---------------------------------------------------------------------------
# cohort
# ---------------------------------------------------------------------------
def cohort(papers: DataFrame, queues: DataFrame, rescued: DataFrame, key: str = "paper_folder") -> DataFrame:
    """Integrated papers that no triage queue holds, plus the rescued ones. queues: key, queue."""
    drop = queues.select(key).distinct().join(rescued.select(key).distinct(), key, "left_anti")
    return papers.join(drop, key, "left_anti")


def excluded_cost(papers: DataFrame, queues: DataFrame, rescued: DataFrame, domains: DataFrame) -> DataFrame:
    """What each queue takes away: one row per (queue, paper) with features per domain. domains: paper_folder, domain, n."""
    counts = domains.groupBy("paper_folder").agg(*[
        F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n_features_{d.lower()}") for d in V.DOMAIN_LABELS[:5]])
    drop = queues.select("paper_folder", "queue").distinct().join(rescued.select("paper_folder").distinct(), "paper_folder", "left_anti")
    facts = papers.select("paper_folder", lenient_int(F.col("n_samples").cast("string")).alias("n_samples"),
                          lenient_int(F.col("n_features").cast("string")).alias("n_features"))
    return drop.join(facts, "paper_folder", "left").join(counts, "paper_folder", "left").na.fill(0)


# ---------------------------------------------------------------------------
# samples
# ---------------------------------------------------------------------------
def classify_samples(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """Sample rows resolved to named columns. papers: paper_folder, host_hint.

    Labels repeat over samples, so every rule runs once per distinct text; the answers are joined back.
    """
    m = F.col("_m")
    pick = lambda *names: first_nonblank(m, names)
    out = stored(rows.select("paper_folder", "row_idx", lower_keys(F.col("row")).alias("_m")).select(
        "paper_folder", "row_idx", pick("sample_type", "sample_type_detail", "body_site").alias("sample_type"),
        pick("host", "host_species", "host_common_name", "organism").alias("host"), pick("disease_status", "disease_state").alias("disease_status"),
        pick("measurement_method", "assay", "sequencing_method").alias("method"), pick("disease", "disease_name").alias("disease_raw"),
        pick("experimental_group", "group", "treatment").alias("group"), pick("subject_id", "subject", "individual_id", "animal_id").alias("subject"),
        pick("timepoint", "time_point", "timepoint_description", "day").alias("timepoint"), pick("sex", "gender").alias("sex"),
        pick("age_years", "age", "age_group", "age_bin").alias("age")))
    out = out.join(papers.select("paper_folder", "host_hint"), "paper_folder", "left")
    out = per_value(out, ["sample_type"], {"sample_type_class": bucket(F.col("sample_type"), V.SAMPLE_TYPES, "Other / unspecified")})
    out = per_value(out, ["host", "sample_type", "host_hint"], {"host_class": host_of(F.col("host"), F.col("sample_type"), F.col("host_hint"))})
    out = per_value(out, ["disease_status"], {
        "disease_class": disease_bucket(F.col("disease_status")),
        "is_labelled": F.col("disease_status").isNotNull() & ~matches(F.lower("disease_status"), V.UNLABELLED_STATUS)})
    out = per_value(out, ["method", "sample_type"], {"assay": bucket(F.concat_ws(" ", "method", "sample_type"), V.ASSAYS)})
    return per_value(out, ["disease_raw"], {"disease": nonblank(normalise_disease(F.col("disease_raw"))["name"])})


def per_value(df: DataFrame, columns: Sequence[str], answers: dict[str, Column]) -> DataFrame:
    """``df`` with columns that depend on ``columns`` alone, worked out once for each of their distinct values, nulls included.

    The answers are written, so that Spark broadcasts them where they are few and joins them by shuffles where they are many.
    """
    known = stored(df.select(*columns).distinct().select(*[F.col(c).alias(f"_of_{c}") for c in columns], *[a.alias(n) for n, a in answers.items()]))
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(known[f"_of_{c}"]) for c in columns])
    return df.join(known, same, "left").drop(*[f"_of_{c}" for c in columns])


def sample_facts(samples: DataFrame) -> DataFrame:
    """Per paper: labelled counts, distinct subjects, longitudinal = a subject with more than one row."""
    filled = {"n_group_labelled": "group", "n_subject": "subject", "n_timepoint": "timepoint", "n_sex": "sex", "n_age": "age"}
    base = samples.groupBy("paper_folder").agg(
        F.count(F.lit(1)).alias("n_meta_rows"), F.count_if("is_labelled").alias("n_disease_labelled"), *[F.count(c).alias(n) for n, c in filled.items()])
    return base.join(repeats_of(samples, ["paper_folder"], "subject"), "paper_folder", "left").na.fill({"n_subjects_distinct": 0}).withColumn(
        "is_longitudinal", F.coalesce("is_longitudinal", F.lit(False)))


def repeats_of(df: DataFrame, keys: Sequence[str], subject: str) -> DataFrame:
    """Distinct subjects per key and whether any of them has more than one row."""
    per_subject = df.where(F.col(subject).isNotNull()).groupBy(*keys, subject).agg(F.count(F.lit(1)).alias("_n"))
    return per_subject.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_subjects_distinct"), F.bool_or(F.col("_n") > 1).alias("is_longitudinal"))


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------
def own_entries(row: Column) -> Column:
    """Map entries in header order with lower-cased headers, without the annotations of a host."""
    lowered = F.transform(F.map_entries(row), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    return F.filter(lowered, lambda e: ~matches(e["key"], NOT_A_HOST_COLUMN))


def _entries(own: Column, pattern: str) -> Column:
    return F.filter(own, lambda e: matches(e["key"], pattern))


def _first_found(own: Column, pattern: str, read, found=lambda v: v.isNotNull()) -> Column:
    """First reading among the matching columns that says something."""
    return F.try_element_at(F.filter(F.transform(_entries(own, pattern), lambda e: read(e["value"])), found), F.lit(1))


def rank_pattern(rank: str) -> str:
    return KINGDOM_COLUMN if rank in ("kingdom", "realm") else rf"(^|_)({rank}|{rank[0]})$"


def feature_domain_rows(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """Domain of each feature and what it rests on: kingdom column, lineage, name, else the paper. papers: paper_folder, paper_domain."""
    named = lambda v: F.when(v.contains(";") | v.contains("__"), feature_domain(v))

    def stated(pattern: str, read, evidence: str) -> Column:
        answer = lambda v: F.struct(read(v).alias("domain"), F.lit(evidence).alias("evidence"))
        return _first_found(F.col("_own"), pattern, answer, lambda s: s["domain"].isNotNull())

    # each source is read only where the ones before it say nothing
    answer = F.coalesce(
        stated(KINGDOM_COLUMN, feature_domain, "kingdom column"), stated(LINEAGE_COLUMN, feature_domain, "lineage string"), stated(NAME_COLUMN, named, "feature name"),
        F.struct(F.coalesce("paper_domain", F.lit("Unclassified")).alias("domain"), F.lit("paper-level fallback").alias("evidence")))
    ranks = _entries(F.col("_own"), RANK_COLUMN)
    first_rank = F.try_element_at(F.filter(ranks, lambda e: ~blank(e["value"])), F.lit(1))["value"]
    row_rank = F.when(F.size(ranks) > 0, F.coalesce(bucket(first_rank, V.ROW_RANKS, "Other / mixed", "Other / mixed"), F.lit("Other / mixed")))
    out = rows.join(papers.select("paper_folder", "paper_domain"), "paper_folder", "left")
    read = out.withColumn("_own", own_entries(F.col("row"))).select(*out.columns, answer.alias("_a"), row_rank.alias("row_rank"))
    return read.select(*out.columns, "_a.domain", "_a.evidence", "row_rank")


def lineage_fill(rows: DataFrame, ranks: Sequence[str] = V.LINEAGE_RANKS) -> DataFrame:
    """One row per filled rank: paper_folder, row_idx, column_rank, true_rank, name. A viral name overrides its column."""
    # names are cleaned once per cell, then every rank takes its first filled column
    any_rank = "|".join(f"({rank_pattern(r)})" for r in ranks)
    named = F.transform(_entries(own_entries(F.col("row")), any_rank), lambda e: F.struct(e["key"].alias("key"), known_taxon(e["value"]).alias("value")))
    cleaned = rows.select("paper_folder", "row_idx", F.filter(named, lambda e: e["value"].isNotNull()).alias("_named"))
    picks = [F.struct(F.lit(r).alias("column_rank"), F.try_element_at(_entries(F.col("_named"), rank_pattern(r)), F.lit(1))["value"].alias("name")) for r in ranks]
    long = cleaned.select("paper_folder", "row_idx", F.explode(F.array(*picks)).alias("p")).select("paper_folder", "row_idx", "p.*").where("name IS NOT NULL")
    return long.withColumn("true_rank", F.coalesce(ictv_rank(F.col("name")), F.col("column_rank")))


def lineage_columns(rows: DataFrame, ranks: Sequence[str] = V.LINEAGE_RANKS) -> DataFrame:
    """Ranks a paper's table has a column for."""
    # the distinct headers of a paper come first: the patterns then run per header, not per row
    headers = rows.select("paper_folder", F.map_keys("row").alias("_k")).distinct()
    own = F.filter(F.transform("_k", lambda k: F.lower(F.trim(k))), lambda k: ~matches(k, NOT_A_HOST_COLUMN))

    def has_column(pattern: str) -> Column:
        return F.exists(own, lambda k: matches(k, pattern))

    has = [F.when(has_column(rank_pattern(r)), F.lit(r)) for r in ranks]
    return headers.select("paper_folder", F.explode(F.array_compact(F.array(*has))).alias("rank")).distinct()


def feature_facts(features: DataFrame, lineage: DataFrame) -> DataFrame:
    """Per paper: features per domain, features with own taxonomy, corrections, distinct names, dominant evidence and row rank."""
    base = features.groupBy("paper_folder").agg(
        F.count(F.lit(1)).alias("n_feature_rows"), F.count_if(F.col("evidence") != "paper-level fallback").alias("n_with_taxonomy"),
        *[F.count_if(F.col("domain") == d).alias(f"n_features_{d.lower()}") for d in V.DOMAIN_LABELS])
    names = lineage.groupBy("paper_folder", "true_rank", "name").agg(F.count_if(F.col("true_rank") != F.col("column_rank")).alias("_moved"))
    distinct = names.groupBy("paper_folder").agg(
        F.sum("_moved").alias("n_names_reranked"), *[F.count_if(F.col("true_rank") == r).alias(f"n_distinct_{p}") for r, p in
                                                     (("phylum", "phyla"), ("genus", "genera"), ("species", "species"))])
    evidence = dominant(features, ["paper_folder"], "evidence", ["row_idx"]).select("paper_folder", F.col("evidence").alias("domain_evidence"))
    rank = dominant(features, ["paper_folder"], "row_rank", ["row_idx"]).select("paper_folder", F.col("row_rank").alias("dominant_row_rank"))
    return base.join(distinct, "paper_folder", "left").join(evidence, "paper_folder", "left").join(rank, "paper_folder", "left")


def taxon_catalogue(df: DataFrame, taxon: Sequence[str], paper: str, name: str = "n_papers") -> DataFrame:
    """Number of papers that contain each taxon."""
    return df.select(*taxon, paper).distinct().groupBy(*taxon).agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------------------------
# summary tables
# ---------------------------------------------------------------------------
def metrics(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """One aggregate pass stacked to (metric, value)."""
    row = df.agg(*[a.cast("double").alias(f"m{i}") for i, a in enumerate(aggs.values())])
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"m{i}").alias("value")) for i, k in enumerate(aggs)])
    return row.select(F.inline(pairs))


def completeness(df: DataFrame, fields: dict[str, str], total: str = "n_samples") -> DataFrame:
    """Per field: papers with any value and samples with a value, each with its share. ``fields``: label -> count column."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(c).cast("bigint").alias("n")) for k, c in fields.items()])
    long = df.select(F.col(total).alias("_t"), F.inline(pairs))
    out = long.groupBy("field").agg(
        F.count_if(F.col("n") > 0).alias("n_papers_with_any"), share(F.count_if(F.col("n") > 0), F.count(F.lit(1))).alias("share_of_papers"),
        F.sum("n").alias("n_samples_with_value"), share(F.sum("n"), F.sum("_t")).alias("share_of_samples"))
    return out


def row_rank_table(overview: DataFrame, features: DataFrame) -> DataFrame:
    """Features and papers per row rank, coarse to fine; papers without a rank column count their features under the paper's rank.

    overview: paper_folder, paper_rank, n_features, dominant_row_rank; features: paper_folder, row_rank.
    """
    own = features.where("row_rank IS NOT NULL").groupBy(F.col("row_rank").alias("rank")).agg(F.count(F.lit(1)).alias("n_features"))
    fallback = overview.where("dominant_row_rank IS NULL").groupBy(F.col("paper_rank").alias("rank")).agg(F.sum("n_features").alias("n_features"))
    papers = overview.groupBy(F.coalesce("dominant_row_rank", "paper_rank").alias("rank")).agg(F.count(F.lit(1)).alias("n_papers_dominant"))
    counts = own.unionByName(fallback).groupBy("rank").agg(F.sum("n_features").alias("n_features"))
    spot = F.array_position(F.array(*[F.lit(r) for r in V.ROW_RANK_ORDER]), F.col("rank"))
    table = counts.join(papers, "rank", "full_outer").na.fill(0).withColumn("position", spot)
    return with_share(with_share(table, "n_features", "share_of_features"), "n_papers_dominant", "share_of_papers")


def lineage_depth(lineage: DataFrame, columns: DataFrame, n_papers: Column, n_features: Column) -> DataFrame:
    """Per rank: papers that have the column, features that carry a value."""
    features = lineage.groupBy(F.col("true_rank").alias("rank")).agg(F.count(F.lit(1)).alias("n_features_with_value"))
    papers = columns.groupBy("rank").agg(F.count(F.lit(1)).alias("n_papers_with_column"))
    table = papers.join(features, "rank", "full_outer").na.fill(0)
    return table.withColumns({"share_of_papers": share(F.col("n_papers_with_column"), n_papers), "share_of_features": share(F.col("n_features_with_value"), n_features)})


def deepest_rank(lineage: DataFrame, ranks: Sequence[str] = V.LINEAGE_RANKS) -> DataFrame:
    """Deepest rank any feature of the paper carries."""
    spot = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col("true_rank"))
    return lineage.groupBy("paper_folder").agg(F.max_by("true_rank", spot).alias("deepest_lineage_rank"))


def disease_catalogue(samples: DataFrame, disease: str = "disease", raw: str = "disease_raw", paper: str = "paper_folder") -> DataFrame:
    """Samples, papers, category and merged spellings per disease. Spellings are made distinct before they are joined."""
    named = samples.where(F.col(disease).isNotNull()).groupBy(disease, paper, F.col(raw).alias("_raw")).agg(F.count(F.lit(1)).alias("_n"))
    papers = named.groupBy(disease, paper).agg(F.sum("_n").alias("_n")).groupBy(disease).agg(F.sum("_n").alias("n_samples"), F.count(F.lit(1)).alias("n_papers"))
    spellings = named.select(disease, "_raw").distinct().groupBy(disease).agg(
        F.array_join(F.array_sort(F.collect_list("_raw")), " | ").alias("raw_variants_merged"))
    out = papers.join(spellings, disease, "left").withColumn("category", bucket(F.col(disease), V.DISEASE_CATEGORIES, "Other / unspecified"))
    return with_share(out, "n_samples", "share_of_disease_samples")


def unmapped(df: DataFrame, fields: dict[str, str], k: int = 400) -> DataFrame:
    """Most common raw values per field, so that the rules can be extended from data. ``fields``: label -> column."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), nonblank(F.col(c).cast("string")).alias("raw_value")) for n, c in fields.items()])
    counted = df.select(F.inline(pairs)).where("raw_value IS NOT NULL").groupBy("field", "raw_value").agg(F.count(F.lit(1)).alias("n_samples"))
    return top_k(counted, ["field"], k, [F.col("n_samples").desc(), F.col("raw_value").asc()])


# ---------------------------------------------------------------------------
# filtering tree
# ---------------------------------------------------------------------------
def filter_tree(rows: DataFrame, steps: Sequence[tuple[str, str, Column]], measures: Sequence[str]) -> DataFrame:
    """Sequential filter tree in one pass: each step removes the rows that match and are still there.

    steps: (id, label, predicate). Every node carries rows and measure totals; kept + removed = parent by construction,
    and ``balance`` repeats the check on the totals.
    """
    level = case_when([(F.coalesce(p, F.lit(False)), F.lit(i)) for i, (_, _, p) in enumerate(steps)], F.lit(len(steps)))
    totals = rows.withColumn("_level", level).groupBy("_level").agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    nodes = [F.struct(F.lit("all").alias("node_id"), F.lit("").alias("parent_id"), F.lit("root").alias("kind"), F.lit("All").alias("label"), F.lit(-1).alias("lo"), F.lit(1 << 20).alias("hi"))]
    parent = "all"
    for i, (key, label, _) in enumerate(steps):
        nodes.append(F.struct(F.lit(f"drop_{key}").alias("node_id"), F.lit(parent).alias("parent_id"), F.lit("drop").alias("kind"), F.lit(label).alias("label"), F.lit(i).alias("lo"), F.lit(i).alias("hi")))
        nodes.append(F.struct(F.lit(f"after_{key}").alias("node_id"), F.lit(parent).alias("parent_id"), F.lit("keep").alias("kind"), F.lit(f"After: {label}").alias("label"), F.lit(i + 1).alias("lo"), F.lit(1 << 20).alias("hi")))
        parent = f"after_{key}"
    # one small row per level, spread to the nodes it belongs to
    spread = totals.select("*", F.explode(F.array(*nodes)).alias("d")).where("_level BETWEEN d.lo AND d.hi OR d.lo = -1")
    return spread.groupBy("d.node_id", "d.parent_id", "d.kind", "d.label").agg(F.sum("n").alias("n"), *[F.sum(m).alias(m) for m in measures])


def paper_overview(papers: DataFrame) -> DataFrame:
    """Columns every statistic needs, read from the integrated-status table."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    described = F.concat_ws(" ", text("feature_level"), text("main_matrix_unit"))
    hint = bucket(F.concat_ws(" ", text("title"), text("reason"), text("feature_level")), V.HOSTS, "", "")
    n_samples, n_features = lenient_int(F.col("n_samples").cast("string")), lenient_int(F.col("n_features").cast("string"))
    unit = unit_bucket(F.col("main_matrix_unit"))
    return papers.select(
        F.trim("paper_folder").alias("paper_folder"), "doi", "title", "status", n_samples.alias("n_samples"), n_features.alias("n_features"),
        (n_samples * n_features).alias("n_cells"), bucket(F.col("feature_level"), V.ROW_RANKS, "Mixed / other").alias("paper_rank"),
        paper_domain(described).alias("paper_domain"), hint.alias("host_hint"), bucket(F.col("feature_level"), V.ASSAYS).alias("paper_assay"),
        unit.alias("abundance_unit"), F.startswith(unit, F.lit("Relative")).alias("is_relative"), F.startswith(unit, F.lit("Read count")).alias("is_count"),
        "main_matrix_unit", (F.lower(F.coalesce(F.col("has_disease_info").cast("string"), F.lit(""))) == "true").alias("has_disease_info"),
        nonblank(F.col("raw_data_accessions")).isNotNull().alias("has_raw_accession"),
        lenient_int(F.col("n_samples_label_issue").cast("string")).alias("n_samples_label_issue"),
        lenient_int(F.col("n_cells_ambiguous_missing").cast("string")).alias("n_cells_ambiguous_missing"))


