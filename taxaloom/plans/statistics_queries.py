"""The statistics tables of a database of papers, made of the given tables, against the same rules stated in SQL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from . import jobs
from .catalog import Tables, pick, query


# Suppliers stand for papers, line items for their samples, parts for their features.
PAPERS = {
    "paper_folder": "concat('P', s_suppkey)", "doi": "CAST(NULL AS STRING)", "title": pick("s_suppkey", ["Gut of mice", "A cohort", "Cores of rice fields", "Patients with asthma", "Broiler caecum"]),
    "status": pick("s_suppkey", ["integrated", "", "partial"]), "reason": "''", "n_samples": "CAST(s_suppkey % 90 + 1 AS STRING)", "n_features": "CAST(s_suppkey % 40 + 2 AS STRING)",
    "feature_level": pick("s_suppkey", ["ASV table 16S", "vOTU counts, viral genome", "species (metaphlan, shotgun)", "genus level, non-viral bacteria", "MAG", "OTU", "taxa of fungi, bacteria and virus", ""]),
    "main_matrix_unit": pick("s_suppkey", ["relative abundance", "raw read count", "not rarefied counts", "rarefied counts", "RPKM", "unnormalised reads", None]),
    "has_disease_info": pick("s_suppkey", ["True", "no"]), "raw_data_accessions": pick("s_suppkey", ["PRJNA1", " ", None]),
    "n_samples_label_issue": "CAST(NULL AS STRING)", "n_cells_ambiguous_missing": "''",
}
SAMPLES = {
    "Sample_Type": pick("l_partkey", ["stool", "Saliva swab", "soil core", "mouse colon", "lake sediment", "", "rhizosphere of rice", "biofilter", "Human milk", "xyz", None]),
    "host": pick("l_linenumber", ["Homo sapiens", "", "Mus musculus", None, "wheat", "a rock"]),
    "disease_status": pick("l_orderkey", ["healthy", "case", "Control", "not reported", "", "Crohn syndrome", "n/a", "odd"]),
    "disease": pick("l_orderkey + l_linenumber", ["CRC", "crc", "ibd", "", "asthma", " Colorectal cancer", "pd", None]),
    "group": pick("l_partkey", ["A", "", "B"]), "subject_id": "CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE concat('S', l_orderkey % 50) END",
    "timepoint": pick("l_linenumber", ["d0", "", "d1"]), "sex": pick("l_orderkey", ["f", ""]), "age": pick("l_partkey", ["31", "", None, "adult"]),
    "method": pick("l_partkey", ["16S rRNA", "shotgun metagenomics", "", "qPCR", None]),
}
FEATURES = {
    "Kingdom": pick("p_partkey", ["Bacteria", "k__Bacteria(99)", "Viruses", "Fungi", "Archaea", "unclassified", "", "non-viral Bacteria", "Bacteria or fungi"]),
    "phylum": pick("p_partkey", ["p__Firmicutes", "Uroviricota", "", "unknown", "Proteobacteria"]),
    "genus": pick("p_partkey", ["Lactobacillus", "Siphoviridae", "g__Bacteroides", "", "Tequatrovirus", "na", "Peduoviridae"]),
    "taxonomic_rank": pick("p_partkey", ["ASV", "species", "", "vOTU", "nothing"]),
}
_PARTS_PAPER, _FEW = "concat('P', p_partkey % 97 + 1)", "(p_partkey % 97 + 1) % 5 = 0"
_SAMPLE_ROW = "l_orderkey * 10 + l_linenumber"
QUEUES = [("manual_review", "s_suppkey % 10 IN (1, 2)"), ("missing_sample_data", "s_suppkey % 10 IN (2, 3)")]
RESCUED = "s_suppkey % 20 = 3"


def _inputs(t: Tables) -> tuple[DataFrame, ...]:
    row = lambda cells: F.create_map(*[x for k, e in cells.items() for x in (F.lit(k), F.expr(e))])
    papers = t.supplier.select(*[F.expr(e).alias(c) for c, e in PAPERS.items()])
    queues = [t.supplier.where(cond).select(F.expr(PAPERS["paper_folder"]).alias("paper_folder"), F.lit(name).alias("queue")) for name, cond in QUEUES]
    rescued = t.supplier.where(RESCUED).select(F.expr(PAPERS["paper_folder"]).alias("paper_folder"))
    samples = t.lineitem.select(F.concat(F.lit("P"), "l_suppkey").alias("paper_folder"), F.expr(_SAMPLE_ROW).alias("row_idx"), row(SAMPLES).alias("row"))
    few = F.create_map(F.lit("feature_id"), F.col("p_name"), F.lit("genus"), F.expr(FEATURES["genus"]))
    whole = F.map_concat(F.create_map(F.lit("feature_id"), F.col("p_name")), row(FEATURES))
    features = t.part.select(F.expr(_PARTS_PAPER).alias("paper_folder"), F.col("p_partkey").alias("row_idx"), F.when(F.expr(_FEW), few).otherwise(whole).alias("row"))
    return papers, queues[0].unionByName(queues[1]), rescued, samples, features


# ---------------------------------------------------------------------------
# rules in SQL
# ---------------------------------------------------------------------------
def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pattern(p: str) -> str:
    return _quoted(re.sub(r"\(\?!.*?\)", "", p))  # no look-ahead in the other engine; the data holds no such case


def _blank(x: str) -> str:
    return rf"({x} IS NULL OR NOT regexp_matches({x}, '\S'))"


def _filled(x: str) -> str:
    return f"CASE WHEN NOT {_blank(x)} THEN trim({x}) END"


def _bucket(x: str, rules: Sequence[tuple[str, str]], default: str = "Other / unclear", blank: str = "Not recorded") -> str:
    cases = " ".join(f"WHEN regexp_matches(lower({x}), {_pattern(p)}) THEN {_quoted(label)}" for label, p in rules)
    return f"CASE WHEN {_blank(x)} THEN {_quoted(blank)} {cases} ELSE {_quoted(default)} END"


def _status(x: str) -> str:
    cases = " ".join(f"WHEN regexp_matches(lower(trim({x})), {_pattern(p)}){f' AND regexp_matches(lower(trim({x})), {_pattern(also)})' if also else ''} THEN {_quoted(label)}" for label, p, also in V.DISEASE_STATUS)
    return f"CASE WHEN {_blank(x)} THEN 'Not recorded' {cases} ELSE 'Other label' END"


def _host(host: str, kind: str, hint: str) -> str:
    named = f"nullif({_bucket(kind, V.HOSTS, '', '')}, '')"
    outside = f"nullif({_bucket(kind, V.ENVIRONMENTS, '', '')}, '')"
    return f"CASE WHEN NOT {_blank(host)} THEN {_bucket(host, V.HOSTS)} ELSE coalesce({named}, {outside}, nullif({hint}, ''), 'Not recorded') END"


def _cleaned(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(trim({x}), '^[a-z]?_{{1,2}}', ''), '^D_\d+__', ''), '\(\d+(\.\d+)?\)\s*$', ''))"


def _one_domain(x: str) -> str:
    """The only domain a cell states, negated ones taken out."""
    low = f"lower({_cleaned(x)})"
    stripped = f"regexp_replace({low}, {_pattern(V.CELL_NEGATED_DOMAIN)}, ' ', 'g')"
    unknown = ", ".join(map(_quoted, ["", *V.UNKNOWN_DOMAIN_WORDS]))
    hits = [f"regexp_matches({stripped}, {_pattern(p)})" for _, p in V.FEATURE_DOMAINS]
    cases = " ".join(f"WHEN {h} THEN {_quoted(d)}" for h, (d, _) in zip(hits, V.FEATURE_DOMAINS))
    return f"CASE WHEN {low} IN ({unknown}) OR {' + '.join(f'{h}::int' for h in hits)} <> 1 THEN NULL {cases} END"


def _paper_domain(x: str) -> str:
    low = f"regexp_replace(lower({x}), {_pattern(V.PAPER_NEGATED_DOMAIN)}, ' ', 'g')"
    kinds: dict[str, list[str]] = {}
    for stem, kind in V.DOMAIN_NOUN_KINDS:
        kinds.setdefault(kind, []).append(stem)
    named = " + ".join(f"coalesce(regexp_matches({low}, {_pattern('|'.join(s))}), false)::int" for s in kinds.values())
    return f"CASE WHEN {named} >= 3 THEN 'Unclassified' ELSE {_bucket(low, V.PAPER_DOMAINS, 'Unclassified')} END"


def _unit(x: str) -> str:
    term, joiner = V.NORMALISATION_TERM, r"(\s*[/,]\s*|\s+(or|and|nor)\s+)"
    low = f"regexp_replace(lower({x}), {_quoted(rf'({term})\s*(status|state)\b[^;.)]*?\b(not|un)\w*')}, ' ', 'g')"
    return _bucket(f"regexp_replace({low}, {_quoted(rf'\b(not|non|un)[-\s]*({term})({joiner}({term}))*')}, ' ', 'g')", V.UNITS)


def _disease(x: str) -> str:
    known = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in V.DISEASE_SYNONYMS.items())
    codes = ", ".join(map(_quoted, V.UNDEFINED_ABBREVIATIONS))
    return f"CASE lower(trim({x})) {known} ELSE CASE WHEN lower(trim({x})) IN ({codes}) THEN trim({x}) ELSE upper(left(trim({x}), 1)) || substr(trim({x}), 2) END END"


def _true_rank(x: str, column: str) -> str:
    return "CASE " + " ".join(f"WHEN ends_with(lower(trim({x})), '{s}') THEN '{r}'" for s, r in V.VIRAL_SUFFIX_RANKS) + f" ELSE {column} END"


_DOMAINS = [f"n_features_{d.lower()}" for d in V.DOMAIN_LABELS]
_NAMED = {"phylum": "phyla", "genus": "genera", "species": "species"}
_FIELDS = {"disease label": "n_disease_labelled", "experimental_group": "n_group_labelled", "timepoint": "n_timepoint", "sex": "n_sex", "age": "n_age"}
_PAPER_NUMBERS = ["n_samples", "n_features", "n_cells", "n_meta_rows", *_FIELDS.values(), "n_subject", "n_subjects_distinct", "is_longitudinal", "n_feature_rows", "n_with_taxonomy", *_DOMAINS,
                  "n_names_reranked", *[f"n_distinct_{p}" for p in _NAMED.values()], "can_rollup_to_genus", "can_rollup_to_phylum", "has_disease_info", "has_raw_accession", "is_relative", "is_count"]
_PAPER_TEXTS = ["assay", "matrix_row_rank", "dominant_sample_type", "dominant_host", "abundance_unit", "host_hint", "paper_domain", "domain_evidence", "deepest_lineage_rank"]
#: table -> (columns of the label, measures, texts)
SHAPES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "01_papers_included": (["paper_folder"], _PAPER_NUMBERS, _PAPER_TEXTS), "02_summary_headline": (["metric"], ["value"], []), "03_feature_domain": (["domain"], ["n_features", "share"], []),
    "05_sample_type": (["sample_type_class"], ["n_samples", "share"], []), "06_disease_status": (["disease_class"], ["n_samples", "share"], []), "07_host": (["host_class"], ["n_samples", "share"], []),
    "08_assay": (["assay"], ["n_papers", "share"], []), "09_abundance_unit": (["abundance_unit"], ["n_papers", "share"], []), "10_paper_status": (["status"], ["n_papers", "share"], []),
    "11_metadata_completeness": (["field"], ["n_papers_with_any", "share_of_papers", "n_samples_with_value", "share_of_samples"], []),
    "12_excluded_papers": (["queue", "paper_folder"], ["n_samples", "n_features", *_DOMAINS[:5]], []), "13_taxon_catalog_phylum": (["taxon"], ["n_papers_containing_it"], []),
    "14_taxon_catalog_genus": (["taxon"], ["n_papers_containing_it"], []), "15_taxon_catalog_species": (["taxon"], ["n_papers_containing_it"], []),
    "16_matrix_row_rank": (["rank"], ["n_features", "n_papers_dominant", "share_of_features", "share_of_papers", "position"], []),
    "17_lineage_depth": (["rank"], ["n_papers_with_column", "n_features_with_value", "share_of_papers", "share_of_features"], []),
    "18_disease_catalog": (["disease"], ["n_samples", "n_papers", "share_of_disease_samples"], ["raw_variants_merged", "category"]), "19_disease_category": (["category"], ["n_samples_in_category", "share"], []),
    "20_rank_corrections": (["correction"], ["n_names"], []), "99_unmapped_values": (["field", "raw_value"], ["n_samples"], []),
}


def _stack(name: str, df: DataFrame) -> DataFrame:
    labels, numbers, texts = SHAPES[name]
    fact = lambda c, value, text: F.struct(F.lit(c).alias("measure"), value.alias("value"), text.alias("text"))
    facts = [fact(c, F.round(F.col(c).cast("double"), 6), F.lit(None).cast("string")) for c in numbers] + [fact(c, F.lit(None).cast("double"), F.col(c)) for c in texts]
    label: Column = F.concat_ws("|", *labels)
    return df.select(F.lit(name).alias("tbl"), label.alias("label"), F.inline(F.array(*facts)))


def _stack_sql(name: str, source: str) -> str:
    labels, numbers, texts = SHAPES[name]
    label = " || '|' || ".join(f"{c}::varchar" for c in labels)
    rows = [f"SELECT {_quoted(name)} AS tbl, {label} AS label, '{c}' AS measure, round({c}::double, 6) AS value, NULL::varchar AS text FROM {source}" for c in numbers]
    rows += [f"SELECT {_quoted(name)}, {label}, '{c}', NULL, {c} FROM {source}" for c in texts]
    return " UNION ALL ".join(rows)


def _counter_sql(source: str, key: str, measure: str, name: str = "n_samples") -> str:
    return f"(SELECT {key}, {measure} AS {name}, {measure} / sum({measure}) OVER () AS share FROM {source} GROUP BY {key})"


def _dominant_sql(source: str, column: str, name: str) -> str:
    """Most common value of a paper, ties to the first row."""
    return f"""(SELECT paper_folder, arg_max({column}, (n, -first)) AS {name} FROM (
      SELECT paper_folder, {column}, count(*) AS n, min(row_idx) AS first FROM {source} WHERE {column} IS NOT NULL GROUP BY ALL) GROUP BY 1)"""


def _select(cells: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{c.lower()}"' for c, e in cells.items())


_RANKED = {"kingdom": "kingdom", "phylum": "phylum", "genus": "genus"}
_HEADLINE = {
    "papers in cohort": "count(*)", "total samples": "sum(n_samples)", "total features (sum over papers)": "sum(n_features)", "total matrix cells": "sum(n_cells)",
    "distinct subjects (sum over papers)": "sum(n_subjects_distinct)", "largest study (samples)": "max(n_samples)", "largest study (features)": "max(n_features)",
    "papers flagged has_disease_info": "count(*) FILTER (has_disease_info)", "papers with longitudinal subjects": "count(*) FILTER (is_longitudinal)",
    "papers with relative-abundance matrix": "count(*) FILTER (is_relative)", "papers with count matrix": "count(*) FILTER (is_count)",
    "papers with a raw-read accession": "count(*) FILTER (has_raw_accession)", "samples carrying a real disease label": "sum(n_disease_labelled)",
    "samples carrying an experimental_group": "sum(n_group_labelled)",
    **{f"{n} features": f"sum({c})" for n, c in zip(["bacterial", "archaeal", "viral", "fungal", "other eukaryotic", "unclassified"], _DOMAINS)},
    "features with per-feature taxonomy": "sum(n_with_taxonomy)", "features whose domain is a paper-level assertion": "sum(n_features - n_with_taxonomy)",
    "papers whose matrix can roll up to genus": "count(*) FILTER (can_rollup_to_genus)", "papers whose matrix can roll up to phylum": "count(*) FILTER (can_rollup_to_phylum)",
    "median samples per paper": "floor(median(n_samples))", "median features per paper": "floor(median(n_features))",
}


def _sql() -> str:
    order = "[" + ", ".join(map(_quoted, V.ROW_RANK_ORDER)) + "]"
    sources = {
        "01_papers_included": "overview", "02_summary_headline": "headline",
        "03_feature_domain": _counter_sql("(" + " UNION ALL ".join(f"SELECT '{d}' AS domain, {c} AS n FROM overview" for d, c in zip(V.DOMAIN_LABELS, _DOMAINS)) + ")", "domain", "sum(n)", "n_features"),
        "05_sample_type": _counter_sql("samples", "sample_type_class", "count(*)"), "06_disease_status": _counter_sql("samples", "disease_class", "count(*)"),
        "07_host": _counter_sql("samples", "host_class", "count(*)"), "08_assay": _counter_sql("overview", "assay", "count(*)", "n_papers"),
        "09_abundance_unit": _counter_sql("overview", "abundance_unit", "count(*)", "n_papers"),
        "10_paper_status": _counter_sql(f"(SELECT coalesce({_filled('status')}, 'unknown') AS status FROM overview)", "status", "count(*)", "n_papers"),
        "11_metadata_completeness": "(" + " UNION ALL ".join(
            f"SELECT '{f}' AS field, count(*) FILTER ({c} > 0) AS n_papers_with_any, count(*) FILTER ({c} > 0) / count(*) AS share_of_papers, sum({c}) AS n_samples_with_value, "
            f"sum({c}) / sum(n_samples) AS share_of_samples FROM overview" for f, c in _FIELDS.items()) + ")",
        "12_excluded_papers": "excluded",
        **{f"{13 + i}_taxon_catalog_{r}": f"(SELECT name AS taxon, count(DISTINCT paper_folder) AS n_papers_containing_it FROM lineage WHERE true_rank = '{r}' GROUP BY 1)" for i, r in enumerate(_NAMED)},
        "16_matrix_row_rank": "row_ranks", "17_lineage_depth": "depths", "18_disease_catalog": "diseases", "19_disease_category": _counter_sql("diseases", "category", "sum(n_samples)", "n_samples_in_category"),
        "20_rank_corrections": "(SELECT column_rank || '->' || true_rank AS correction, count(*) AS n_names FROM lineage WHERE true_rank <> column_rank GROUP BY 1)",
        "99_unmapped_values": "(FROM (SELECT 'sample_type' AS field, sample_type AS raw_value, count(*) AS n_samples FROM samples GROUP BY ALL UNION ALL SELECT 'host', host, count(*) FROM samples GROUP BY ALL) WHERE raw_value IS NOT NULL)",
    }
    described = "concat_ws(' ', coalesce(feature_level, ''), coalesce(main_matrix_unit, ''))"
    said = ", ".join(f"CASE WHEN coalesce(n_feature_rows, 0) > 0 THEN {c} WHEN paper_domain = '{d}' THEN n_features ELSE 0 END AS {c}" for d, c in zip(V.DOMAIN_LABELS, _DOMAINS))
    lineage = " UNION ALL ".join(f"SELECT paper_folder, row_idx, '{r}' AS column_rank, {_cleaned(c)} AS name FROM own_features WHERE {c} IS NOT NULL" for r, c in _RANKED.items())
    unknown = ", ".join(map(_quoted, ["", *V.UNKNOWN_TAXON_WORDS]))
    deepest = "[" + ", ".join(map(_quoted, V.LINEAGE_RANKS)) + "]"
    filled = "count(*) FILTER ({} IS NOT NULL)"
    return rf"""
WITH papers AS (SELECT {_select(PAPERS)} FROM supplier),
everyone AS (
  SELECT paper_folder, status, CAST(n_samples AS BIGINT) AS n_samples, CAST(n_features AS BIGINT) AS n_features, CAST(n_samples AS BIGINT) * CAST(n_features AS BIGINT) AS n_cells,
         {_bucket('feature_level', V.ROW_RANKS, 'Mixed / other')} AS paper_rank, {_paper_domain(described)} AS paper_domain,
         {_bucket("concat_ws(' ', title, reason, feature_level)", V.HOSTS, '', '')} AS host_hint, {_bucket('feature_level', V.ASSAYS)} AS paper_assay, {_unit('main_matrix_unit')} AS abundance_unit,
         lower(has_disease_info) = 'true' AS has_disease_info, NOT {_blank('raw_data_accessions')} AS has_raw_accession FROM papers),
queues AS ({' UNION ALL '.join(f"SELECT {PAPERS['paper_folder']} AS paper_folder, '{q}' AS queue FROM supplier WHERE {c}" for q, c in QUEUES)}),
rescued AS (SELECT {PAPERS['paper_folder']} AS paper_folder FROM supplier WHERE {RESCUED}),
dropped AS (SELECT * FROM queues WHERE paper_folder NOT IN (FROM rescued)),
kept AS (SELECT * FROM everyone WHERE paper_folder NOT IN (SELECT paper_folder FROM dropped)),
given_samples AS (SELECT concat('P', l_suppkey) AS paper_folder, {_SAMPLE_ROW} AS row_idx, {_select(SAMPLES)} FROM lineitem),
named AS (
  SELECT s.paper_folder, row_idx, host_hint, {', '.join(f'{_filled(f"s.{c}")} AS {c}' for c in ('sample_type', 'host', 'disease_status', 'disease', '"group"', 'subject_id', 'timepoint', 'sex', 'age', 'method'))}
  FROM given_samples s JOIN kept USING (paper_folder)),
samples AS (
  SELECT * EXCLUDE (disease), disease AS disease_raw, {_bucket('sample_type', V.SAMPLE_TYPES, 'Other / unspecified')} AS sample_type_class, {_host('host', 'sample_type', 'host_hint')} AS host_class,
         {_status('disease_status')} AS disease_class, {_bucket("concat_ws(' ', method, sample_type)", V.ASSAYS)} AS assay, {_disease('disease')} AS disease,
         disease_status IS NOT NULL AND NOT regexp_matches(lower(disease_status), {_pattern(V.UNLABELLED_STATUS)}) AS is_labelled FROM named),
subjects AS (SELECT paper_folder, count(*) AS n_subjects_distinct, bool_or(n > 1) AS is_longitudinal FROM (SELECT paper_folder, subject_id, count(*) AS n FROM samples WHERE subject_id IS NOT NULL GROUP BY ALL) GROUP BY 1),
per_sample AS (
  SELECT paper_folder, count(*) AS n_meta_rows, count(*) FILTER (is_labelled) AS n_disease_labelled, {filled.format('"group"')} AS n_group_labelled, {filled.format('subject_id')} AS n_subject,
         {filled.format('timepoint')} AS n_timepoint, {filled.format('sex')} AS n_sex, {filled.format('age')} AS n_age FROM samples GROUP BY 1),
given_features AS (SELECT {_PARTS_PAPER} AS paper_folder, p_partkey AS row_idx, {', '.join(f"CASE WHEN {_FEW} AND '{c}' <> 'genus' THEN NULL ELSE {e} END AS {c.lower()}" for c, e in FEATURES.items())}, NOT ({_FEW}) AS whole FROM part),
features AS (
  SELECT f.*, coalesce({_one_domain('kingdom')}, paper_domain, 'Unclassified') AS domain, CASE WHEN {_one_domain('kingdom')} IS NOT NULL THEN 'kingdom column' ELSE 'paper-level fallback' END AS evidence,
         CASE WHEN whole THEN {_bucket('taxonomic_rank', V.ROW_RANKS, 'Other / mixed', 'Other / mixed')} END AS row_rank FROM given_features f LEFT JOIN everyone USING (paper_folder)),
own_features AS (SELECT f.* FROM features f SEMI JOIN kept USING (paper_folder)),
cleaned AS (SELECT *, {_true_rank('name', 'column_rank')} AS true_rank FROM ({lineage}) WHERE lower(name) NOT IN ({unknown})),
lineage AS (SELECT * FROM cleaned),
columns AS (SELECT DISTINCT paper_folder, rank FROM (SELECT paper_folder, unnest(CASE WHEN whole THEN ['kingdom', 'phylum', 'genus'] ELSE ['genus'] END) AS rank FROM own_features)),
has AS (SELECT paper_folder, bool_or(rank = 'genus') AS can_rollup_to_genus, bool_or(rank = 'phylum') AS can_rollup_to_phylum FROM columns GROUP BY 1),
distinct_names AS (SELECT paper_folder, true_rank, name, count(*) FILTER (true_rank <> column_rank) AS moved FROM lineage GROUP BY ALL),
counted_names AS (SELECT paper_folder, sum(moved) AS n_names_reranked, {', '.join(f"count(*) FILTER (true_rank = '{r}') AS n_distinct_{p}" for r, p in _NAMED.items())} FROM distinct_names GROUP BY 1),
per_feature AS (
  SELECT paper_folder, count(*) AS n_feature_rows, count(*) FILTER (evidence <> 'paper-level fallback') AS n_with_taxonomy,
         {', '.join(f"count(*) FILTER (domain = '{d}') AS {c}" for d, c in zip(V.DOMAIN_LABELS, _DOMAINS))} FROM own_features GROUP BY 1),
deepest AS (SELECT paper_folder, arg_max(true_rank, list_position({deepest}, true_rank)) AS deepest_lineage_rank FROM lineage GROUP BY 1),
overview AS (
  SELECT paper_folder, status, n_samples, n_features, n_cells, coalesce(n_meta_rows, 0) AS n_meta_rows, {', '.join(f'coalesce({c}, 0) AS {c}' for c in [*_FIELDS.values(), 'n_subject', 'n_subjects_distinct', 'n_feature_rows', 'n_with_taxonomy', 'n_names_reranked'])},
         {', '.join(f'coalesce(n_distinct_{p}, 0) AS n_distinct_{p}' for p in _NAMED.values())}, coalesce(is_longitudinal, false) AS is_longitudinal, {said},
         coalesce(can_rollup_to_genus, false) AS can_rollup_to_genus, coalesce(can_rollup_to_phylum, false) AS can_rollup_to_phylum, has_disease_info, has_raw_accession,
         starts_with(abundance_unit, 'Relative') AS is_relative, starts_with(abundance_unit, 'Read count') AS is_count, coalesce(top_assay, paper_assay) AS assay, top_rank, paper_rank,
         coalesce(top_rank, paper_rank) AS matrix_row_rank, coalesce(top_type, 'Not recorded') AS dominant_sample_type, coalesce(top_host, 'Not recorded') AS dominant_host, abundance_unit, host_hint, paper_domain,
         coalesce(top_evidence, 'paper-level fallback') AS domain_evidence, deepest_lineage_rank
  FROM kept LEFT JOIN per_sample USING (paper_folder) LEFT JOIN subjects USING (paper_folder) LEFT JOIN per_feature USING (paper_folder) LEFT JOIN counted_names USING (paper_folder) LEFT JOIN has USING (paper_folder)
    LEFT JOIN {_dominant_sql('samples', 'assay', 'top_assay')} a USING (paper_folder) LEFT JOIN {_dominant_sql('samples', 'sample_type_class', 'top_type')} b USING (paper_folder)
    LEFT JOIN {_dominant_sql('samples', 'host_class', 'top_host')} c USING (paper_folder) LEFT JOIN {_dominant_sql('own_features', 'evidence', 'top_evidence')} d USING (paper_folder)
    LEFT JOIN {_dominant_sql('own_features', 'row_rank', 'top_rank')} e USING (paper_folder) LEFT JOIN deepest USING (paper_folder)),
excluded AS (
  SELECT queue, d.paper_folder, n_samples, n_features, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _DOMAINS[:5])} FROM dropped d LEFT JOIN everyone USING (paper_folder)
  LEFT JOIN (SELECT paper_folder, {', '.join(f"count(*) FILTER (domain = '{d}') AS {c}" for d, c in zip(V.DOMAIN_LABELS[:5], _DOMAINS))} FROM features GROUP BY 1) USING (paper_folder)),
once AS (SELECT DISTINCT ON (paper_folder) * FROM excluded),
spelled AS (SELECT DISTINCT disease, disease_raw FROM samples WHERE disease IS NOT NULL),
diseases AS (
  SELECT disease, n_samples, n_papers, n_samples / sum(n_samples) OVER () AS share_of_disease_samples, raw_variants_merged, {_bucket('disease', V.DISEASE_CATEGORIES, 'Other / unspecified')} AS category
  FROM (SELECT disease, count(*) AS n_samples, count(DISTINCT paper_folder) AS n_papers FROM samples WHERE disease IS NOT NULL GROUP BY 1)
  JOIN (SELECT disease, string_agg(disease_raw, ' | ' ORDER BY disease_raw) AS raw_variants_merged FROM spelled GROUP BY 1) USING (disease)),
rank_counts AS (
  SELECT rank, sum(n) AS n_features FROM (SELECT row_rank AS rank, count(*) AS n FROM own_features WHERE row_rank IS NOT NULL GROUP BY 1
    UNION ALL SELECT paper_rank, sum(n_features) FROM overview WHERE top_rank IS NULL GROUP BY 1) GROUP BY 1),
row_ranks AS (
  SELECT rank, n_features, n_papers_dominant, n_features / sum(n_features) OVER () AS share_of_features, n_papers_dominant / sum(n_papers_dominant) OVER () AS share_of_papers, coalesce(list_position({order}, rank), 0) AS position
  FROM (SELECT rank, coalesce(n_features, 0) AS n_features, coalesce(n_papers_dominant, 0) AS n_papers_dominant
        FROM rank_counts FULL JOIN (SELECT matrix_row_rank AS rank, count(*) AS n_papers_dominant FROM overview GROUP BY 1) USING (rank))),
depths AS (
  SELECT rank, coalesce(p, 0) AS n_papers_with_column, coalesce(f, 0) AS n_features_with_value, coalesce(p, 0) / (SELECT count(*) FROM overview) AS share_of_papers,
         coalesce(f, 0) / (SELECT sum(CASE WHEN n_feature_rows > 0 THEN n_feature_rows ELSE n_features END) FROM overview) AS share_of_features
  FROM (SELECT rank, count(*) AS p FROM columns GROUP BY 1) FULL JOIN (SELECT true_rank AS rank, count(*) AS f FROM lineage GROUP BY 1) USING (rank)),
headline AS (
  {' UNION ALL '.join(f"SELECT '{m}' AS metric, ({e})::double AS value FROM overview" for m, e in _HEADLINE.items())}
  UNION ALL SELECT 'papers excluded (triage queues)', count(*) FROM once UNION ALL SELECT 'features in excluded papers (NOT in any table below)', coalesce(sum(n_features), 0) FROM once
  UNION ALL SELECT 'viral features in excluded papers', coalesce(sum(n_features_viruses), 0) FROM once
  {' '.join(f"UNION ALL SELECT 'distinct {r} names across DB', count(DISTINCT name) FROM lineage WHERE true_rank = '{r}'" for r in _NAMED)}
  UNION ALL SELECT 'distinct named diseases', count(*) FROM diseases UNION ALL SELECT 'samples with a named disease', sum(n_samples) FROM diseases
  UNION ALL SELECT 'papers kept despite triage (used downstream)', count(DISTINCT paper_folder) FROM rescued)
{' UNION ALL '.join(_stack_sql(name, source) for name, source in sources.items())}
"""


@query(_sql())
def database_statistics(t: Tables):
    """All statistics tables, one row per table, label and measure."""
    tables = jobs.database_stats(*_inputs(t))
    stacked = [_stack(name, tables[name]) for name in SHAPES]
    out = stacked[0]
    for more in stacked[1:]:
        out = out.unionByName(more)
    return out
