"""End products, one function per job, composed from the operators.

Every function takes DataFrames of the declared columns and returns DataFrames; nothing here touches the network or
runs per paper: a job handles all papers, tables or reads it is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import all_matches
from ..functions.taxa import branch_of, branch_of_marker, disease_bucket, scope_match
from ..functions.text import nonblank, paper_key
from ..operators import candidates, cells, coverage, ledger, links, metadata, ordering, reads, reshape, stats, viral

SETS = ["matched_queries", "microbe_scope_hint", "assay_group_hint"]
SCALARS = ["pmid", "pmcid", "doi", "title", "abstract", "journal", "publication_year", "publication_type", "is_open_access", "cited_by_count", "discovery_source"]
IDENTIFIERS = ["paper_id", "doi", "pmid", "pmcid"]


def papers_master(hits: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Search hits (with ``arrival``, ``id``) merged to papers; allow-list rows (with ``file_order``) join when none of their identifiers is known."""
    keyed = hits.withColumn("paper_id", paper_key(*[F.col(c) for c in ("doi", "pmid", "pmcid", "id")]))
    merged = candidates.merge_hits(keyed, "paper_id", SETS, SCALARS, "arrival")
    merged = merged.withColumns({c: F.array_join(c, ";") for c in SETS})
    if allow is None:
        return merged
    filled = allow.where(F.coalesce(*[nonblank(F.col(c)) for c in IDENTIFIERS]).isNotNull())
    new = candidates.add_allowlist(merged, filled, IDENTIFIERS, "file_order")
    new = new.withColumn("paper_id", paper_key(*[F.col(c) for c in IDENTIFIERS]))
    return merged.unionByName(new.select(*[c for c in merged.columns if c in new.columns]), allowMissingColumns=True)


def screened(papers: DataFrame) -> DataFrame:
    """Papers with their screening verdict and the diseases they name."""
    text = F.concat_ws(" ", "title", "abstract")
    return candidates.screen(papers, text, F.col("publication_type"))


def link_table(papers: DataFrame, documents: DataFrame, denied: Sequence[str] = V.TOOL_REPOSITORIES) -> tuple[DataFrame, DataFrame]:
    """(papers with availability text, links). papers: paper_id, pmid, pmcid, doi, title, abstract; documents: paper_id, xml."""
    text = links.fulltext_sections(documents, "xml")
    docs = text.join(papers.select("paper_id", "title", "abstract", "pmcid", "pmid", "doi"), "paper_id", "right")

    def link(repository: Column, accession: Column, url: Column, kind: str) -> Column:
        return F.struct(repository.alias("repository"), accession.alias("accession"), url.alias("raw_url"), F.lit(kind).alias("link_type"))

    blank_text = F.lit("")
    of_accession = lambda a: link(a["repository"], a["accession"], blank_text, "accession")
    named = F.filter(links.accession_links(F.concat_ws(" ", "title", "abstract", "full_text")), lambda a: ~links.is_denied(a["repository"], a["accession"], denied))
    numbers = links.accession_links(links.unescape(F.col("xml")), [("bioproject", V.PROJECT_NUMBER)])
    supplement = F.filter(F.array(F.col("pmcid")), lambda c: nonblank(c).isNotNull())
    kinds = [F.transform(named, of_accession), F.transform(numbers, of_accession),
             F.transform(supplement, lambda c: link(F.lit("europepmc_supp"), c, blank_text, "accession")),
             F.transform(links.url_links(F.col("xml")), lambda u: link(F.lit("url"), blank_text, u, "data_url"))]
    # one array of links a document: its mark-up is parsed and mined once, whatever reads the two results
    every = F.array_distinct(F.flatten(F.filter(F.array(*kinds), lambda k: k.isNotNull())))
    mined = ordering.stored(docs.select("paper_id", "pmid", "pmcid", "doi", "availability_text", F.col("xml").isNotNull().alias("fulltext_available"), every.alias("_links")))
    out = mined.select("paper_id", "fulltext_available", "availability_text", F.size("_links").cast("bigint").alias("n_data_links"))
    source = F.when(F.col("fulltext_available"), "fulltext").otherwise("abstract")
    return out, mined.select("paper_id", F.inline("_links"), "pmid", "pmcid", "doi", source.alias("source"))


def datasets(found: DataFrame, listings: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(datasets, members) out of links; ``listings`` (dataset_id, listed_files, resolve_status) is joined when given."""
    grouped, members = links.group_links(found, ("paper_id", "pmid", "doi"))
    if listings is not None:
        grouped = grouped.join(listings, "dataset_id", "left")
    return grouped, members


def candidate_papers(papers: DataFrame, grouped: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(datasets with status, papers with status). papers: paper_id, assay_prediction, screen_reason, availability_text."""
    judged = candidates.dataset_status(grouped)
    pairs = members.where("kind = 'paper_id'").select(F.col("member").alias("paper_id"), "dataset_id")
    status = candidates.paper_status(papers, pairs, judged)
    return judged, status.withColumn("source_pipeline_hint", all_matches(F.col("availability_text"), V.TEXT_PROFILERS))


def verify_tables(found: DataFrame, meta: DataFrame, axis_aware: bool = True) -> dict[str, DataFrame]:
    """Verdicts, long rows, single cells and duplicates of all tables. found: cells (stored); meta: table_id, paper_id, dataset_id, source_file."""
    facts = cells.column_facts(found)
    lookups = ordering.stored(cells.lookup_tables(found, facts))
    ids = cells.id_to_lineage(found, lookups)
    # a lookup serves every table of its own deposit
    deposit = meta.select("table_id", "dataset_id")
    known = ids.join(deposit, "table_id").select("dataset_id", "taxon_id").distinct().join(deposit, "dataset_id").select("table_id", "taxon_id")
    verdicts = ordering.stored(cells.sniff(found, known, axis_aware, facts))
    long = reshape.to_long(found, verdicts, meta, facts)
    long = long.withColumn("pipeline_source", all_matches(F.concat_ws(" ", "source_file", "table_id"), V.FILE_PROFILERS))
    named = ["dataset_id", "source_file", "sample_id"]
    verified = meta.join(verdicts, "table_id").groupBy("dataset_id").agg(F.bool_or(F.col("is_abundance") & ~F.col("needs_review")).alias("content_verified"))
    return {
        "verdicts": verdicts, "review": verdicts.where("needs_review"), "long": long, "verified": verified,
        "matrix_cells": reshape.single_cells(long, named, "taxon", "value"), "duplicates": reshape.duplicate_report(long, named, "taxon", "value"),
        "lookups": ids.join(meta, "table_id"),
    }


def extract_tables(long: DataFrame, files: DataFrame, lookup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Matrices, taxonomy, manifest and samples of all accepted tables, with the size of each matrix. files: source_file, sha256."""
    matrix, duplicates, sizes = reshape.table_matrices(long)
    manifest = reshape.table_manifest(long, duplicates, files)
    return {"matrix_cells": matrix, "duplicates": duplicates, "sizes": sizes, "taxonomy": reshape.taxonomy_table(long, lookup),
            "manifest": manifest, "samples": reshape.samples_from_tables(long, manifest.select("table_id", "source_file"))}


def database_stats(papers: DataFrame, queues: DataFrame, rescued: DataFrame, sample_rows: DataFrame, feature_rows: DataFrame) -> dict[str, DataFrame]:
    """Statistics tables of the database, keyed by their number.

    papers: integrated status; queues: paper_folder, queue; rescued: paper_folder; rows: paper_folder, row_idx, row(map).
    """
    everyone = stats.paper_overview(papers)
    kept = ordering.stored(stats.cohort(everyone, queues, rescued))
    samples = ordering.stored(stats.classify_samples(sample_rows.join(kept.select("paper_folder"), "paper_folder", "left_semi"), kept))
    # excluded papers are classified too: what the exclusion costs is one of the tables
    all_features = ordering.stored(stats.feature_domain_rows(feature_rows, everyone).drop("row"))
    features = all_features.join(kept.select("paper_folder"), "paper_folder", "left_semi")
    own_rows = feature_rows.join(kept.select("paper_folder"), "paper_folder", "left_semi")
    lineage, columns = ordering.stored(stats.lineage_fill(own_rows)), stats.lineage_columns(own_rows)
    per_sample, per_feature = stats.sample_facts(samples), stats.feature_facts(features, lineage)

    def top(df: DataFrame, column: str, name: str) -> DataFrame:
        return ordering.dominant(df, ["paper_folder"], column, ["row_idx"]).select("paper_folder", F.col(column).alias(name))

    has = columns.groupBy("paper_folder").agg(*[F.bool_or(F.col("rank") == r).alias(f"can_rollup_to_{r}") for r in ("genus", "phylum")])
    overview = kept.join(per_sample, "paper_folder", "left").join(per_feature, "paper_folder", "left").join(has, "paper_folder", "left")
    for column, name in (("assay", "dominant_assay"), ("sample_type_class", "dominant_sample_type"), ("host_class", "dominant_host")):
        overview = overview.join(top(samples, column, name), "paper_folder", "left")
    overview = overview.join(stats.deepest_rank(lineage), "paper_folder", "left")
    domains = [f"n_features_{d.lower()}" for d in V.DOMAIN_LABELS]
    counts = ["n_meta_rows", "n_disease_labelled", "n_group_labelled", "n_subject", "n_timepoint", "n_sex", "n_age", "n_subjects_distinct", "n_feature_rows", "n_with_taxonomy", "n_names_reranked", "n_distinct_phyla", "n_distinct_genera", "n_distinct_species"]
    overview = overview.na.fill(0, counts).na.fill(False, ["is_longitudinal", "can_rollup_to_genus", "can_rollup_to_phylum"])
    # without a feature table all features count under what the paper says of itself
    for label, column in zip(V.DOMAIN_LABELS, domains):
        said = F.when(F.col("paper_domain") == label, F.col("n_features")).otherwise(0)
        overview = overview.withColumn(column, F.when(F.col("n_feature_rows") > 0, F.col(column)).otherwise(said))
    overview = overview.withColumns({
        "assay": F.coalesce("dominant_assay", "paper_assay"), "matrix_row_rank": F.coalesce("dominant_row_rank", "paper_rank"), "domain_evidence": F.coalesce("domain_evidence", F.lit("paper-level fallback")),
        "dominant_sample_type": F.coalesce("dominant_sample_type", F.lit("Not recorded")), "dominant_host": F.coalesce("dominant_host", F.lit("Not recorded"))}).drop("dominant_assay")
    overview = ordering.stored(overview)

    per_domain = all_features.groupBy("paper_folder", "domain").agg(F.count(F.lit(1)).alias("n"))
    excluded = ordering.stored(stats.excluded_cost(everyone, queues, rescued, per_domain))
    distinct_cost = excluded.dropDuplicates(["paper_folder"])
    catalogue = stats.taxon_catalogue(lineage.withColumnRenamed("name", "taxon"), ["true_rank", "taxon"], "paper_folder", "n_papers_containing_it")
    diseases = ordering.stored(stats.disease_catalogue(samples))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    yes = lambda c: F.count_if(F.col(c))
    head = stats.metrics(overview, {
        "papers in cohort": F.count(F.lit(1)), "total samples": total("n_samples"), "total features (sum over papers)": total("n_features"), "total matrix cells": total("n_cells"),
        "distinct subjects (sum over papers)": total("n_subjects_distinct"), "largest study (samples)": F.max("n_samples"), "largest study (features)": F.max("n_features"),
        "papers flagged has_disease_info": yes("has_disease_info"), "papers with longitudinal subjects": yes("is_longitudinal"), "papers with relative-abundance matrix": yes("is_relative"),
        "papers with count matrix": yes("is_count"), "papers with a raw-read accession": yes("has_raw_accession"), "samples carrying a real disease label": total("n_disease_labelled"),
        "samples carrying an experimental_group": total("n_group_labelled"), "bacterial features": total(domains[0]), "archaeal features": total(domains[1]), "viral features": total(domains[2]),
        "fungal features": total(domains[3]), "other eukaryotic features": total(domains[4]), "unclassified features": total(domains[5]), "features with per-feature taxonomy": total("n_with_taxonomy"),
        "features whose domain is a paper-level assertion": total(F.col("n_features") - F.col("n_with_taxonomy")), "papers whose matrix can roll up to genus": yes("can_rollup_to_genus"),
        "papers whose matrix can roll up to phylum": yes("can_rollup_to_phylum"),
    })
    more = stats.metrics(distinct_cost, {
        "papers excluded (triage queues)": F.count(F.lit(1)), "features in excluded papers (NOT in any table below)": total("n_features"), "viral features in excluded papers": total("n_features_viruses")})
    names = stats.metrics(catalogue, {f"distinct {r} names across DB": F.count_if(F.col("true_rank") == r) for r in ("phylum", "genus", "species")})
    named = stats.metrics(diseases, {"distinct named diseases": F.count(F.lit(1)), "samples with a named disease": total("n_samples")})
    resc = stats.metrics(rescued.select("paper_folder").distinct(), {"papers kept despite triage (used downstream)": F.count(F.lit(1))})
    meds = stats.median_of(overview, [], "n_samples").select(F.lit("median samples per paper").alias("metric"), F.floor("median").cast("double").alias("value")).unionByName(
        stats.median_of(overview, [], "n_features").select(F.lit("median features per paper").alias("metric"), F.floor("median").cast("double").alias("value")))
    headline = head.unionByName(more).unionByName(names).unionByName(named).unionByName(resc).unionByName(meds)

    fixes = lineage.where("true_rank <> column_rank").groupBy(F.concat_ws("->", "column_rank", "true_rank").alias("correction")).agg(F.count(F.lit(1)).alias("n_names"))
    fields = {"disease label": "n_disease_labelled", "experimental_group": "n_group_labelled", "timepoint": "n_timepoint", "sex": "n_sex", "age": "n_age"}
    long_domains = overview.select(F.inline(F.array(*[F.struct(F.lit(d).alias("domain"), F.col(c).alias("n")) for d, c in zip(V.DOMAIN_LABELS, domains)])))
    by_rank = lambda r: catalogue.where(F.col("true_rank") == r).drop("true_rank")
    n_rows = stats.whole(overview, total(F.when(F.col("n_feature_rows") > 0, F.col("n_feature_rows")).otherwise(F.col("n_features"))))
    # the counters of a fact table are grouping sets of one aggregate
    of_samples = ordering.stored(stats.counter_tables(samples, ["sample_type_class", "disease_class", "host_class"]))
    of_papers = ordering.stored(stats.counter_tables(overview.withColumn("status", F.coalesce(nonblank(F.col("status")), F.lit("unknown"))), ["assay", "abundance_unit", "status"]))
    counter = lambda df, c, n: df.where(F.col("column") == c).select(F.col("label").alias(c), F.col("n").alias(n), "share")
    return {
        "01_papers_included": overview, "02_summary_headline": headline, "03_feature_domain": stats.counter_table(long_domains, "domain", "n_features", "n"),
        "05_sample_type": counter(of_samples, "sample_type_class", "n_samples"), "06_disease_status": counter(of_samples, "disease_class", "n_samples"),
        "07_host": counter(of_samples, "host_class", "n_samples"), "08_assay": counter(of_papers, "assay", "n_papers"),
        "09_abundance_unit": counter(of_papers, "abundance_unit", "n_papers"), "10_paper_status": counter(of_papers, "status", "n_papers"),
        "11_metadata_completeness": stats.completeness(overview, fields), "12_excluded_papers": excluded,
        "13_taxon_catalog_phylum": by_rank("phylum"), "14_taxon_catalog_genus": by_rank("genus"), "15_taxon_catalog_species": by_rank("species"),
        "16_matrix_row_rank": stats.row_rank_table(overview, features), "17_lineage_depth": stats.lineage_depth(lineage, columns, stats.whole(overview, F.count(F.lit(1))), n_rows),
        "18_disease_catalog": diseases, "19_disease_category": stats.counter_table(diseases, "category", "n_samples_in_category", "n_samples"),
        "20_rank_corrections": fixes, "99_unmapped_values": stats.unmapped(samples, {"sample_type": "sample_type", "host": "host"}),
    }


def viral_dataset(papers: DataFrame, sample_rows: DataFrame, feature_rows: DataFrame, matrix: DataFrame, recovery: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Viral features, samples and nonzero observations of every paper that has any; inclusion does not depend on sample labels.

    matrix: paper_folder, sample_id, feature_id, value (text, one row per cell).
    """
    overview = stats.paper_overview(papers)
    classified = ordering.stored(stats.feature_domain_rows(feature_rows, overview))
    fid = F.coalesce(F.try_element_at("row", F.lit("feature_id")), F.map_values("row")[0])
    mine = classified.where("domain = 'Viruses'").withColumn("feature_id", fid)
    ranks = stats.lineage_fill(mine.select("paper_folder", "row_idx", "row"), V.VIRAL_RANKS).groupBy("paper_folder", "row_idx").agg(
        *[F.max(F.when(F.col("true_rank") == r, F.col("name"))).alias(r) for r in V.VIRAL_RANKS])
    totals = classified.groupBy("paper_folder").agg(F.count(F.lit(1)).alias("n_features"), F.count_if(F.col("domain") == "Viruses").alias("n_viral_features"))
    top = ordering.dominant(classified, ["paper_folder"], "row_rank", ["row_idx"]).select("paper_folder", "row_rank")
    kinds = totals.where("n_viral_features > 0").join(top, "paper_folder", "left").join(overview.select("paper_folder", "paper_rank", "main_matrix_unit"), "paper_folder", "left")
    kinds = viral.matrix_type(kinds.withColumn("row_rank", F.coalesce("row_rank", "paper_rank")), recovery)
    features = mine.select("paper_folder", "row_idx", "feature_id").join(ranks, ["paper_folder", "row_idx"], "left").join(kinds.select("paper_folder", "matrix_type", "viral_recovery_method"), "paper_folder")
    kept = sample_rows.join(kinds.select("paper_folder"), "paper_folder", "left_semi")
    named = viral.resolve_labels(viral.usability(kept)).withColumn("disease_status", viral.cell(F.col("row"), "disease_status"))
    samples = named.withColumn("disease_class", disease_bucket(F.col("disease_status")))
    observed = reshape.domain_blocks(matrix, features).join(kinds.select("paper_folder", F.col("main_matrix_unit").alias("abundance_unit")), "paper_folder")
    viral_cells = matrix.join(features.select("paper_folder", "feature_id").distinct(), ["paper_folder", "feature_id"], "left_semi")
    blocks = viral.blocks(viral_cells, ["paper_folder"], "sample_id", "feature_id", "value").join(viral.completeness_text(samples), "paper_folder", "left").join(kinds, "paper_folder", "left")
    coordinates, rows, columns = viral.block_diagonal(viral_cells, "paper_folder", "sample_id", "feature_id", "value")
    return {"features": features, "samples": samples, "abundance_long": observed, "blocks": blocks, "matrix": coordinates, "matrix_rows": rows, "matrix_columns": columns, **viral.viral_summaries(features, samples)}


def filtering_tree(overview: DataFrame, integrated: DataFrame, queues: Sequence[tuple[str, str, DataFrame]], status_files: dict[str, DataFrame]) -> DataFrame:
    """Nodes of the filtering tree with papers, samples and features; raises where sets overlap or do not add up.

    overview and integrated: paper_folder (unique), integrated also n_samples, n_features; queues: (key, label, paper_folder rows) in order.
    """
    key = "paper_folder"
    overview, integrated = ledger.require_unique(overview, [key]), ledger.require_unique(integrated, [key])
    taken = ledger.require_disjoint({name: q for name, _, q in queues}, key) if queues else integrated.limit(0).select(key, F.lit("").alias("category"))
    # a queue lists integrated papers only: a key of the right side alone raises when the tree is read
    both = integrated.select(key, "n_samples", "n_features", F.lit(True).alias("_in")).join(taken, key, "full_outer")
    stray = F.raise_error(F.concat(F.lit("a queue lists a paper that is not integrated: "), F.col(key).cast("string"))).cast("boolean")
    tagged = both.where(F.when(F.col("_in").isNull(), stray).otherwise(F.lit(True)))
    tree = stats.filter_tree(tagged, [(k, label, F.col("category") == k) for k, label, _ in queues], ["n_samples", "n_features"])
    rename = lambda c: F.when(F.col(c) == "all", "integrated").otherwise(F.col(c))
    inside = tree.withColumns({"node_id": rename("node_id"), "parent_id": F.when(F.col("node_id") == "all", "all").otherwise(rename("parent_id"))})
    inside = inside.withColumn("kind", F.when(F.col("kind") == "root", "keep").otherwise(F.col("kind"))).withColumnRenamed("n", "papers")
    rest = overview.select(key).join(integrated.select(key), key, "left_anti")
    filed = ledger.require_disjoint(status_files, key) if status_files else rest.limit(0).withColumn("category", F.lit(""))
    leaves = rest.join(filed, key, "left").groupBy(F.coalesce("category", F.lit("Not yet categorised")).alias("label")).agg(F.count(F.lit(1)).alias("papers"))
    na = F.lit(None).cast("bigint")
    details = leaves.select(F.concat(F.lit("status_"), F.lower(F.replace("label", F.lit(" "), F.lit("_")))).alias("node_id"), F.lit("not_integrated").alias("parent_id"), F.lit("detail").alias("kind"),
                            "label", "papers", na.alias("n_samples"), na.alias("n_features"))
    drop = rest.agg(F.count(F.lit(1)).alias("papers")).select(F.lit("not_integrated").alias("node_id"), F.lit("all").alias("parent_id"), F.lit("drop").alias("kind"), F.lit("No sample-level abundance matrix").alias("label"), "papers", na.alias("n_samples"), na.alias("n_features"))
    root = overview.agg(F.count(F.lit(1)).alias("papers")).select(F.lit("all").alias("node_id"), F.lit("").alias("parent_id"), F.lit("root").alias("kind"), F.lit("All candidate papers").alias("label"), "papers", na.alias("n_samples"), na.alias("n_features"))
    columns = ["node_id", "parent_id", "kind", "label", "papers", "n_samples", "n_features"]
    return root.unionByName(inside.select(*columns)).unionByName(drop).unionByName(details)


def sample_mapping(files: DataFrame, runs: DataFrame, claims: DataFrame, defaults: DataFrame, facts: DataFrame) -> dict[str, DataFrame]:
    """FASTQ files to samples, claims to columns, and the gate per paper.

    files: paper, sample, run, file, on_disk; runs: run, experiment, library_layout, library_strategy, library_source, library_selection,
    sample_alias, isolation_source; claims / defaults as in ``merge_defaults`` plus is_technical_control on claims; facts: paper, n_missing_facts, facts_confidence.
    """
    branch = branch_of(F.col("library_strategy"), F.col("library_source"), F.col("library_selection"))["branch"]
    typed = files.join(runs.withColumn("branch", branch), "run", "left")
    own = ["paper", "sample"]      # papers may share a sample: each counts its own files and claims
    samples = metadata.run_to_sample(typed, own)
    resolved = metadata.merge_defaults(claims, defaults)
    problems = metadata.validate_claims(resolved, files.select("paper", "sample"))
    columns = reshape.claims_to_columns(resolved)
    control = claims.groupBy("paper", "sample").agg(F.bool_or("is_technical_control").alias("is_technical_control"))
    alias = metadata.first_run_metadata(files, runs, ["sample_alias"], own)
    joined = files.select("paper", "sample").distinct().join(samples, own).join(columns, own, "left").join(control, own, "left").join(alias.select(*own, "sample_alias"), own, "left")
    joined = joined.withColumns({"is_technical_control": F.coalesce("is_technical_control", F.lit(False)),
                                 "own_id": F.when(~F.col("paper_sample_id").isin(V.UNRESOLVED, V.NOT_REPORTED), F.col("paper_sample_id")), "accession": F.col("sample")})
    handled = metadata.with_handle(joined, ["paper"], "sample", ["own_id", "sample_alias", "accession"])
    blockers = handled.groupBy("paper").agg(F.count_if(F.col("blockers") != "").alias("n_blockers"))
    gate = metadata.metadata_gate(metadata.gate_facts(handled).join(blockers, "paper").join(facts, "paper", "left").na.fill({"n_missing_facts": len(V.KEY_FACTS)}))
    inventory = metadata.sample_inventory(files, runs.select("run", "library_layout", "isolation_source"), own)
    return {"inventory": inventory, "samples": handled, "problems": problems, "gate": gate}


def amplicon_facts(found: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """Primers, insert lengths, caps and merge budget per paper. found: reads plus paper; pairs: paper, seq1, seq2_rc (trimmed), read_through."""
    calls = reads.primer_call(found)
    papers = found.select("run", "paper").distinct()
    agreed = reads.region_agreement(calls.join(papers, "run"), ["paper"])
    lengths = found.withColumn("n", F.length("seq")).groupBy("paper").agg(
        F.coalesce(F.max(F.when(F.col("mate") != "R2", F.col("n"))), F.lit(0)).alias("read_len_f"), F.coalesce(F.max(F.when(F.col("mate") == "R2", F.col("n"))), F.lit(0)).alias("read_len_r"))
    base = F.regexp_replace("region", "^primer_like_", "")
    size = lambda i: F.coalesce(F.try_element_at(F.create_map(*[x for k, p in V.PRIMERS.items() for x in (F.lit(k), F.lit(len(p[i])))]), base), F.lit(0))
    trims = agreed.select("paper", "region", size(0).alias("trim_f"), size(1).alias("trim_r"))
    inserts = reads.insert_summary(ordering.stored(reads.insert_lengths(pairs).select("paper", "insert_length")), ["paper"])
    share = pairs.groupBy("paper").agg(F.avg(F.col("read_through").cast("double")).alias("share_through"))
    facts = trims.join(lengths, "paper").join(inserts.select("paper", F.round("p99").cast("int").alias("insert_p99")), "paper", "left").join(share, "paper", "left").na.fill(0)
    return {"calls": calls, "agreement": agreed, "inserts": inserts, "budget": reads.merge_budget(reads.trunc_caps(facts))}


def analysis_plan(samples: DataFrame, calls: DataFrame, facts: DataFrame, catalogue_scope: str = "") -> dict[str, DataFrame]:
    """What can run per paper and what blocks it.

    samples: paper, sample, sample_alias, is_technical_control, metadata_evidence, branch, host_text; calls: paper, region, primers_present;
    facts: paper, amplicon_status, declared_region, primers_in_reads, identity_status, usable_for, exclude_alias_prefixes.
    """
    with_facts = samples.join(facts.select("paper", "exclude_alias_prefixes"), "paper", "left")
    kept, dropped = metadata.split_controls(with_facts, "sample_alias", F.col("is_technical_control"), F.coalesce("exclude_alias_prefixes", F.array().cast("array<string>")), F.col("metadata_evidence"))
    region = calls.groupBy("paper").agg(F.min("region").alias("region"), F.bool_and("primers_present").alias("primers_present"), F.count_distinct("region").alias("n_regions"))
    assays = kept.groupBy("paper", "branch").agg(F.count(F.lit(1)).alias("n_samples"), F.min("host_text").alias("host_text")).join(region, "paper", "left")
    resolved = F.when(F.col("branch") == "amplicon", branch_of_marker(F.col("region"))).otherwise(F.col("branch"))
    assays = assays.withColumn("resolved", resolved).join(facts, "paper", "left")
    amplicon = F.col("branch") == "amplicon"
    columns = {c: F.col(c) for c in ("amplicon_status", "declared_region", "primers_in_reads", "identity_status", "usable_for")}
    out_of_scope = (F.col("branch") == "dna_virome") & (F.lit(catalogue_scope) != "") & (F.coalesce("host_text", F.lit("")) != "") & ~scope_match(F.lit(catalogue_scope), F.col("host_text"))
    blocking = F.array_compact(F.array(
        F.when(amplicon, F.nullif(reads.facts_problems(columns, F.col("region"), F.col("primers_present")), F.lit(""))),
        F.when(amplicon & (F.col("n_regions") > 1), F.lit("the probed runs disagree on the region")),
        F.when(F.col("resolved").isin(V.UNIMPLEMENTED_BRANCHES), F.concat(F.lit("branch '"), "resolved", F.lit("' is not implemented"))),
        F.when(F.col("resolved") == V.UNRESOLVED, F.lit("the assay is unresolved")),
        F.when(out_of_scope, F.lit("the viral catalogue is for another host or site"))))
    status = F.when(F.col("resolved").isin(V.UNIMPLEMENTED_BRANCHES), "unsupported").when(F.size(blocking) > 0, "blocked").otherwise("ready")
    rows = assays.select("paper", "resolved", "n_samples", status.alias("status"), blocking.alias("blocking"))
    # a paper has at most one row per branch of a fixed list
    plan = rows.groupBy("paper").agg(F.collect_list(F.struct(F.col("resolved").alias("branch"), "status")).alias("branches"), F.flatten(F.collect_list("blocking")).alias("blockers"))
    return {"branches": rows, "plan": ledger.deferred_branches(plan), "kept": kept, "dropped": dropped}


def coverage_matrices(aln: DataFrame, lengths: DataFrame, samples: DataFrame, min_identity: float | None = None, breadth: float = V.MIN_BREADTH, depth: float = V.MIN_DEPTH) -> dict[str, DataFrame]:
    """Detected genomes, relative abundance within what is detected, and mapping statistics. samples: sample."""
    kept = coverage.identity_filter(aln, min_identity) if min_identity is not None else aln
    cov = ordering.stored(coverage.interval_coverage(kept, lengths))
    hits = coverage.detect(cov, breadth, depth)
    if hits.isEmpty():
        raise ValueError("no genome passed the detection thresholds in any sample")
    share = coverage.relative_abundance(hits, ["sample"], "mean_depth", on_zero="zero", digits=8)
    features = coverage.samples_detected(hits).join(lengths, "genome")
    mapping = samples.select("sample").distinct().join(coverage.mapping_stats(cov, breadth, depth), "sample", "left").na.fill(0)
    return {"coverage": cov, "detected": hits.withColumn("mean_depth", F.bround("mean_depth", 6)), "relative_abundance": share, "features": features, "mapping_stats": mapping}


def profile_matrices(profile: DataFrame, samples: DataFrame, genomes: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Features and the long profile (sample, genome, taxonomic_abundance, sequence_abundance; a pair without a row is a measured zero).

    With a list of ``genomes`` also the zero-filled wide grids of these.
    """
    first = ordering.first_by(profile.select("genome", "contig_name", "adjusted_ani"), ["genome"], ["contig_name"])
    names = ("taxonomic_abundance", "sequence_abundance")
    long = profile.groupBy("sample", "genome").agg(*[F.sum(c).alias(c) for c in names])
    if genomes is None:
        return {"features": first, "long": long}
    base = samples.select("sample").distinct().join(profile, "sample", "left")
    grids = {c: reshape.zero_filled(base, "sample", "genome", c, list(genomes)) for c in names}
    return {"features": first, "long": long, **grids}


def asv_tables(counts: DataFrame, steps: DataFrame, samples: DataFrame, inserts: DataFrame) -> dict[str, DataFrame]:
    """ASV table after denoising: length window, ids, relative abundance, tracking and the merge verdict.

    counts: paper, sample, sequence, n (n > 0); steps: paper, sample, step, n; samples: paper, sample;
    inserts: paper, insert_p99 (each paper has its own window; a paper without one keeps all lengths).
    """
    size = F.length("sequence")
    p99 = F.col("insert_p99")
    within = counts.join(inserts.select("paper", "insert_p99"), "paper", "left")
    low, high = F.coalesce(p99 - 60, F.lit(0)), F.coalesce(p99 + 20, F.lit(2**31 - 1))
    lengths = reads.length_window(within, size, low, high, F.col("n"), ["paper", "insert_p99"]).drop("insert_p99")
    kept = within.where(size.between(low, high)).select(*counts.columns)
    # commonest sequence first, as ids are usually read
    totals = kept.groupBy("paper", "sequence").agg(F.sum("n").alias("total")).withColumn("_order", -F.col("total"))
    ids = ordering.ranked(totals, ["paper"], "_order", ["sequence"], name="spot").select("paper", "sequence", F.format_string("ASV%04d", "spot").alias("asv"))
    share = coverage.relative_abundance(kept.join(ids, ["paper", "sequence"]), ["paper", "sample"], "n")
    track = ordering.stored(reads.track_reads(samples, steps, ["paper", "sample"]))
    return {"lengths": lengths, "asvs": ids, "relative_abundance": share, "tracking": track, "verdict": reads.merge_verdict(track, "paper"), "chimeras": reads.chimera_retention(track, "paper")}


def registry(book: DataFrame, plans: DataFrame, papers: DataFrame) -> dict[str, DataFrame]:
    """Class, methods and risks of every paper, with the counts that must balance.

    book: paper, step, status, updated_utc, ordinal (row number in the ledger, so that equal stamps have an order), ...; plans: paper, branch, status; papers: as in ``paper_risks`` without status.
    """
    now = ordering.stored(ledger.registry(book, ["paper", "step"], ["updated_utc", "ordinal"]))
    final = now.groupBy("paper").agg(
        F.max(F.when(F.col("step") == "3", F.col("status"))).alias("status"), F.bool_or((F.col("step") == "3") & (F.col("state") == "done")).alias("completed"),
        F.bool_or(F.col("state") == "failed").alias("failed"), F.bool_or(F.col("state") == "open").alias("in_progress"))
    branches = plans.groupBy("paper").agg(F.bool_and(F.col("status") == "unsupported").alias("only_unsupported"), F.bool_or(F.col("status") == "unsupported").alias("method_missing"))
    level1 = ordering.stored(ledger.classify_level1(final.join(branches, "paper", "left")))
    risks = ledger.paper_risks(papers.join(level1.where("completed").select("paper", "status"), "paper"))
    worst = ordering.worst_of(risks, ["paper"], "risk", V.RISK_ORDER)
    done = level1.where("level1 = 'completed'").select("paper")
    risk = done.join(worst, "paper", "left").na.fill({"primary": "none", "all_labels": "none"})
    methods = ledger.method_rows(plans).join(done, "paper", "left_semi").where("method NOT LIKE 'missing:%'")
    total = lambda df, c: stats.whole(df, c)
    counts = level1.agg(F.count(F.lit(1)).alias("level1_total"), F.count_if(F.col("level1") == "completed").alias("n_completed")).withColumns({
        "papers_in_state": total(now, F.count_distinct("paper")), "risk_sum": total(risk, F.count(F.lit(1))), "method_papers": total(methods, F.count_distinct("paper"))})
    counts = counts.withColumns({"level1_balances": F.col("level1_total") == F.col("papers_in_state"), "risk_balances": F.col("risk_sum") == F.col("n_completed"), "method_balances": F.col("method_papers") == F.col("n_completed")})
    return {"state": now, "level1": level1, "methods": methods, "risks": risk, "counts": counts}

