"""Papers and datasets: merging hits, screening, candidate status, what to do next."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import all_matches, case_when, matches, reasons
from ..functions.text import nonblank, normalize_id
from .components import components
from .ordering import cut_lineage, stored


def merge_hits(df: DataFrame, key: str, sets: Sequence[str], scalars: Sequence[str], order: str) -> DataFrame:
    """One row per key: sets united and sorted, scalars take the first value that is not blank in arrival order.

    The sets hold labels of the query that found the paper, so their size is bounded by the query list.
    """
    aggs = [F.array_sort(F.collect_set(nonblank(F.col(s)))).alias(s) for s in sets]
    for c in scalars:
        value = nonblank(F.col(c).cast("string"))
        aggs.append(F.min_by(value, F.when(value.isNotNull(), F.col(order))).alias(c))
    return df.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "").groupBy(key).agg(*aggs)


def _identifiers(id_cols: Sequence[str]) -> Column:
    return F.array_distinct(F.array_compact(F.array(*[nonblank(normalize_id(F.col(c).cast("string"))) for c in id_cols])))


#: Rows of a component that one task passes over; it holds their identifiers.
COMPONENT_ROWS = 5_000_000


def add_allowlist(papers: DataFrame, allow: DataFrame, id_cols: Sequence[str], order: str, component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """Rows of the allow-list to add: those none of whose identifiers is known or stands in a row that was added before, in file order.

    Rows that share identifiers, over any number of others, form a component. Components are independent, so each is passed over once in file order,
    many of them in a task; rows that share nothing are added at once. Only a component beyond ``component_rows`` is worked off in rounds instead.
    """
    known = papers.select(F.explode(_identifiers(id_cols)).alias("identifier")).distinct()
    # written before they are filtered, so that the identifiers are made once
    named = stored(allow.select(F.col(order).alias("_o"), _identifiers(id_cols).alias("_ids"))).where(F.size("_ids") > 0)
    edges = named.select("_o", F.explode("_ids").alias("identifier"))
    hit = edges.join(known, "identifier", "left_semi").select("_o").distinct()
    still = stored(named.join(hit, "_o", "left_anti"))
    edges = still.select("_o", F.explode("_ids").alias("identifier"))
    # every row is linked to the first holder of each of its identifiers: no pairs within an identifier
    first = edges.groupBy("identifier").agg(F.min("_o").alias("_first"))
    found, _ = components(edges.join(first, "identifier"), "_o", "_first")
    roots = still.join(found.withColumnRenamed("node", "_o"), "_o", "left")
    sizes = found.groupBy("root").agg(F.count(F.lit(1)).alias("_rows"))
    large = stored(sizes.where(F.col("_rows") > component_rows).select("root"))
    alone = roots.where("root IS NULL").select("_o")
    small = roots.where("root IS NOT NULL").join(large, "root", "left_anti")
    passed = small.repartition("root").sortWithinPartitions("root", "_o").select("root", "_o", "_ids").mapInArrow(_first_holders, still.select("_o").schema)
    taken = alone.unionByName(passed)
    if not large.isEmpty():
        taken = taken.unionByName(_in_rounds(roots.join(large, "root", "left_semi").select("_o", F.explode("_ids").alias("identifier"))))
    return allow.join(taken.withColumnRenamed("_o", order), order, "left_semi")


def _first_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by component and order, none of whose identifiers an added row of the component holds."""
    now, used = None, set()
    for batch in batches:
        keep = []
        for i, (root, ids) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            if root != now:
                now, used = root, set()
            if used.isdisjoint(ids):
                used.update(ids)
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(keep, pa.int64()))], names=["_o"])


def _in_rounds(open_edges: DataFrame) -> DataFrame:
    """The same choice without a pass: a row first in all its identifiers is added, rows that share one with it go, the rest goes round again."""
    taken = open_edges.select("_o").where(F.lit(False))
    open_edges = cut_lineage(open_edges)
    while not open_edges.isEmpty():
        first = open_edges.groupBy("identifier").agg(F.min("_o").alias("_first"))
        judged = open_edges.join(first, "identifier").groupBy("_o").agg(F.bool_and(F.col("_o") == F.col("_first")).alias("_win"))
        winners = judged.where("_win").select("_o")
        used = open_edges.join(winners, "_o", "left_semi").select("identifier").distinct()
        losers = open_edges.join(used, "identifier", "left_semi").select("_o").distinct()
        taken = taken.unionByName(winners)
        open_edges = cut_lineage(open_edges.join(losers, "_o", "left_anti"))
    return taken


def archive_values(df: DataFrame, key: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Distinct filled values per accession, sorted and joined; the columns are controlled vocabularies."""
    return df.groupBy(key).agg(*[F.array_join(F.array_sort(F.collect_set(nonblank(F.col(c)))), sep).alias(c) for c in columns])


def screen(df: DataFrame, text: Column, publication_type: Column, community: str = V.SCREEN_COMMUNITY, assays=V.SCREEN_ASSAYS,
           product: str = V.SCREEN_PRODUCT, data: str = V.SCREEN_DATA, not_primary: str = V.SCREEN_NOT_PRIMARY,
           isolate: str = V.SCREEN_ISOLATE, host_only: str = V.SCREEN_HOST_ONLY, diseases=V.DISEASE_MENTIONS) -> DataFrame:
    """Screening verdict per paper: exclusion beats relevance, relevance needs community words and an assay.

    The patterns run once, in a projection of their own; the verdict columns only combine their answers.
    """
    hits = {
        "_community": matches(text, community, True), "_assay": all_matches(text, assays), "_product": matches(text, product, True),
        "_data": matches(text, data, True), "_review": matches(text, not_primary, True) | matches(publication_type, not_primary, True),
        "_isolate": matches(text, isolate, True), "_host": matches(text, host_only, True),
    }
    if diseases:
        hits["disease"] = all_matches(text, diseases, "unknown")
    community_hit, assay, host = F.col("_community"), F.col("_assay"), F.col("_host") & ~F.col("_community")
    excluded = F.col("_review") | F.col("_isolate") | host
    return df.withColumns(hits).withColumns({
        "screen_status": case_when(
            [(excluded, F.lit("exclude_likely")), (community_hit & (assay != ""), F.lit("likely_relevant")), (community_hit, F.lit("manual_review"))], F.lit("low_priority")),
        "assay_prediction": F.when(assay == "", F.lit("unknown")).otherwise(assay),
        "processed_data_hint": F.col("_product"),
        "data_link_hint": F.col("_data"),
        "screen_evidence": reasons([(community_hit, "community_terms"), (assay != "", F.concat(F.lit("assay:"), assay)), (F.col("_product"), "abundance_terms"), (F.col("_data"), "data_terms")]),
        "screen_reason": reasons([(F.col("_review"), "review_or_non_primary"), (F.col("_isolate"), "isolate_or_single_genome"), (host, "host_only_assay")]),
    }).drop(*[c for c in hits if c.startswith("_")])


def dataset_status(df: DataFrame, files: str = "listed_files", abundance: str = V.ABUNDANCE_FILE, reads: str = V.READ_FILE, table: str = V.TABLE_FILE,
                   sequence: Sequence[str] = V.SEQUENCE_REPOSITORIES, processed: Sequence[str] = V.PROCESSED_REPOSITORIES) -> DataFrame:
    """Status of a dataset from its file names and its repository."""
    has_abundance = matches(F.col(files), abundance, True)
    has_reads = matches(F.col(files), reads, True) | F.col("repository").isin(list(sequence))
    has_table = matches(F.col(files), table, True)
    picks = [
        (has_abundance, "abundance_ready", "processed_abundance_filename"),
        (has_reads, "raw_reads_needs_assay_check", "sequence_repository_or_fastq"),
        (F.coalesce(F.col("resolve_status") == "error", F.lit(False)), "manual_review", "repository_metadata_query_failed"),
        (has_table & F.col("repository").isin(list(processed)), "needs_content_check", "table_file_present_filename_inconclusive"),
    ]
    return df.withColumns({
        "has_abundance_hint": has_abundance, "has_raw_reads_hint": has_reads, "has_table_like_file": has_table,
        "candidate_status": case_when([(c, F.lit(s)) for c, s, _ in picks], F.lit("manual_review")),
        "classification_reason": case_when([(c, F.lit(r)) for c, _, r in picks], F.lit("no_decisive_filename_evidence")),
    })


def category_of(status: Column, table: dict[str, str] = V.DATA_CATEGORIES) -> Column:
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit("unknown"))


def paper_status(papers: DataFrame, links: DataFrame, datasets: DataFrame) -> DataFrame:
    """Roll dataset status up to papers.

    papers: paper_id, assay_prediction, screen_reason; links: paper_id, dataset_id; datasets: from ``dataset_status``.
    """
    facts = links.select("paper_id", "dataset_id").distinct().join(
        datasets.select("dataset_id", "candidate_status", "has_raw_reads_hint"), "dataset_id"
    ).groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("n_linked_datasets"),
        F.bool_or(F.col("candidate_status") == "abundance_ready").alias("_abundance"),
        F.bool_or(F.col("candidate_status") == "needs_content_check").alias("_check"),
        F.bool_or("has_raw_reads_hint").alias("_reads"),
    )
    no = F.lit(False)
    abundance, check, reads = (F.coalesce(F.col(c), no) for c in ("_abundance", "_check", "_reads"))
    assay_ok = matches(F.col("assay_prediction"), V.COMMUNITY_ASSAY, True) & ~matches(F.col("screen_reason"), V.WRONG_ASSAY, True)
    picks = [
        (abundance, "abundance_ready", "repository_file_listing_has_abundance_product"),
        (check, "needs_content_check", "table_file_present_filename_inconclusive"),
        (reads & assay_ok, "raw_reads_ready", "community_assay_and_public_sequence_accession"),
        (reads, "raw_reads_needs_assay_check", "reads_found_but_assay_not_confirmed"),
        (F.col("n_linked_datasets") > 0, "manual_review", "data_link_found_but_type_unresolved"),
    ]
    status = case_when([(c, F.lit(s)) for c, s, _ in picks], F.lit("no_data_link_found"))
    out = papers.join(facts, "paper_id", "left").withColumn("n_linked_datasets", F.coalesce("n_linked_datasets", F.lit(0)))
    return out.withColumns({
        "final_status": status,
        "final_reason": case_when([(c, F.lit(r)) for c, _, r in picks], F.lit("no_accession_or_data_url_extracted")),
        "data_category": category_of(status),
    }).drop("_abundance", "_check", "_reads")


def next_action(papers: DataFrame, links: DataFrame, verified: DataFrame) -> DataFrame:
    """Confirm papers by verified datasets (never downgrade) and say what to do next. verified: dataset_id, content_verified."""
    ok = links.select("paper_id", "dataset_id").distinct().join(verified, "dataset_id").groupBy("paper_id").agg(
        F.bool_or("content_verified").alias("content_verified"))
    out = papers.join(ok, "paper_id", "left").withColumn("content_verified", F.coalesce("content_verified", F.lit(False)))
    action = case_when(
        [(F.col("content_verified"), F.lit("none_have_matrix")),
         (F.col("final_status").isin("raw_reads_ready", "raw_reads_needs_assay_check"), F.lit("run_own_pipeline")),
         (F.col("final_status").isin("needs_content_check", "manual_review"), F.lit("manual_content_review"))],
        F.lit("no_data_found"),
    )
    category = F.when(F.col("content_verified"), F.lit("processed")).otherwise(F.coalesce("data_category", F.lit("unknown")))
    return out.withColumns({"data_category": category, "next_action": action})


def blocked_class(df: DataFrame, retry: str = V.BLOCKED_RETRY, not_data: str = V.BLOCKED_NOT_DATA, manual: str = V.BLOCKED_MANUAL) -> DataFrame:
    """One of five exclusive classes per blocked row, from its reason and its files."""
    picks = [(nonblank(F.col("reason")).isNull(), V.BLOCKED_CLASSES[0]), (matches(F.col("reason"), retry, True), V.BLOCKED_CLASSES[1]),
             (matches(F.col("attempted_files"), not_data, True), V.BLOCKED_CLASSES[2]), (matches(F.col("reason"), manual, True), V.BLOCKED_CLASSES[3])]
    return df.withColumn("blocked_class", case_when([(c, F.lit(v)) for c, v in picks], F.lit(V.BLOCKED_CLASSES[4])))


def outcome(df: DataFrame) -> DataFrame:
    """Outcome of fetching a paper's files from n_issues, n_downloaded, n_files, n_raw_read_files."""
    issues, got = F.col("n_issues") > 0, F.col("n_downloaded") > 0
    raw_only = (F.col("n_files") > 0) & (F.col("n_raw_read_files") == F.col("n_files"))
    return df.withColumn("outcome", case_when(
        [(got & issues, F.lit("downloaded_with_issues")), (got, F.lit("downloaded")), (issues, F.lit("candidate_download_failed")),
         (raw_only, F.lit("raw_reads_only"))], F.lit("no_candidate_files")))


def study_rollup(tables: DataFrame) -> DataFrame:
    """Per study: tables, sample rows summed without removing repeats, domains (three possible values) sorted."""
    return tables.groupBy("study_id").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("n_samples").alias("n_samples_not_deduplicated"),
        F.array_join(F.array_sort(F.collect_set("domain")), ";").alias("domains"))


def explode_blocked(df: DataFrame) -> DataFrame:
    """paper_id, blocked array<struct<dataset_id,file,reason>>, n_tables -> one row each, partly or fully blocked."""
    rows = df.select("paper_id", "n_tables", F.explode_outer("blocked").alias("b")).select("paper_id", "n_tables", "b.*")
    kind = F.when(F.col("n_tables") > 0, F.lit("partially_blocked")).otherwise(F.lit("fully_blocked"))
    return rows.withColumn("block_kind", kind)
