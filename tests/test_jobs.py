"""End products on small fixtures."""

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import ordering
from taxaloom.plans import jobs


def test_papers_master_and_screening(spark):
    columns = "arrival int, id string, pmid string, pmcid string, doi string, title string, abstract string, journal string, publication_year string, publication_type string, is_open_access string, cited_by_count string, discovery_source string, matched_queries string, microbe_scope_hint string, assay_group_hint string"
    hit = lambda n, doi, pmid, title, q: (n, "", pmid, "", doi, title, "", "J", "2024", "", "Y", "1", "search", q, "bacteria", "16S")
    hits = spark.createDataFrame([hit(1, "https://doi.org/10.1/AB", "", "", "q2"), hit(2, "10.1/ab", "7", "gut microbiome 16S", "q1"), hit(3, "", "", "", "q1")], columns)
    allow = spark.createDataFrame([(1, "", "", "", "", "blank"), (2, "", "10.1/AB", "", "", "known"), (3, "x9", "10.9/x", "", "", "virome metagenomic sequencing")],
                                  "file_order int, paper_id string, doi string, pmid string, pmcid string, title string")
    out = {r.paper_id: r for r in jobs.papers_master(hits, allow).collect()}
    assert set(out) == {"10.1/ab", "x9"} and out["10.1/ab"].pmid == "7" and out["10.1/ab"].matched_queries == "q1;q2" and out["10.1/ab"].title == "gut microbiome 16S"
    status = dict(jobs.screened(jobs.papers_master(hits, allow)).select("paper_id", "screen_status").collect())
    assert status == {"10.1/ab": "likely_relevant", "x9": "likely_relevant"}


def test_links_to_candidates(spark):
    papers = spark.createDataFrame([("p1", "1", "PMC1", "10.1/a", "t", "bioproject 123456"), ("p2", "2", "", "10.1/b", "t", "none")], "paper_id string, pmid string, pmcid string, doi string, title string, abstract string")
    docs = spark.createDataFrame([("p1", "<a><sec><title>Data availability</title><p>Reads SRR100001, github.com/benjjneb/dada2 https://figshare.com/articles/x/55555.</p></sec></a>")], "paper_id string, xml string")
    info, found = jobs.link_table(papers, docs)
    got = sorted((r.paper_id, r.repository, r.accession, r.raw_url) for r in found.collect())
    assert got == [("p1", "bioproject", "123456", ""), ("p1", "europepmc_supp", "PMC1", ""), ("p1", "figshare", "55555", ""), ("p1", "sra_run", "SRR100001", ""), ("p1", "url", "", "https://figshare.com/articles/x/55555")]
    counts = {r.paper_id: (r.fulltext_available, r.n_data_links) for r in info.collect()}
    assert counts == {"p1": (True, 5), "p2": (False, 0)}
    grouped, members = jobs.datasets(found, spark.createDataFrame([("figshare:55555", "otu_table.biom", "ok")], "dataset_id string, listed_files string, resolve_status string"))
    base = info.join(papers.select("paper_id"), "paper_id").withColumns({"assay_prediction": F.lit("16S_amplicon"), "screen_reason": F.lit("")})
    judged, status = jobs.candidate_papers(base, grouped, members)
    assert {r.dataset_id: r.candidate_status for r in judged.collect()}["figshare:55555"] == "abundance_ready"
    assert {r.paper_id: (r.final_status, r.data_category) for r in status.collect()} == {"p1": ("abundance_ready", "processed"), "p2": ("no_data_link_found", "unknown")}


def test_mark_up_is_parsed_once(spark, monkeypatch):
    plans = []
    keep = ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    papers = spark.createDataFrame([("p1", "1", "PMC1", "10.1/a", "t", "none")], "paper_id string, pmid string, pmcid string, doi string, title string, abstract string")
    info, found = jobs.link_table(papers, spark.createDataFrame([("p1", "<a><p>SRR100001 https://zenodo.org/records/123</p></a>")], "paper_id string, xml string"))
    assert [p.count("_read_sections") for p in plans] == [plans[0].count("_read_sections")] and plans[0].count("ArrowEvalPython") == 1
    for df in (info, found):
        assert "ArrowEvalPython" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_verify_and_extract_tables(spark):
    def table(tid, header, body):
        return [(tid, i, j, h, row[j]) for i, row in enumerate(body) for j, h in enumerate(header)]

    found = spark.createDataFrame(
        table("otu", ["id", "S1", "S2", "S3", "NTC1"], [[f"A{i}", str(i), "20", "1", None] for i in range(5)] + [["A4", "9", "20", "2", "1"]])
        + table("tax", ["id", "lineage"], [[f"A{i}", f"k__Bacteria; p__Firmicutes; g__G{i}"] for i in range(5)]), "table_id string, row_idx long, col_idx int, col_name string, value string")
    meta = spark.createDataFrame([("otu", "p1", "d1", "otu.csv"), ("tax", "p1", "d1", "tax.csv")], "table_id string, paper_id string, dataset_id string, source_file string")
    out = jobs.verify_tables(ordering.stored(found), meta)
    verdict = {r.table_id: (r.is_abundance, r.id_matched_lineage) for r in out["verdicts"].collect()}
    assert verdict == {"otu": (True, True), "tax": (False, False)}
    assert out["verified"].collect()[0].content_verified
    grid = {(r.sample_id, r.taxon): r.value for r in out["matrix_cells"].collect()}
    assert grid["S1", "A4"] is None and grid["S1", "A0"] == 0.0 and ("NTC1", "A0") not in grid
    assert sorted((r.sample_id, r.taxon, r.raw_value, r.n_of_value) for r in out["duplicates"].collect()) == [
        ("S1", "A4", "4.0", 1), ("S1", "A4", "9.0", 1), ("S2", "A4", "20.0", 2), ("S3", "A4", "1.0", 1), ("S3", "A4", "2.0", 1)]
    files = spark.createDataFrame([("otu.csv", "h1"), ("tax.csv", "h2")], "source_file string, sha256 string")
    lookup = out["lookups"].select("dataset_id", "taxon_id", "lineage", "source_file", F.lit(0).alias("file_order"))
    done = jobs.extract_tables(out["long"], files, lookup)
    manifest = done["manifest"].first()
    assert (manifest.n_samples, manifest.n_taxa, manifest.n_duplicate_cells, manifest.sha256) == (3, 5, 3, "h1")
    sizes = done["sizes"].first()
    assert (sizes.n_samples, sizes.n_taxa, sizes.n_cells) == (3, 5, 15) and done["taxonomy"].first().phylum == "Firmicutes"


@pytest.fixture(scope="module")
def base(spark):
    papers = spark.createDataFrame([
        ("P1", "10/a", "Human gut", "integrated", "3.0", "4", "97% OTU", "read count (not rarefied)", "", "True", "PRJNA1", "0", ""),
        ("P2", "10/b", "soil", "integrated", "2", "2", "vOTU table", "relative abundance", "", "False", "", "", "2"),
        ("P3", "10/c", "x", "integrated", "5", "7", "genus", "percent", "", "", "", "", "")],
        "paper_folder string, doi string, title string, status string, n_samples string, n_features string, feature_level string, main_matrix_unit string, reason string, has_disease_info string, raw_data_accessions string, n_samples_label_issue string, n_cells_ambiguous_missing string")
    samples = [("P1", 0, {"SAMPLE_TYPE": "stool", "disease": "CRC", "disease_status": "patient", "subject_id": "a", "sex": "f"}), ("P1", 1, {"SAMPLE_TYPE": "stool", "disease": "crc", "disease_status": "not reported", "subject_id": "a"}),
               ("P1", 2, {"SAMPLE_TYPE": "saliva", "disease": "", "disease_status": "healthy", "subject_id": "b"}), ("P2", 0, {"sample_type": "garden soil"}), ("P2", 1, {"sample_type": ""}), ("P3", 0, {"host": "mouse"})]
    features = [("P1", 0, {"feature_id": "f0", "kingdom": "k__Bacteria", "phylum": "p__Firmicutes", "genus": "g__A", "taxonomic_rank": "OTU"}), ("P1", 1, {"feature_id": "f1", "kingdom": "", "phylum": "Firmicutes", "genus": "uncultured", "taxonomic_rank": "OTU"}),
                ("P1", 2, {"feature_id": "f2", "kingdom": "Viruses", "phylum": "", "genus": "Myoviridae", "taxonomic_rank": ""}), ("P1", 3, {"feature_id": "f3", "kingdom": "unassigned", "phylum": "", "genus": "", "taxonomic_rank": "OTU"}),
                ("P3", 0, {"feature_id": "q", "kingdom": "Viruses"})]
    schema = "paper_folder string, row_idx long, row map<string,string>"
    frame = lambda data: spark.createDataFrame(data, schema)
    return papers, frame(samples), frame(features)


def test_database_statistics(spark, base):
    papers, samples, features = base
    queues = spark.createDataFrame([("P3", "manual_review"), ("P3", "missing_sample_data"), ("P2", "manual_review")], "paper_folder string, queue string")
    rescued = spark.createDataFrame([("P2",)], "paper_folder string")
    out = jobs.database_stats(papers, queues, rescued, samples, features)
    assert sorted(k[:2] for k in out) == [f"{i:02d}" for i in (1, 2, 3, *range(5, 21))] + ["99"]
    table = lambda k: {tuple(r)[0]: r for r in out[k].collect()}
    p1 = table("01_papers_included")["P1"]
    assert (p1.n_samples, p1.n_cells, p1.is_longitudinal, p1.n_disease_labelled, p1.matrix_row_rank, p1.deepest_lineage_rank, p1.n_names_reranked, p1.can_rollup_to_genus) == (3, 12, True, 2, "OTU", "genus", 1, True)
    head = {r.metric: r.value for r in out["02_summary_headline"].collect()}
    assert len(head) == 35
    assert (head["papers in cohort"], head["papers excluded (triage queues)"], head["viral features in excluded papers"], head["total samples"], head["median samples per paper"]) == (2, 1, 1, 5, 2)
    assert (head["viral features"], head["bacterial features"], head["distinct phylum names across DB"], head["distinct named diseases"]) == (3, 3, 1, 1)
    assert {r.domain: r.n_features for r in out["03_feature_domain"].collect()} == {"Bacteria": 3, "Archaea": 0, "Viruses": 3, "Fungi": 0, "Eukaryota": 0, "Unclassified": 0}
    hosts = {r.host_class: r.n_samples for r in out["07_host"].collect()}
    assert hosts == {"Human": 3, "Environmental / none": 1, "Not recorded": 1}
    assert table("18_disease_catalog")["Colorectal cancer"].raw_variants_merged == "CRC | crc"
    assert out["12_excluded_papers"].count() == 2
    ranks = {r["rank"]: (r.n_features, r.n_papers_dominant) for r in out["16_matrix_row_rank"].collect()}
    assert ranks == {"OTU": (3, 1), "Other / mixed": (1, 0), "vOTU / viral genome": (2, 1)}
    assert {r.correction: r.n_names for r in out["20_rank_corrections"].collect()} == {"genus->family": 1}
    share = {r.field: (r.n_papers_with_any, r.n_samples_with_value) for r in out["11_metadata_completeness"].collect()}
    assert share["disease label"] == (1, 2) and share["sex"] == (1, 1)


def test_viral_dataset(spark, base):
    papers, samples, features = base
    matrix = spark.createDataFrame([("P1", "s1", "f2", "0"), ("P1", "s2", "f2", "3"), ("P1", "s1", "f0", "9"), ("P3", "s", "q", ""), ("P3", "t", "q", "<LOD")], "paper_folder string, sample_id string, feature_id string, value string")
    out = jobs.viral_dataset(papers, samples, features, matrix, {"P3": "VLP-enriched virome"})
    assert sorted(tuple(r)[:4] for r in out["abundance_long"].collect()) == [("P1", "P1::s2", "P1::f2", "3"), ("P3", "P3::t", "P3::q", "<LOD")]
    blocks = {r.paper_folder: (r.n_cells, r.n_nonzero, r.n_zero, r.n_blank, r.matrix_type) for r in out["blocks"].collect()}
    assert blocks == {"P1": (2, 1, 1, 0, "mixed"), "P3": (2, 1, 0, 1, "viral_dedicated")}
    assert {r.deepest_rank: r.n for r in out["viral_rank_depth"].collect()} == {"Family": 1, "Kingdom": 1}


def test_filtering_tree(spark, base):
    papers, _, _ = base
    key = lambda *names: spark.createDataFrame([(n,) for n in names], "paper_folder string")
    integrated = papers.select("paper_folder", F.col("n_samples").cast("double").cast("long").alias("n_samples"), F.col("n_features").cast("long").alias("n_features"))
    overview = key("P1", "P2", "P3", "X", "Y")
    queues = [("manual", "Manual review required", key("P3")), ("sample", "Missing sample information", key("P2"))]
    tree = {r.node_id: (r.parent_id, r.papers, r.n_samples) for r in jobs.filtering_tree(overview, integrated, queues, {"No data": key("X")}).collect()}
    assert tree["all"] == ("", 5, None) and tree["integrated"] == ("all", 3, 10) and tree["after_manual"] == ("integrated", 2, 5) and tree["drop_sample"] == ("after_manual", 1, 2)
    assert tree["not_integrated"][1] == 2 and tree["status_not_yet_categorised"] == ("not_integrated", 1, None) and tree["status_no_data"][1] == 1
    with pytest.raises(Exception, match="overlap"):
        jobs.filtering_tree(overview, integrated, [("a", "A", key("P3")), ("b", "B", key("P3"))], {}).collect()
    with pytest.raises(Exception, match="not integrated: X"):
        jobs.filtering_tree(overview, integrated, [("a", "A", key("X"))], {}).collect()


def test_mapping_plan_and_registry(spark):
    files = spark.createDataFrame([("p", "S1", "R1", "a_1.fq", True), ("p", "S1", "R1", "a_2.fq", True), ("p", "S2", "R2", "b_1.fq", True), ("p", "S2", "R2", "b_2.fq", True)], "paper string, sample string, run string, file string, on_disk boolean")
    runs = spark.createDataFrame([("R1", "E1", "PAIRED", "AMPLICON", "METAGENOMIC", "PCR", "al1", "gut"), ("R2", "E2", "PAIRED", "AMPLICON", "METAGENOMIC", "PCR", "al2", "")],
                                 "run string, experiment string, library_layout string, library_strategy string, library_source string, library_selection string, sample_alias string, isolation_source string")
    claims = spark.createDataFrame([("p", "S1", "paper_sample_id", "x", "confirmed", "table 1", 0, False), ("p", "S2", "group", "case", "confirmed", "", 0, False)],
                                   "paper string, sample string, field string, value string, confidence string, evidence string, position int, is_technical_control boolean")
    defaults = spark.createDataFrame([("p", "host", "human", "confirmed", "methods")], "paper string, field string, value string, confidence string, evidence string")
    facts = spark.createDataFrame([("p", 0, "confirmed")], "paper string, n_missing_facts int, facts_confidence string")
    out = jobs.sample_mapping(files, runs, claims, defaults, facts)
    problems = sorted((r["sample"], r.field, r.problem) for r in out["problems"].collect())
    assert problems == [("S1", "experimental_group", "required field is missing"), ("S2", "experimental_group", "confirmed with no evidence"), ("S2", "paper_sample_id", "required field is missing")]
    sample = {r["sample"]: r for r in out["samples"].collect()}
    assert sample["S1"].handle == "sample_alias" and sample["S2"].sample_label == "al2" and sample["S1"].host_species == "human"
    assert out["gate"].first().gate == "pass_quantification_only"
    shared = files.union(files.where("sample = 'S1'").withColumn("paper", F.lit("other")))
    both = {(r.paper, r["sample"]): r.blockers for r in jobs.sample_mapping(shared, runs, claims, defaults, facts)["samples"].collect()}
    assert len(both) == 3 and set(both.values()) == {""}  # a sample of two papers keeps its complete pair

    samples = spark.createDataFrame([("p", "S1", "al1", False, "", "amplicon", "human gut"), ("p", "S2", "Blank_1", False, "", "amplicon", "human gut"), ("q", "S3", "c", False, "", "rna", ""), ("r", "S4", "d", False, "", "dna_virome", "mouse gut")],
                                    "paper string, sample string, sample_alias string, is_technical_control boolean, metadata_evidence string, branch string, host_text string")
    calls = spark.createDataFrame([("p", "16S_V4", True)], "paper string, region string, primers_present boolean")
    known = spark.createDataFrame([("p", "verified", "16S_V4", True, "partial", "abundance", ["Blank_"])], "paper string, amplicon_status string, declared_region string, primers_in_reads boolean, identity_status string, usable_for string, exclude_alias_prefixes array<string>")
    plan = jobs.analysis_plan(samples, calls, known, "human|homo sapiens ; gut")
    assert {r.paper: (r.resolved, r.status) for r in plan["branches"].collect()} == {"p": ("amplicon_16s", "ready"), "q": ("rna", "unsupported"), "r": ("dna_virome", "blocked")}
    assert [r["sample"] for r in plan["dropped"].collect()] == ["S2"] and {r.paper: r.verdict for r in plan["plan"].collect()} == {"p": "runs", "q": "blocked", "r": "blocked"}

    book = spark.createDataFrame([("p", "3", "failed", 2, 1), ("p", "3", "done", 2, 2), ("q", "3", "failed", 1, 3), ("r", "2", "running", 1, 4), ("s", "3", "preflight_ok", 1, 5)], "paper string, step string, status string, updated_utc int, ordinal int")
    plans = spark.createDataFrame([("p", "amplicon_16s", "done"), ("q", "rna", "unsupported")], "paper string, branch string, status string")
    risk = spark.createDataFrame([("p", "pass", True, 0.5, 0)], "paper string, gate string, grouped_supported boolean, chimera_retention double, n_deferred int")
    reg = jobs.registry(book, plans, risk)
    assert {r.paper: r.level1 for r in reg["level1"].collect()} == {"p": "completed", "q": "method_missing", "r": "in_progress", "s": "in_progress"}
    counts = reg["counts"].first()
    assert counts.level1_balances and counts.risk_balances and counts.method_balances and reg["risks"].first().primary == "noisy_rare_asvs"


def test_coverage_profile_and_asv(spark):
    aln = spark.createDataFrame([("s1", "g", 0, 80, 1, 80), ("s1", "g", 20, 100, 1, 80), ("s1", "h", 0, 10, 9, 10), ("s2", "g", 0, 10, 0, 10)], "sample string, genome string, start long, end long, nm int, read_len int")
    lengths = spark.createDataFrame([("g", 100), ("h", 10)], "genome string, length long")
    names = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sample string")
    out = jobs.coverage_matrices(aln, lengths, names, 0.9)
    assert [(r["sample"], r.genome, r.relative_abundance) for r in out["relative_abundance"].collect()] == [("s1", "g", 1.0)]
    assert {r["sample"]: (r.genomes_with_any_read, r.genomes_detected) for r in out["mapping_stats"].collect()} == {"s1": (1, 1), "s2": (1, 0), "s3": (0, 0)}
    profile = spark.createDataFrame([("s1", "g", 60.0, 50.0, "c2", "99"), ("s1", "h", 40.0, 50.0, "c1", "98")], "sample string, genome string, taxonomic_abundance double, sequence_abundance double, contig_name string, adjusted_ani string")
    grid = {r["sample"]: (r.g, r.h) for r in jobs.profile_matrices(profile, names, ["g", "h"])["taxonomic_abundance"].collect()}
    assert grid == {"s1": (60.0, 40.0), "s2": (0.0, 0.0), "s3": (0.0, 0.0)}
    counts = spark.createDataFrame([("p", "s1", "A" * 253, 30), ("p", "s1", "C" * 252, 10), ("p", "s2", "A" * 253, 5), ("p", "s2", "G" * 100, 7)], "paper string, sample string, sequence string, n long")
    steps = spark.createDataFrame([("p", "s1", "raw", 3000), ("p", "s1", "filtered", 2000), ("p", "s1", "merged", 1000), ("p", "s1", "nonchimeric", 900)], "paper string, sample string, step string, n long")
    asv = jobs.asv_tables(counts, steps, counts.select("paper", "sample"), spark.createDataFrame([("p", 253)], "paper string, insert_p99 int"))
    assert {r.asv: len(r.sequence) for r in asv["asvs"].collect()} == {"ASV0001": 253, "ASV0002": 252}
    assert sorted((r["sample"], r.asv, r.relative_abundance) for r in asv["relative_abundance"].collect()) == [("s1", "ASV0001", 0.75), ("s1", "ASV0002", 0.25), ("s2", "ASV0001", 1.0)]
    assert {r.length: r.kept for r in asv["lengths"].collect()} == {100: False, 252: True, 253: True} and asv["verdict"].first().verdict == "ok"


def test_amplicon_facts(spark):
    from taxaloom.functions import fixed_values as V

    fwd, rev = V.PRIMERS["16S_V4"]
    plain = lambda p: "".join(V.IUPAC[c][0] for c in p)
    data = [("r1", "p", "R1", i, plain(fwd) + "ACGT" * 20) for i in range(4)] + [("r1", "p", "R2", i, plain(rev) + "ACGT" * 15) for i in range(4)]
    found = spark.createDataFrame(data, "run string, paper string, mate string, read_idx int, seq string")
    pairs = spark.createDataFrame([("p", "ACGTTGCATTGACCATGGATCCAGTTACGATTGACCAGT", "ACGTTGCATTGACCATGGATCCAGTTACGATTGACCAGT", False)] * 3, "paper string, seq1 string, seq2_rc string, read_through boolean")
    out = jobs.amplicon_facts(found, pairs)
    budget = out["budget"].first()
    assert (budget.region, budget.trim_f, budget.trim_r, budget.read_len_f, budget.insert_p99) == ("16S_V4", 19, 20, 99, 39)
    assert budget.need == 39 + 12 + 39 and out["agreement"].first().agrees
