"""End products over the given tables: links of documents, matrices of blocks, committed tables, filtering trees."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text
from ..operators import cells, links, metadata, reshape, stats, viral
from ..operators.ordering import scratch, stored
from ..sources import writers
from . import jobs
from .catalog import Tables, pick, query


@query("""
WITH old AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0), more AS (SELECT o_orderkey, 'new' AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, o_orderstatus, (SELECT count(*) FROM more WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)) AS n_written
FROM (FROM old UNION ALL FROM more WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old))
""")
def committed_append(t: Tables):
    """A table that is replaced, added to twice with the same rows, and read as it was committed."""
    path = scratch(t.spark)
    columns = ["o_orderkey", "o_orderstatus"]
    writers.replace_table(t.orders.select(*columns), path)
    writers.replace_table(t.orders.where("o_orderkey % 3 = 0").select(*columns), path)
    more = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("new").alias("o_orderstatus"))
    written = writers.append_rows(more, path, ["o_orderkey"]) + writers.append_rows(more, path, ["o_orderkey"])
    writers.recover(t.spark, path)
    return writers.read_table(t.spark, path).withColumn("n_written", F.lit(written).cast("bigint"))


_CELL = "CASE l_linenumber WHEN 2 THEN '0' WHEN 3 THEN '' WHEN 4 THEN '<LOD' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"


@query(f"""
WITH c AS (SELECT l_suppkey, l_orderkey, l_partkey, {_CELL} AS value FROM lineitem),
r AS (SELECT l_suppkey, l_orderkey, row_number() OVER (ORDER BY l_suppkey, l_orderkey) - 1 AS row FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM c)),
k AS (SELECT l_suppkey, l_partkey, row_number() OVER (ORDER BY l_suppkey, l_partkey) - 1 AS col FROM (SELECT DISTINCT l_suppkey, l_partkey FROM c))
SELECT l_suppkey, row, col, value FROM c JOIN r USING (l_suppkey, l_orderkey) JOIN k USING (l_suppkey, l_partkey) WHERE value NOT IN ('0', '')
""")
def block_diagonal(t: Tables):
    """Coordinates of one matrix with a block for every supplier: orders are its rows, parts its columns."""
    found = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", F.expr(_CELL).alias("value"))
    return viral.block_diagonal(found, "l_suppkey", "l_orderkey", "l_partkey", "value")[0]


# ---------------------------------------------------------------------------
# links of documents
# ---------------------------------------------------------------------------
_PAPERS = {
    "paper_id": "CAST(doc_id AS STRING)", "pmid": "CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS STRING) END", "pmcid": "CASE WHEN doc_id % 4 = 0 THEN concat('PMC', doc_id) WHEN doc_id % 4 = 1 THEN ' ' END",
    "doi": "concat('10.1/', doc_id)", "title": "concat('Study in PRJEB', 1000 + doc_id % 50)", "abstract": "CASE WHEN doc_id % 5 = 0 THEN concat('see bioproject #', 12000 + doc_id % 7) END",
}
_DEPOSIT = ("concat(' PRJNA', 100000 + doc_id, ' srr', 5000000 + doc_id % 11, '; GSE', 100 + doc_id % 900, ', github.com/benjjneb/dada2 and github.com/someone/thing', doc_id % 13, "
            "' at https://zenodo.org/records/', 100 + doc_id, '. Also https://figshare.com/articles/x/', 55000 + doc_id % 3, ') 10.5061/dryad.ab', doc_id % 9, ' OSF.io/AB', 100 + doc_id % 800)")
_MARKED = f"concat('<a><sec><title>Data availability</title><p>', regexp_replace(coalesce(text, ''), '[<>&]', ' '@flags), {_DEPOSIT}, '</p></sec></a>')"
_WITH_TEXT = "doc_id % 6 <> 5"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _links_sql() -> str:
    def hits(source: str, repository: str, pattern: str) -> str:
        found = f"unnest(regexp_extract_all({source}, {_quoted('(?i)' + pattern)}, 1))"
        return f"SELECT paper_id, '{repository}' AS repository, {found if repository in V.CASE_KEPT_REPOSITORIES else f'upper({found})'} AS accession FROM docs"

    named = " UNION ALL ".join(hits("mined", r, p) for r, p in V.ACCESSION_PATTERNS)
    denied = ", ".join(map(_quoted, V.TOOL_REPOSITORIES))
    papers = ", ".join(f"{e} AS {c}" for c, e in _PAPERS.items())
    return f"""
WITH docs AS (
  SELECT {papers}, CASE WHEN {_WITH_TEXT} THEN {_MARKED.replace("@flags", ", 'g'")} END AS xml FROM documents),
texts AS (SELECT *, regexp_replace(xml, '<[^>]+>', '', 'g') AS full_text FROM docs),
mined AS (SELECT * EXCLUDE (xml, full_text), xml, concat_ws(' ', title, abstract, full_text) AS mined FROM texts),
named AS ({named.replace('FROM docs', 'FROM mined')}),
numbers AS ({hits('xml', 'bioproject', V.PROJECT_NUMBER).replace('FROM docs', 'FROM mined')}),
urls AS (SELECT paper_id, regexp_replace(unnest(regexp_extract_all(xml, {_quoted('(?i)' + V.URL_PATTERN)})), {_quoted(V.URL_TRAILING)}, '') AS url FROM mined),
every AS (
  SELECT paper_id, repository, accession, '' AS raw_url, 'accession' AS link_type FROM named WHERE NOT (repository = 'github' AND lower(accession) IN ({denied}))
  UNION SELECT paper_id, repository, accession, '', 'accession' FROM numbers
  UNION SELECT paper_id, 'europepmc_supp', pmcid, '', 'accession' FROM mined WHERE trim(pmcid) <> ''
  UNION SELECT paper_id, 'url', '', url, 'data_url' FROM urls WHERE regexp_matches(url, {_quoted('(?i)' + V.DATA_HOSTS)}))
SELECT every.*, pmid, doi, CASE WHEN xml IS NULL THEN 'abstract' ELSE 'fulltext' END AS source, count(*) OVER (PARTITION BY paper_id) AS n_data_links FROM every JOIN mined USING (paper_id)
"""


@query(_links_sql())
def document_links(t: Tables):
    """Accessions, links and supplements of all documents, from titles, abstracts and mark-up, with the number of links a paper has."""
    papers = t.documents.select(*[F.expr(e).alias(c) for c, e in _PAPERS.items()])
    marked = t.documents.where(_WITH_TEXT).select(F.expr(_PAPERS["paper_id"]).alias("paper_id"), F.expr(_MARKED.replace("@flags", "")).alias("xml"))
    info, found = jobs.link_table(papers, marked)
    return found.join(info.select("paper_id", "n_data_links"), "paper_id").drop("pmcid")


# ---------------------------------------------------------------------------
# filtering tree
# ---------------------------------------------------------------------------
_IN, _MANUAL, _SAMPLE = "c_custkey % 3 <> 0", "c_acctbal < 0", "c_acctbal >= 0 AND c_acctbal < 2000"
_FILED = {"No data": "c_mktsegment = 'BUILDING'", "Review article": "c_mktsegment = 'MACHINERY'"}


def _tree_sql() -> str:
    inside = "SELECT {} AS node_id, {} AS parent_id, {} AS kind, {} AS label, count(*) AS papers, coalesce(sum(n_samples), 0)::bigint AS n_samples, coalesce(sum(n_features), 0)::bigint AS n_features FROM i WHERE {}"
    rows = [("integrated", "all", "keep", "All", "true"), ("drop_manual", "integrated", "drop", "Manual review", "q = 'manual'"), ("after_manual", "integrated", "keep", "After: Manual review", "q <> 'manual'"),
            ("drop_sample", "after_manual", "drop", "Missing samples", "q = 'sample'"), ("after_sample", "after_manual", "keep", "After: Missing samples", "q = ''")]
    nodes = [inside.format(*[_quoted(x) for x in r[:4]], r[4]) for r in rows]
    filed = " ".join(f"WHEN {c} THEN '{n}'" for n, c in _FILED.items())
    return f"""
WITH i AS (SELECT c_custkey % 50 AS n_samples, c_nationkey AS n_features, CASE WHEN {_MANUAL} THEN 'manual' WHEN {_SAMPLE} THEN 'sample' ELSE '' END AS q FROM customer WHERE {_IN}),
rest AS (SELECT CASE {filed} ELSE 'Not yet categorised' END AS label FROM customer WHERE NOT ({_IN}))
{' UNION ALL '.join(nodes)}
UNION ALL SELECT 'all', '', 'root', 'All candidate papers', count(*), NULL, NULL FROM customer
UNION ALL SELECT 'not_integrated', 'all', 'drop', 'No sample-level abundance matrix', count(*), NULL, NULL FROM rest
UNION ALL SELECT 'status_' || lower(replace(label, ' ', '_')), 'not_integrated', 'detail', label, count(*), NULL, NULL FROM rest GROUP BY label
"""


@query(_tree_sql())
def filtering_tree(t: Tables):
    """Every customer is a paper; two queues take integrated ones away, two status files say why others are none."""
    key = F.concat(F.lit("P"), "c_custkey").alias("paper_folder")
    keys = lambda *conditions: t.customer.where(" AND ".join(f"({c})" for c in conditions)).select(key)
    integrated = t.customer.where(_IN).select(key, (F.col("c_custkey") % 50).alias("n_samples"), F.col("c_nationkey").cast("bigint").alias("n_features"))
    queues = [("manual", "Manual review", keys(_IN, _MANUAL)), ("sample", "Missing samples", keys(_IN, _SAMPLE))]
    return jobs.filtering_tree(t.customer.select(key), integrated, queues, {name: keys(f"NOT ({_IN})", c) for name, c in _FILED.items()})


# ---------------------------------------------------------------------------
# registry of runs
# ---------------------------------------------------------------------------
_STEP = "CASE event_type WHEN 'purchase' THEN '3' WHEN 'error' THEN '2' ELSE '1' END"
_STATUS = pick("event_id", ["done", "failed", "running", "done_partial", "no_space", "preflight_ok", "done"])
_PLAN = {"paper": "user_id", "branch": pick("user_id", ["amplicon_16s", "rna", "viral_mapping", "dna_shotgun_bacteria", "amplicon_other"]), "status": pick("user_id", ["done", "unsupported", "blocked"])}
_RISK = {"paper": "user_id", "gate": pick("user_id", ["pass_quantification_only", "pass", "pass", "pass"]), "grouped_supported": "user_id % 5 <> 0",
         "chimera_retention": "CAST(user_id % 10 AS DOUBLE) / 10", "n_deferred": "CASE WHEN user_id % 6 = 0 THEN 2 ELSE 0 END"}


def _select(cells: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{c}"' for c, e in cells.items())


def _registry_sql() -> str:
    names = lambda values: ", ".join(map(_quoted, values))
    risks = ["starts_with(gate, 'pass_quantification_only') OR NOT grouped_supported", f"chimera_retention < {V.MIN_CHIMERA_RETENTION}", "n_deferred > 0"]
    found = ", ".join(f"CASE WHEN {c} THEN {_quoted(r)} END" for c, r in zip(risks, V.RISK_ORDER))
    methods = " ".join(f"WHEN '{b}' THEN '{m}'" for b, m in V.BRANCH_METHODS.items())
    return f"""
WITH users AS (SELECT DISTINCT user_id FROM events), plans AS (SELECT {_select(_PLAN)} FROM users), papers AS (SELECT {_select(_RISK)} FROM users),
now AS (SELECT user_id AS paper, {_STEP} AS step, arg_max({_STATUS}, (ts, event_id)) AS status FROM events GROUP BY ALL),
final AS (
  SELECT paper, max(status) FILTER (step = '3') AS status, coalesce(bool_or(step = '3' AND status IN ({names(V.FINISHED_STATUSES)})), false) AS completed, bool_or(status IN ({names(V.FAILED_STATUSES)})) AS failed
  FROM now GROUP BY 1),
level1 AS (
  SELECT paper, final.status, CASE WHEN completed THEN 'completed' WHEN plans.status = 'unsupported' THEN 'method_missing' WHEN failed THEN 'failed' ELSE 'in_progress' END AS level1
  FROM final JOIN plans USING (paper)),
risks AS (
  SELECT paper, coalesce({found}, 'none') AS first, concat_ws(';', {found}) AS every FROM level1 JOIN papers USING (paper) WHERE level1 = 'completed'),
methods AS (SELECT paper, CASE branch {methods} END AS method FROM plans JOIN level1 USING (paper) WHERE level1 = 'completed' AND plans.status = 'done')
SELECT 'level1' AS kind, paper, level1 AS label, '' AS more FROM level1
UNION ALL SELECT 'risk', paper, first, CASE WHEN every = '' THEN 'none' ELSE every END FROM risks
UNION ALL SELECT 'method', paper, method, '' FROM methods WHERE method IS NOT NULL
UNION ALL SELECT 'counts', NULL, (SELECT count(*) FROM level1)::varchar, (SELECT count(*) FROM risks)::varchar
"""


@query(_registry_sql())
def run_registry(t: Tables):
    """Class, risks and methods of every paper of a ledger, and the totals they add up to."""
    book = t.events.select(F.col("user_id").alias("paper"), F.expr(_STEP).alias("step"), F.expr(_STATUS).alias("status"), F.col("ts").alias("updated_utc"), F.col("event_id").alias("ordinal"))
    users = t.events.select("user_id").distinct()
    out = jobs.registry(book, users.select(*[F.expr(e).alias(c) for c, e in _PLAN.items()]), users.select(*[F.expr(e).alias(c) for c, e in _RISK.items()]))
    row = lambda df, kind, paper, label, more: df.select(F.lit(kind).alias("kind"), paper.alias("paper"), label.alias("label"), more.alias("more"))
    nothing = F.lit("")
    stacked = row(out["level1"], "level1", F.col("paper"), F.col("level1"), nothing).unionByName(row(out["risks"], "risk", F.col("paper"), F.col("primary"), F.col("all_labels")))
    stacked = stacked.unionByName(row(out["methods"], "method", F.col("paper"), F.col("method"), nothing))
    balanced = out["counts"].where("level1_balances AND risk_balances")
    return stacked.unionByName(row(balanced, "counts", F.lit(None).cast("bigint"), F.col("level1_total").cast("string"), F.col("n_completed").cast("string")))


# ---------------------------------------------------------------------------
# reads to tables
# ---------------------------------------------------------------------------
_ASV = {"paper": "concat('P', l_suppkey % 5)", "sample": "concat('S', l_orderkey % 30)", "sequence": "repeat(substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1), CAST(180 + l_partkey % 100 AS INT))"}
_INSERTS = [(f"P{i}", 230 + 5 * i) for i in range(4)]


@query(f"""
WITH c AS (SELECT {_select(_ASV)}, sum(l_quantity)::bigint AS n FROM lineitem GROUP BY ALL),
w AS (SELECT * FROM (VALUES {', '.join(map(str, _INSERTS))}) v(paper, p99)),
k AS (SELECT c.* FROM c LEFT JOIN w USING (paper) WHERE length(sequence) BETWEEN coalesce(p99 - 60, 0) AND coalesce(p99 + 20, 1000000)),
ids AS (SELECT paper, sequence, printf('ASV%04d', row_number() OVER (PARTITION BY paper ORDER BY total DESC, sequence)) AS asv FROM (SELECT paper, sequence, sum(n) AS total FROM k GROUP BY ALL))
SELECT paper, sample, asv, length(sequence)::int AS n_bases, n, round(n / sum(n) OVER (PARTITION BY paper, sample), 6) AS relative_abundance FROM k JOIN ids USING (paper, sequence)
""")
def asv_shares(t: Tables):
    """Sequences within each paper's length window, named by rank, with their share of the sample."""
    cells = t.lineitem.select(*[F.expr(e).alias(c) for c, e in _ASV.items()], "l_quantity").groupBy(*_ASV).agg(F.sum("l_quantity").cast("bigint").alias("n"))
    cells = stored(cells)
    steps = cells.groupBy("paper", "sample").agg(F.sum("n").alias("n")).select("paper", "sample", F.lit("raw").alias("step"), "n")
    inserts = t.region.limit(1).select(F.inline(F.array(*[F.struct(F.lit(p).alias("paper"), F.lit(n).alias("insert_p99")) for p, n in _INSERTS])))
    out = jobs.asv_tables(cells, steps, cells.select("paper", "sample"), inserts)
    share = out["relative_abundance"]
    return share.select("paper", "sample", "asv", F.length("sequence").alias("n_bases"), "n", F.round("relative_abundance", 6).alias("relative_abundance"))


_ALN = {"sample": "user_id % 40", "genome": "event_type", "a": "(event_id * 37) % 20000", "len": "CAST(round(value) AS BIGINT) + 1", "nm": "event_id % 29"}
_LENGTH, _BREADTH, _DEPTH = 20000, 0.05, 0.06


@query(f"""
WITH r AS (SELECT {_select(_ALN)} FROM events), k AS (SELECT sample, genome, a AS s, a + len AS e FROM r WHERE nm <= (1::double - 0.9::double) * len),
o AS (SELECT *, max(e) OVER (PARTITION BY sample, genome ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM k),
c AS (SELECT sample, genome, count(*) AS reads, sum(greatest(e - greatest(s, coalesce(m, s)), 0))::bigint AS covered_bases, sum(e - s) / {_LENGTH}.0 AS mean_depth FROM o GROUP BY ALL),
d AS (SELECT *, covered_bases / {_LENGTH}.0 AS breadth FROM c), hits AS (SELECT *, mean_depth / sum(mean_depth) OVER (PARTITION BY sample) AS share FROM d WHERE breadth >= {_BREADTH} AND mean_depth >= {_DEPTH})
SELECT sample, genome, reads, covered_bases, round(breadth, 6) AS breadth, round(mean_depth, 6) AS mean_depth, round(share, 6) AS relative_abundance,
       count(*) OVER (PARTITION BY genome) AS n_samples_detected FROM hits
""")
def detected_genomes(t: Tables):
    """Genomes covered well enough by alignments of sufficient identity, and their share of a sample."""
    aln = t.events.select(*[F.expr(e).alias(c) for c, e in _ALN.items()])
    aln = aln.select("sample", "genome", F.col("a").alias("start"), (F.col("a") + F.col("len")).alias("end"), "nm", F.col("len").alias("read_len"))
    lengths = t.events.select(F.col("event_type").alias("genome")).distinct().withColumn("length", F.lit(_LENGTH))
    out = jobs.coverage_matrices(aln, lengths, aln.select("sample"), 0.9, _BREADTH, _DEPTH)
    found = out["relative_abundance"].join(out["features"].select("genome", "n_samples_detected"), "genome")
    rounded = [F.round(c, 6).alias(c) for c in ("breadth", "mean_depth", "relative_abundance")]
    return found.select("sample", "genome", "reads", "covered_bases", *rounded, "n_samples_detected")


# ---------------------------------------------------------------------------
# small functions
# ---------------------------------------------------------------------------
_NAME = "concat('Müller-', c_name, CASE WHEN c_custkey % 2 = 0 THEN ' AB' ELSE '' END, CASE WHEN c_custkey % 3 = 0 THEN ', Other C' ELSE '' END)"
_CITED = "concat('at 10.5281/zenodo.', c_custkey, '; and https://doi.org/10.5061/dryad.x', c_custkey, ' or (10.6084/m9.figshare.', c_custkey, ').')"


@query(rf"""
WITH u AS (SELECT c_custkey, list_distinct([c_mktsegment, c_name, 'BUILDING', 'z']) AS l FROM customer),
d AS (SELECT c_custkey, unnest(regexp_extract_all({_CITED}, '(^|[^/\w.])(10\.(?:6084|5281|5061)/[^\s<>"''\[\];,]+)', 2)) AS doi FROM customer)
SELECT c.c_custkey, array_to_string(list_sort(l), ';') AS united, '10.1/' || CASE WHEN c.c_custkey % 2 = 0 THEN lower(c_name) ELSE 'x' || c.c_custkey END AS paper_key,
       regexp_replace(regexp_replace(strip_accents(trim(split_part({_NAME.replace('c_custkey', 'c.c_custkey')}, ',', 1))), '(^|\s)[A-Z]{{1,3}}$', ''), '[^A-Za-z]', '', 'g') AS surname,
       printf('%.1f%%', c.c_custkey % 7 * 100 / 7.0) AS share, CASE WHEN c.c_custkey % 4 = 0 THEN c_mktsegment ELSE c_name END AS first_filled,
       (SELECT string_agg('https://doi.org/' || regexp_replace(doi, '[.,;:)]+$', ''), ' ' ORDER BY doi) FROM d WHERE d.c_custkey = c.c_custkey) AS dois
FROM customer c JOIN u USING (c_custkey)
""")
def small_functions(t: Tables):
    """Joined lists, keys of papers, surnames, shares as text, first filled columns and cited DOIs."""
    even = F.col("c_custkey") % 2 == 0
    headers = F.create_map(F.lit(" Name "), F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.col("c_name")), F.lit("segment"), F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey", text.union_values(F.concat_ws("; ", "c_mktsegment", "c_name"), F.concat_ws(";", F.lit("BUILDING"), "c_name", F.lit("z"), F.lit(""))).alias("united"),
        text.paper_key(F.when(even, F.concat(F.lit(" https://DOI.org/10.1/"), "c_name")), F.concat(F.lit("10.1/X"), "c_custkey")).alias("paper_key"),
        text.ascii_surname(F.expr(_NAME)).alias("surname"), text.share_text(F.col("c_custkey") % 7, F.lit(7)).alias("share"),
        text.first_nonblank(text.lower_keys(headers), ["none", "name", "segment"]).alias("first_filled"),
        F.array_join(F.array_sort(links.doi_links(F.expr(_CITED))), " ").alias("dois"))


# ---------------------------------------------------------------------------
# viral summaries, first runs, samples of tables
# ---------------------------------------------------------------------------
_KINDS = {"paper_folder": "concat('P', s_suppkey)", "row_rank": pick("s_suppkey", ["vOTU / viral genome", "OTU", "Species"]), "n_features": "CAST(10 AS BIGINT)", "n_viral_features": "CAST(s_suppkey % 11 AS BIGINT)"}
_RANKS = {r: pick(f"p_partkey * {i + 3} + {i}", [f"{r} a", "", None, f"{r} b"]) for i, r in enumerate(V.VIRAL_RANKS)}
_RECOVERY = {"P3": "VLP-enriched virome", "P7": "filtered VLP"}
_STATES = {"disease_status": pick("c_custkey", ["healthy", "case", "control", "not reported", "", "odd", None]), "metadata_completeness": pick("c_custkey", ["full", "grouped", "ids_only"])}


def _viral_sql() -> str:
    status = " ".join(f"WHEN regexp_matches(lower(trim(disease_status)), {_quoted(p)}){f' AND regexp_matches(lower(trim(disease_status)), {_quoted(also)})' if also else ''} THEN {_quoted(label)}"
                      for label, p, also in V.DISEASE_STATUS)
    deepest = "CASE " + " ".join(f"WHEN trim(coalesce(\"{r}\", '')) <> '' THEN '{r}'" for r in reversed(V.VIRAL_RANKS)) + " ELSE 'No taxonomy' END"
    methods = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _RECOVERY.items())
    counted = "SELECT '{}' AS tbl, {} AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {} GROUP BY 2"
    return f"""
WITH kinds AS (
  SELECT *, CASE WHEN row_rank = 'vOTU / viral genome' OR n_viral_features >= n_features THEN 'viral_dedicated' ELSE 'mixed' END AS matrix_type,
         CASE paper_folder {methods} ELSE '{V.DEFAULT_RECOVERY}' END AS method FROM (SELECT {_select(_KINDS)} FROM supplier)),
f AS (SELECT concat('P', p_partkey % 10 + 1) AS paper_folder, {_select(_RANKS)} FROM part),
features AS (SELECT *, {deepest} AS deep FROM f JOIN kinds USING (paper_folder)), samples AS (SELECT {_select(_STATES)} FROM customer)
{counted.format('matrix_type', 'matrix_type', 'kinds')}
UNION ALL {counted.format('viral_rank_depth', "CASE WHEN deep = 'No taxonomy' THEN deep WHEN deep IN ('family', 'kingdom', 'species', 'class') THEN upper(left(deep, 1)) || substr(deep, 2) ELSE 'Other ranks' END", 'features')}
UNION ALL {counted.format('viral_recovery_method', "CASE WHEN contains(method, 'VLP') THEN 'VLP-enriched virome' ELSE 'bulk shotgun / incidental' END", 'features')}
UNION ALL {counted.format('viral_disease_status', f"CASE WHEN trim(coalesce(disease_status, '')) = '' THEN 'Not recorded' {status} ELSE 'Other label' END", 'samples')}
UNION ALL {counted.format('viral_metadata_completeness', 'metadata_completeness', 'samples')}
"""


@query(_viral_sql())
def viral_counts(t: Tables):
    """Kinds of matrices, deepest ranks, recovery methods, disease states and completeness, each with its share."""
    kinds = viral.matrix_type(t.supplier.select(*[F.expr(e).alias(c) for c, e in _KINDS.items()]), _RECOVERY)
    features = t.part.select(F.concat(F.lit("P"), F.col("p_partkey") % 10 + 1).alias("paper_folder"), *[F.expr(e).alias(c) for c, e in _RANKS.items()])
    features = features.join(kinds.select("paper_folder", "viral_recovery_method"), "paper_folder")
    tables = viral.viral_summaries(features, t.customer.select(*[F.expr(e).alias(c) for c, e in _STATES.items()]))
    tables["matrix_type"] = stats.counter_table(kinds, "matrix_type")
    stacked = [df.select(F.lit(name).alias("tbl"), F.col(df.columns[0]).alias("label"), "n", F.round("share", 6).alias("share")) for name, df in tables.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), stacked)


@query("""
WITH first AS (SELECT l_orderkey AS sample, min('R' || l_partkey) AS run FROM lineitem GROUP BY 1)
SELECT sample, first.run, p_brand, p_type FROM first LEFT JOIN part ON run = 'R' || p_partkey AND p_size > 5
""")
def first_runs(t: Tables):
    """A sample takes its metadata from its first run, also where that has none."""
    run = lambda c: F.concat(F.lit("R"), c).alias("run")
    runs = t.part.where("p_size > 5").select(run("p_partkey"), "p_brand", "p_type")
    return metadata.first_run_metadata(t.lineitem.select(F.col("l_orderkey").alias("sample"), run("l_partkey")), runs, ["p_brand", "p_type"]).select("sample", "run", "p_brand", "p_type")


@query("""
SELECT l_suppkey AS table_id, l_orderkey AS sample_id, max(CASE WHEN l_linenumber = 3 THEN 'blank_or_control' ELSE '' END) AS sample_flag,
       max(CASE WHEN l_linenumber = 2 THEN 'WGS' WHEN l_linenumber = 4 THEN '16S' ELSE '' END) AS sequencing_type_hint, any_value(s_name) AS source_file
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey GROUP BY 1, 2
""")
def table_samples(t: Tables):
    """One row per table and sample, with its marks and what describes the table."""
    flag, hint = F.when(F.col("l_linenumber") == 3, "blank_or_control").otherwise(""), F.when(F.col("l_linenumber") == 2, "WGS").when(F.col("l_linenumber") == 4, "16S").otherwise("")
    long = t.lineitem.select(F.col("l_suppkey").alias("table_id"), F.col("l_orderkey").alias("sample_id"), flag.alias("sample_flag"), hint.alias("sequencing_type_hint"))
    return reshape.samples_from_tables(long, t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("table_id"), F.col("s_name").alias("source_file")))


@query(r"""
WITH c AS (
  SELECT 0 AS col_idx, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::varchar ELSE c_name END AS v FROM customer UNION ALL SELECT 1, CASE WHEN c_custkey % 4 > 0 THEN c_acctbal::varchar END FROM customer
  UNION ALL SELECT 2, CASE WHEN c_custkey % 4 > 0 THEN '1e' || c_nationkey ELSE 'x' END FROM customer UNION ALL SELECT 3, NULL FROM customer)
SELECT col_idx, round(count(*) FILTER (regexp_matches(v, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')) / (SELECT count(*) FROM customer), 6) AS fraction FROM c GROUP BY 1 HAVING fraction > 0.5
""")
def numeric_columns(t: Tables):
    """Columns that are mostly numbers, of all rows that hold anything."""
    wide = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name")).alias("a"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal")).alias("b"),
                             F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("1e"), "c_nationkey")).otherwise("x").alias("c"), F.lit(None).cast("string").alias("d"))
    found = cells.numeric_columns(cells.cells_of(wide, "customers", "c_custkey", ["a", "b", "c", "d"]), 0.5)
    return found.select("col_idx", F.round("fraction", 6).alias("fraction"))
