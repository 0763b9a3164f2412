"""Queries over names, documents and pages: rules, clean-up, links, candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bases, rules, taxa, text
from ..functions.rules import case_when
from ..operators import candidates, links, reads, stats, viral
from .catalog import Tables, n_rows, query

NAME_RULES = [("Temperature", "hot|cold"), ("Colour", "red|blue"), ("Size", "large|small")]


@query("""
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT CASE WHEN regexp_matches(lower(p_name), 'hot|cold') THEN 'Temperature' WHEN regexp_matches(lower(p_name), 'red|blue') THEN 'Colour'
             WHEN regexp_matches(lower(p_name), 'large|small') THEN 'Size' ELSE 'Other / unclear' END AS label FROM part) GROUP BY label
""")
def first_match_bucket(t: Tables):
    labelled = t.part.select(rules.bucket(F.col("p_name"), NAME_RULES).alias("label"))
    return stats.counter_table(labelled, "label").withColumn("share", F.round("share", 6))


TERMS = "promo|small|large|economy|standard|medium"


@query(rf"""
WITH s AS (SELECT regexp_replace(lower(p_name || ', not ' || p_type || ' or large'),
    '\b(not|non|un)[-\s]*({TERMS})((\s*[/,]\s*|\s+(or|and|nor)\s+)({TERMS}))*', ' ', 'g') AS x FROM part)
SELECT CASE WHEN contains(x, 'large') THEN 'Large' WHEN contains(x, 'small') THEN 'Small' WHEN contains(x, 'economy') THEN 'Economy' ELSE 'None' END AS label,
       count(*) AS n FROM s GROUP BY 1
""")
def negation_bucket(t: Tables):
    stated = F.lower(F.concat("p_name", F.lit(", not "), "p_type", F.lit(" or large")))
    left = rules.strip_negations(stated, TERMS)
    return t.part.groupBy(rules.bucket(left, [("Large", "large"), ("Small", "small"), ("Economy", "economy")], "None").alias("label")).agg(n_rows())


DOMAIN_WORDS = [("english", " the | and "), ("french", " les | et "), ("german", " und | der "), ("spanish", " los | las "), ("licence", "licen[sc]e")]


def _sql_hits(column: str, word_rules, flags: str = "") -> list[str]:
    return [f"regexp_matches({column}, '{flags}{p}')" for _, p in word_rules]


@query(f"""
WITH h AS (SELECT lang, {', '.join(f"{e} AS h{i}" for i, e in enumerate(_sql_hits('lower(text)', DOMAIN_WORDS)))} FROM documents)
SELECT lang, CASE WHEN {' + '.join(f'h{i}::int' for i in range(5))} <> 1 THEN 'unresolved'
       {' '.join(f"WHEN h{i} THEN '{n}'" for i, (n, _) in enumerate(DOMAIN_WORDS))} END AS domain, count(*) AS n FROM h GROUP BY 1, 2
""")
def single_domain(t: Tables):
    domain = F.coalesce(rules.exactly_one(F.lower("text"), DOMAIN_WORDS), F.lit("unresolved"))
    return t.documents.groupBy("lang", domain.alias("domain")).agg(n_rows())


SCREEN = {
    "community": r"license|@|[0-9]", "assays": [("mail", r"[a-z0-9._]+@[a-z0-9.]+"), ("number", r"[0-9]{3,}")], "product": r"released|licensed",
    "data": r"https?://", "not_primary": r"password|secret|api_?key", "isolate": r"click here|subscribe", "host_only": r"buy now|cheap",
}


@query(rf"""
WITH h AS (SELECT regexp_matches(text, '(?i){SCREEN["community"]}') AS c, regexp_matches(text, '(?i){SCREEN["assays"][0][1]}') AS a1,
    regexp_matches(text, '(?i){SCREEN["assays"][1][1]}') AS a2, regexp_matches(text, '(?i){SCREEN["product"]}') AS p, regexp_matches(text, '(?i){SCREEN["data"]}') AS d,
    regexp_matches(text, '(?i){SCREEN["not_primary"]}') OR regexp_matches(source, '(?i){SCREEN["not_primary"]}') AS r,
    regexp_matches(text, '(?i){SCREEN["isolate"]}') AS i, regexp_matches(text, '(?i){SCREEN["host_only"]}') AS ho FROM documents),
g AS (SELECT *, concat_ws(';', CASE WHEN a1 THEN 'mail' END, CASE WHEN a2 THEN 'number' END) AS a, ho AND NOT c AS h FROM h)
SELECT CASE WHEN r OR i OR h THEN 'exclude_likely' WHEN c AND a <> '' THEN 'likely_relevant' WHEN c THEN 'manual_review' ELSE 'low_priority' END AS screen_status,
  CASE WHEN a = '' THEN 'unknown' ELSE a END AS assay_prediction, p AS processed_data_hint, d AS data_link_hint,
  concat_ws(';', CASE WHEN c THEN 'community_terms' END, CASE WHEN a <> '' THEN 'assay:' || a END, CASE WHEN p THEN 'abundance_terms' END, CASE WHEN d THEN 'data_terms' END) AS screen_evidence,
  concat_ws(';', CASE WHEN r THEN 'review_or_non_primary' END, CASE WHEN i THEN 'isolate_or_single_genome' END, CASE WHEN h THEN 'host_only_assay' END) AS screen_reason,
  count(*) AS n FROM g GROUP BY ALL
""")
def screen_documents(t: Tables):
    screened = candidates.screen(t.documents, F.col("text"), F.col("source"), **SCREEN, diseases=None)
    columns = ["screen_status", "assay_prediction", "processed_data_hint", "data_link_hint", "screen_evidence", "screen_reason"]
    return screened.groupBy(*columns).agg(n_rows())


KEYWORDS = [("license", "licen[sc]e"), ("mail", "@"), ("the", " the "), ("les", " les "), ("digits", "[0-9]{4}")]


@query(f"""
SELECT lang, CASE WHEN m = '' THEN 'unknown' ELSE m END AS matched, count(*) AS n FROM (SELECT lang, concat_ws(';',
  {', '.join(f"CASE WHEN {e} THEN '{n}' END" for (n, _), e in zip(KEYWORDS, _sql_hits('text', KEYWORDS, '(?i)')))}) AS m FROM documents) GROUP BY 1, 2
""")
def all_matches(t: Tables):
    return t.documents.groupBy("lang", rules.all_matches(F.col("text"), KEYWORDS, "unknown").alias("matched")).agg(n_rows())


PRIORITY_SYNONYMS = {"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium"}


@query("""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' ELSE o_orderpriority END AS name,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'merged synonym' WHEN o_orderpriority = '5-LOW' THEN 'verbatim (abbreviation undefined in source)'
       ELSE 'verbatim' END AS how,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not_reported' ELSE o_orderpriority END AS cleaned, count(*) AS n FROM orders GROUP BY ALL
""")
def normalise_values(t: Tables):
    p = F.col("o_orderpriority")
    d = taxa.normalise_disease(p, PRIORITY_SYNONYMS, ["5-low"])
    return t.orders.groupBy(d["name"].alias("name"), d["how"].alias("how"), text.clean_missing(p, ["", "4-not specified"]).alias("cleaned")).agg(n_rows())


@query("""
SELECT CASE WHEN quality = 1 THEN 'high' WHEN toxic = 1 THEN 'toxic' ELSE lang END AS disease, 'group_description=' || lang || '; cohort_source=' || source AS source_label_fields,
  count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL
""")
def coalesce_labels(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    quality = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "n/a").otherwise("not labelled")
    toxic = F.when(F.col("toxic") == 1, "toxic").otherwise("none")
    row = F.create_map(F.lit("disease"), quality, F.lit("disease_name"), toxic, F.lit("group_description"), F.col("lang"), F.lit("cohort_source"), F.col("source"))
    return viral.resolve_labels(docs.withColumn("row", row)).groupBy("disease", "source_label_fields").agg(n_rows())


@query("""
WITH f AS (SELECT user_id, ts::date AS day, bool_or(event_type = 'signup') AS s, bool_or(event_type = 'purchase') AS t, bool_or(event_type = 'error') AS g FROM events GROUP BY ALL)
SELECT CASE WHEN s AND t AND g THEN 'full' WHEN g AND t THEN 'grouped_longitudinal' WHEN g THEN 'grouped' WHEN s OR t THEN 'unlabelled_but_structured' ELSE 'ids_only' END AS metadata_completeness,
  concat_ws('; ', 'prevalence; alpha/beta diversity; co-occurrence; vOTU catalogue', CASE WHEN g THEN 'group comparison' END,
    CASE WHEN s AND t THEN 'longitudinal / repeated measures' END, CASE WHEN s THEN 'within-subject pairing' END) AS can_answer,
  concat_ws('; ', CASE WHEN NOT g THEN 'group comparison' END, CASE WHEN NOT (s AND t) THEN 'longitudinal / repeated measures' END, CASE WHEN NOT s THEN 'within-subject pairing' END) AS cannot_answer,
  count(*) AS n FROM f GROUP BY ALL
""")
def usability_levels(t: Tables):
    has = lambda v: F.bool_or(F.col("event_type") == v)
    facts = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(has("signup").alias("s"), has("purchase").alias("t"), has("error").alias("g"))
    columns = viral.usability_columns(F.col("s"), F.col("t"), F.col("g"))
    return facts.withColumns(columns).groupBy(*columns).agg(n_rows())


@query(r"""
WITH p AS (SELECT regexp_extract(url, '//(blog|www|m)\.', 1) AS sub, regexp_extract(url, '^https?://[^/]+/(en|fr|de|es)/', 1) AS lang, starts_with(url, 'https') AS s FROM pages)
SELECT CASE WHEN sub = 'blog' THEN 'Mouse' WHEN sub = 'm' THEN 'Other / unclear' WHEN lang = 'en' THEN 'Environmental / none' WHEN lang = 'fr' THEN 'Human'
            WHEN lang = 'es' THEN 'Plant' WHEN s THEN 'Rat' ELSE 'Not recorded' END AS host, count(*) AS n FROM p GROUP BY 1
""")
def host_fallback(t: Tables):
    sub, lang = F.regexp_extract("url", r"//(blog|www|m)\.", 1), F.regexp_extract("url", r"^https?://[^/]+/(en|fr|de|es)/", 1)
    host = case_when([(sub == "blog", F.lit("Mus musculus")), (sub == "m", F.lit("a host"))], F.lit(""))
    kind = case_when([(lang == "en", F.lit("garden soil")), (lang == "fr", F.lit("human stool")), (lang == "es", F.lit("tomato leaf"))], F.lit(""))
    hint = F.when(F.startswith("url", F.lit("https")), "Rat").otherwise("")
    return t.pages.groupBy(taxa.host_of(host, kind, hint).alias("host")).agg(n_rows())


@query("""
SELECT r_name AS kingdom, n_name AS phylum, '' AS class, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def lineage_split(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    ranks = taxa.split_taxonomy(F.concat(F.lit("d__"), "r_name", F.lit(";p__"), "n_name"))
    return joined.select(ranks.alias("r")).groupBy("r.kingdom", "r.phylum", "r.class").agg(n_rows())


SUFFIXES = [("ring", "genus"), ("bolt", "family"), ("plate", "order")]


@query("""
SELECT lower(p_type) AS column_rank, CASE WHEN p_name LIKE '%ring' THEN 'genus' WHEN p_name LIKE '%bolt' THEN 'family' WHEN p_name LIKE '%plate' THEN 'order' ELSE lower(p_type) END AS true_rank,
  count(*) AS n FROM part GROUP BY ALL
""")
def suffix_rank(t: Tables):
    column_rank = F.lower("p_type")
    true_rank = F.coalesce(taxa.suffix_rank(F.col("p_name"), SUFFIXES), column_rank)
    return t.part.groupBy(column_rank.alias("column_rank"), true_rank.alias("true_rank")).agg(n_rows())


HREF = r'href="([^"]+)"'


@query(r"""
WITH l AS (SELECT DISTINCT page_id, regexp_replace(unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)), '[.,;)\\"\]]+$', '') AS url FROM pages)
SELECT url, count(*) AS n_pages FROM l GROUP BY url
""")
def regex_mine_links(t: Tables):
    found = links.mine_urls(t.pages, "page_id", "html", hosts=None, pattern=HREF, group=1, unique_keys=True)
    return found.groupBy("url").agg(F.count(F.lit(1)).alias("n_pages"))


SITES = [("com", r"\.com$", None), ("net", r"\.net$", None), ("org", r"\.org$", None)]


def _page_links(t: Tables):
    """Links of pages as datasets: repository = kind of site, target = path of the link."""
    pages = t.pages.select("page_id", "html", links.platform_of(F.col("url"), SITES).alias("repository"))
    found = links.mine_urls(pages, "page_id", "html", hosts=None, pattern=HREF, group=1, keep=["repository"], unique_keys=True)
    named = found.select(
        F.col("page_id").alias("paper_id"), "repository", F.col("url").alias("accession"), F.lit("").alias("raw_url"), F.lit(None).cast("string").alias("pmid"))
    return named.withColumn("dataset_id", F.concat_ws(":", "repository", "accession"))


FILE_RULES = {"abundance": "tion", "reads": "^/(the|of)$", "table": "er$", "sequence": ["org"], "processed": ["net"]}


def _page_candidates(t: Tables):
    found = _page_links(t)
    datasets, _ = links.group_links(found, ("paper_id",))
    judged = candidates.dataset_status(datasets.withColumn("resolve_status", F.lit("ok")), "accession", **FILE_RULES)
    papers = t.pages.select(
        F.col("page_id").alias("paper_id"), F.when(F.col("url").contains("/en/"), "16S_amplicon").otherwise("unknown").alias("assay_prediction"),
        F.when(F.col("url").contains("spam"), "host_only_assay").otherwise("").alias("screen_reason"))
    return candidates.paper_status(papers, found, judged), found, judged


_PAGE_SQL = r"""
WITH l AS (SELECT DISTINCT page_id, regexp_replace(unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)), '[.,;)\\"\]]+$', '') AS acc FROM pages),
s AS (SELECT page_id, url, CASE WHEN regexp_matches(h, '\.com$') THEN 'com' WHEN regexp_matches(h, '\.net$') THEN 'net' WHEN regexp_matches(h, '\.org$') THEN 'org' ELSE 'unknown' END AS repo
      FROM (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS h FROM pages)),
d AS (SELECT page_id, repo, acc, regexp_matches(acc, '(?i)tion') AS ab, regexp_matches(acc, '(?i)^/(the|of)$') OR repo = 'org' AS rd, regexp_matches(acc, '(?i)er$') AND repo = 'net' AS tb
      FROM l JOIN s USING (page_id) WHERE acc <> ''),
k AS (SELECT page_id, count(*) AS n, bool_or(ab) AS a, bool_or(NOT ab AND NOT rd AND tb) AS c, bool_or(rd) AS r FROM d GROUP BY 1),
f AS (SELECT s.page_id AS paper_id, coalesce(n, 0) AS n_linked_datasets, CASE WHEN a THEN 'abundance_ready' WHEN c THEN 'needs_content_check'
      WHEN r AND contains(url, '/en/') AND NOT contains(url, 'spam') THEN 'raw_reads_ready' WHEN r THEN 'raw_reads_needs_assay_check' WHEN n > 0 THEN 'manual_review' ELSE 'no_data_link_found' END AS final_status
      FROM s LEFT JOIN k USING (page_id))
"""


@query(_PAGE_SQL + """
SELECT paper_id, n_linked_datasets, final_status, CASE WHEN final_status IN ('abundance_ready', 'needs_content_check') THEN 'processed'
  WHEN final_status LIKE 'raw_reads%' THEN 'raw_reads' ELSE 'unknown' END AS data_category FROM f
""")
def platform_rollup(t: Tables):
    """Flagship: which pages link to usable data, and of what kind."""
    status, _, _ = _page_candidates(t)
    return status.select("paper_id", "n_linked_datasets", "final_status", "data_category")


@query(_PAGE_SQL + """, v AS (SELECT page_id AS paper_id, bool_or(ab AND repo = 'com') AS cv FROM d GROUP BY 1)
SELECT final_status, CASE WHEN coalesce(cv, false) THEN 'none_have_matrix' WHEN final_status LIKE 'raw_reads%' THEN 'run_own_pipeline'
  WHEN final_status IN ('needs_content_check', 'manual_review') THEN 'manual_content_review' ELSE 'no_data_found' END AS next_action, count(*) AS n
FROM f LEFT JOIN v USING (paper_id) GROUP BY ALL
""")
def status_chain(t: Tables):
    status, found, judged = _page_candidates(t)
    verified = judged.select("dataset_id", (F.col("has_abundance_hint") & (F.col("repository") == "com")).alias("content_verified"))
    return candidates.next_action(status, found, verified).groupBy("final_status", "next_action").agg(n_rows())


@query(r"""
WITH l AS (SELECT DISTINCT page_id, regexp_replace(unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)), '[.,;)\\"\]]+$', '') AS acc FROM pages),
s AS (SELECT page_id, CASE WHEN regexp_matches(h, '\.com$') THEN 'com' WHEN regexp_matches(h, '\.net$') THEN 'net' WHEN regexp_matches(h, '\.org$') THEN 'org' ELSE 'unknown' END AS repository
      FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS h FROM pages))
SELECT repository || ':' || acc AS dataset_id, count(*) AS n_paper_ids FROM l JOIN s USING (page_id)
WHERE acc <> '' AND NOT (repository = 'com' AND lower(acc) IN ('/de', '/the')) GROUP BY 1
""")
def group_links(t: Tables):
    kept = links.deny_repos(_page_links(t), "repository", "accession", ["/de", "/the"], only="com")
    datasets, _ = links.group_links(kept, ("paper_id",))
    return datasets.select("dataset_id", "n_paper_ids")


_UNESCAPE = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query(rf"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g') AS x FROM pages),
b AS (SELECT page_id, trim(regexp_replace({_UNESCAPE.format('x')}, '\s+', ' ', 'g')) AS y FROM a)
SELECT page_id, length(y)::bigint AS n_chars, md5(y) AS text_md5 FROM b
""")
def visible_text(t: Tables):
    body = t.pages.select("page_id", links.html_text(F.col("html")).alias("y"))
    return body.select("page_id", F.length("y").cast("bigint").alias("n_chars"), F.md5("y").alias("text_md5"))


@query("SELECT page_id, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS text_md5, '' AS availability_text FROM pages")
def html_sections(t: Tables):
    found = links.fulltext_sections(t.pages, "html")
    return found.select("page_id", F.md5("full_text").alias("text_md5"), "availability_text")


_PART_TITLES = ["Data availability", "Associated data", "Results"]


def _marked_up(t: Tables) -> DataFrame:
    """A well-formed article per page: a part under one of three titles that links to the page, and a methods part with a deposition sentence."""
    url = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    title = F.element_at(F.array(*[F.lit(x) for x in _PART_TITLES]), (F.col("page_id") % 3 + 1).cast("int"))
    body = F.concat(F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink"><body><sec><title>'), title, F.lit('</title><p>Page '), F.col("page_id").cast("string"),
                    F.lit(' is at <ext-link xlink:href="'), url, F.lit('">its   place</ext-link></p></sec><sec><title>Methods</title><p>Reads were deposited at '), url,
                    F.lit('</p><p>Nothing else</p></sec></body></article>'))
    return t.pages.select("page_id", body.alias("xml"))


@query(f"""
WITH p AS (SELECT page_id, url, list_extract({_PART_TITLES}, (page_id % 3 + 1)::int) AS title FROM pages)
SELECT page_id, title AS section, 'Page ' || page_id || ' is at its place' AS text, url AS hrefs FROM p WHERE title <> 'Results'
UNION ALL SELECT page_id, 'Methods', 'Reads were deposited at ' || url, '' FROM p
""")
def availability_parts(t: Tables):
    found = links.availability_sections(_marked_up(t), "page_id", "xml")
    return found.select("page_id", "section", "text", F.array_join("hrefs", " ").alias("hrefs"))


@query(f"""
WITH p AS (SELECT page_id, url, list_extract({_PART_TITLES}, (page_id % 3 + 1)::int) AS title FROM pages)
SELECT page_id, md5(title || 'Page ' || page_id || ' is at its placeMethodsReads were deposited at ' || url || 'Nothing else') AS text_md5,
  CASE WHEN title <> 'Results' THEN title || 'Page ' || page_id || ' is at its place' ELSE '' END AS availability_text FROM p
""")
def marked_up_sections(t: Tables):
    found = links.fulltext_sections(_marked_up(t), "xml")
    return found.select("page_id", F.md5("full_text").alias("text_md5"), "availability_text")


@query("""
WITH o AS (SELECT o_orderstatus, o_orderkey + 1 AS a, o_orderkey + 1 + length(o_orderpriority) AS b FROM orders)
SELECT o_orderstatus, count(*) AS n_orders, sum(b - a + 2)::bigint AS n_supported, 0::bigint AS n_unsupported, sum((a + b) * (b - a + 1) / 2)::bigint AS checksum FROM o GROUP BY 1
""")
def range_expand(t: Tables):
    a = F.col("o_orderkey") + 1
    b = a + F.length("o_orderpriority")
    cell = F.format_string("SRR%d-%d; see PRJEB%d; CRA%d (isolate genome)", a, b, a, a)
    out = t.orders.select("o_orderstatus", text.parse_accessions(cell).alias("p"), text.expand_ranges(cell).alias("r"))
    total = F.aggregate(F.transform("r", lambda x: F.substring(x, 4, 20).cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return out.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.size("p.supported")).alias("n_supported"), F.sum(F.size("p.unsupported")).alias("n_unsupported"), F.sum(total).alias("checksum"))


@query("""
SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS event_types, arg_min(props, event_id) FILTER (event_type <> 'error') AS first_props FROM events GROUP BY 1
""")
def merge_hits(t: Tables):
    hits = t.events.withColumn("first_props", F.when(F.col("event_type") == "error", " ").otherwise(F.col("props")))
    merged = candidates.merge_hits(hits, "user_id", ["event_type"], ["first_props"], "event_id")
    return merged.select("user_id", F.array_join("event_type", ";").alias("event_types"), "first_props")


@query("""
WITH known AS (SELECT lower(c_name) AS id FROM customer WHERE c_acctbal < 0),
a AS (SELECT s_suppkey, s_nationkey, 'customer#' || right(s_name, 9) AS id FROM supplier)
SELECT min(s_suppkey) AS s_suppkey, s_nationkey FROM a WHERE id NOT IN (SELECT id FROM known) GROUP BY s_nationkey
""")
def identity_join(t: Tables):
    papers = t.customer.where("c_acctbal < 0").select(F.col("c_name").alias("doi"), F.lit(None).cast("string").alias("pmid"))
    number = F.concat(F.lit("Customer#"), F.substring("s_name", -9, 9))
    allow = t.supplier.select("s_suppkey", "s_nationkey", number.alias("doi"), F.concat(F.lit("nation "), "s_nationkey").alias("pmid"))
    return candidates.add_allowlist(papers, allow, ["doi", "pmid"], "s_suppkey").select("s_suppkey", "s_nationkey")


@query("""
WITH a AS (SELECT o_orderkey, o_orderkey - row_number() OVER (ORDER BY o_orderkey) AS run FROM orders WHERE o_custkey % 200 > 0),
placed AS (SELECT o_orderkey, row_number() OVER (PARTITION BY run ORDER BY o_orderkey) AS spot FROM a)
SELECT o_orderkey FROM placed WHERE spot % 2 = 1
""")
def identity_chain(t: Tables):
    """Rows that share an identifier with the next one, in chains of hundreds: every other one is added."""
    allow = t.orders.where(F.col("o_custkey") % 200 > 0).select("o_orderkey", F.format_string("10.1/%d", "o_orderkey").alias("doi"), F.format_string("10.1/%d", F.col("o_orderkey") + 1).alias("pmid"))
    papers = t.region.select(F.lit("10.1/none").alias("doi"), F.lit(None).cast("string").alias("pmid"))
    return candidates.add_allowlist(papers, allow, ["doi", "pmid"], "o_orderkey").select("o_orderkey")


@query("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1")
def distinct_joined(t: Tables):
    return candidates.archive_values(t.customer, "c_nationkey", ["c_mktsegment"])


@query("""
WITH a AS (SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS x, list(DISTINCT event_type) AS l FROM events WHERE ts < TIMESTAMP '2024-01-02' GROUP BY 1),
b AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-02'),
c AS (SELECT a.user_id, string_agg(event_type, ';' ORDER BY event_type) AS y, count(*) AS n FROM a JOIN b ON a.user_id = b.user_id AND NOT list_contains(l, event_type) GROUP BY 1)
SELECT a.user_id, CASE WHEN y IS NULL THEN x ELSE x || ';' || y END AS types, coalesce(n, 0) AS n_added FROM a LEFT JOIN c USING (user_id)
""")
def widen_lists(t: Tables):
    half = lambda cond: links.join_members(t.events.where(cond), ["user_id"], "event_type", "types")
    return links.widen_lists(half("ts < TIMESTAMP '2024-01-02'"), half("ts >= TIMESTAMP '2024-01-02'"), "user_id", "types").withColumn("n_added", F.col("n_added").cast("bigint"))


@query("""
SELECT url AS file_name, octet_length(encode(html))::bigint AS size_bytes, sha256(html) AS sha256, contains(left(html, 512), '<html') OR contains(left(html, 512), '<!DOCTYPE') AS is_challenge_page FROM pages
""")
def content_manifest(t: Tables):
    content = F.encode("html", "UTF-8")
    return t.pages.select(F.col("url").alias("file_name"), F.octet_length(content).cast("bigint").alias("size_bytes"), F.sha2(content, 256).alias("sha256"),
                          text.flag_challenge_page(content).alias("is_challenge_page"))


@query(r"""
WITH p AS (SELECT CASE WHEN regexp_matches(h, '\.com$') THEN 'com' WHEN regexp_matches(h, '\.net$') THEN 'net' ELSE 'org' END AS platform, tail FROM (
  SELECT regexp_extract(url, '^https?://([^/?#:]+)', 1) AS h, regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1) AS tail FROM pages))
SELECT platform, count(*) AS n FROM p WHERE NOT (tail IN ('', '/') OR (platform = 'net' AND NOT regexp_matches(regexp_replace(tail, '[0-9]+([/.?]|$)', ''), '[0-9]'))) GROUP BY 1
""")
def skip_homepages(t: Tables):
    # the number at the end of the path is taken off, so that some archive pages are left without a digit
    cut = F.regexp_replace("url", r"^([a-z]+://[^/?#]*[^#]*?)[0-9]+([/.?]|$|#)", "$1")
    pages = t.pages.select(cut.alias("url")).withColumn("platform", links.platform_of(F.col("url"), SITES))
    return links.skip_homepages(pages, "url", "platform", ["net"]).groupBy("platform").agg(n_rows())


_REASONS = [("error", "read timeout after retry"), ("click", "Forbidden"), ("view", ""), ("signup", "unknown extension"), ("purchase", "format cannot be determined")]


@query("""
SELECT CASE event_type WHEN 'view' THEN '0_no_dataset_linked' WHEN 'error' THEN '1_retry_transient' ELSE CASE WHEN value < 50 THEN '2_skip_not_real_data'
  WHEN event_type IN ('click', 'purchase') THEN '3_manual_check' ELSE '4_uncategorized' END END AS blocked_class, count(*) AS n FROM events GROUP BY 1
""")
def blocked_reasons(t: Tables):
    reason = case_when([(F.col("event_type") == k, F.lit(v)) for k, v in _REASONS], F.lit(""))
    files = F.when(F.col("value") < 50, F.concat(F.lit("x"), "event_id", F.lit(".fastq.gz"))).otherwise(F.concat(F.lit("t"), "event_id", F.lit(".csv")))
    blocked = t.events.select(F.col("user_id").alias("paper_id"), F.lit(1).alias("n_tables"), F.array(F.struct("event_id", files.alias("attempted_files"), reason.alias("reason"))).alias("blocked"))
    return candidates.blocked_class(candidates.explode_blocked(blocked)).groupBy("blocked_class").agg(n_rows())


@query("""
SELECT r_name AS taxon, CASE WHEN r_name = 'ASIA' THEN 'Bacteria' WHEN r_name = 'EUROPE' THEN 'Unclassified' WHEN r_name = 'AFRICA' THEN 'Fungi' ELSE 'Viruses' END AS paper_domain,
  CASE WHEN r_name = 'ASIA' THEN '16S OTU' WHEN r_name = 'EUROPE' THEN 'bacteria, fungi and viruses' WHEN r_name = 'AFRICA' THEN 'ITS1 amplicon;  no viral taxa' ELSE 'vOTU table' END AS clauses, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def clauses_and_taxa(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    r = F.col("r_name")
    note = case_when([(r == "ASIA", F.lit("16S OTU; ITS fungal OTUs kept separately")), (r == "EUROPE", F.lit("bacteria, fungi and viruses")),
                      (r == "AFRICA", F.lit("ITS1 amplicon| no viral taxa"))], F.lit("vOTU table;bacteria not merged"))
    return joined.groupBy(taxa.clean_taxon(F.concat(F.lit("k__"), r, F.lit("(99)"))).alias("taxon"), taxa.paper_domain(note).alias("paper_domain"),
                          taxa.drop_clauses(note).alias("clauses")).agg(n_rows())


@query("""
SELECT CASE event_type WHEN 'view' THEN 'Control / healthy' WHEN 'click' THEN 'Not reported' WHEN 'signup' THEN 'Case / disease' WHEN 'purchase' THEN 'Not applicable (environmental / no disease design)'
  ELSE 'Other label' END AS disease_class, count(*) AS n FROM events GROUP BY 1
""")
def status_words(t: Tables):
    word = case_when([(F.col("event_type") == k, F.lit(v)) for k, v in [
        ("view", "not labelled ASD (0CTRL)"), ("click", "Not labelled"), ("signup", "CRC patient"), ("purchase", "n/a")]], F.col("event_type").cast("string"))
    return t.events.groupBy(taxa.disease_bucket(word).alias("disease_class")).agg(n_rows())


@query("""
SELECT CASE p_type WHEN 'PROMO' THEN 'prokaryote' WHEN 'SMALL' THEN 'prokaryote' WHEN 'LARGE' THEN 'virus' ELSE 'unknown' END AS domain,
  CASE p_type WHEN 'PROMO' THEN 'matched prokaryote pattern ''Bacteria''' WHEN 'SMALL' THEN 'matched prokaryote pattern ''Bacteroides''' WHEN 'LARGE' THEN 'matched virus pattern ''phage'''
    ELSE 'no virus or prokaryote keyword matched' END AS evidence,
  CASE WHEN p_name LIKE 'hot%' THEN 'blank_or_control' ELSE '' END AS control, CASE WHEN p_name LIKE '%ring' THEN '16S' WHEN p_name LIKE '%bolt' THEN 'WGS' ELSE '' END AS assay, count(*) AS n FROM part GROUP BY ALL
""")
def evidence_flags(t: Tables):
    name = case_when([(F.col("p_type") == k, v) for k, v in [
        ("PROMO", F.concat(F.lit("d__Bacteria;p__"), "p_name")), ("SMALL", F.lit("Bacteroides_fragilis")), ("LARGE", F.lit("crAss phage")), ("ECONOMY", F.lit("Patescibacteria"))]],
        F.concat(F.lit("OTU_"), "p_partkey"))
    sample = F.when(F.startswith("p_name", F.lit("hot")), F.concat(F.lit("NTC"), "p_partkey")).otherwise(F.concat(F.lit("S"), "p_partkey"))
    file = F.when(F.endswith("p_name", F.lit("ring")), "x_16s.csv").when(F.endswith("p_name", F.lit("bolt")), "wgs.tsv").otherwise("t.csv")
    d, f = taxa.table_domain(name), taxa.sample_flags(sample, file)
    return t.part.groupBy(d["domain"].alias("domain"), d["evidence"].alias("evidence"), f["control"].alias("control"), f["assay"].alias("assay")).agg(n_rows())


@query("""
WITH o AS (SELECT o_orderkey + 1000 AS k, o_orderstatus = 'F' AS ctx, left(o_orderpriority, 1) AS p FROM orders),
a AS (SELECT CASE p WHEN '1' THEN CASE WHEN ctx THEN 'NCBI SRA' END WHEN '2' THEN 'ENA' WHEN '3' THEN 'DDBJ DRA' WHEN '4' THEN 'NGDC GSA' ELSE 'NCBI SRA' END AS platform,
  CASE p WHEN '1' THEN 'bioproject' WHEN '2' THEN 'bioproject' WHEN '3' THEN 'sra_run' WHEN '4' THEN 'gsa' ELSE 'sra_study' END AS repository,
  CASE p WHEN '1' THEN CASE WHEN ctx THEN 'https://www.ncbi.nlm.nih.gov/bioproject/PRJNA' || k || '/' END WHEN '2' THEN 'https://www.ebi.ac.uk/ena/browser/view/PRJEB' || k
    WHEN '3' THEN 'https://ddbj.nig.ac.jp/resource/sra-run/DRR' || (k + 100000) WHEN '4' THEN 'https://ngdc.cncb.ac.cn/gsa/browse/CRA' || k ELSE 'https://www.ncbi.nlm.nih.gov/sra?term=SRP' || (k + 100000) END AS link FROM o)
SELECT repository, platform, count(*) AS n, min(link) AS first_link, max(link) AS last_link FROM a GROUP BY ALL
""")
def archive_of(t: Tables):
    k = F.col("o_orderkey") + 1000
    p = F.substring("o_orderpriority", 1, 1)
    acc = case_when([(p == "1", F.concat(F.lit("PRJNA"), k)), (p == "2", F.concat(F.lit("prjeb"), k)), (p == "3", F.concat(F.lit("DRR"), k + 100000)), (p == "4", F.concat(F.lit("CRA"), k))],
                    F.concat(F.lit("SRP"), k + 100000))
    note = F.concat(F.when(F.col("o_orderstatus") == "F", "Reads are in the SRA under ").otherwise("See "), acc, F.lit("."))
    sentences = t.orders.select("o_orderkey", note.alias("note"))
    mined = links.mine_accessions(sentences, "o_orderkey", "note", keep=["note"], unique_keys=True)
    a = links.archive_of(F.col("accession"), F.col("note"))
    return mined.select("repository", a["platform"].alias("platform"), a["link"].alias("link")).groupBy("repository", "platform").agg(
        n_rows(), F.min("link").alias("first_link"), F.max("link").alias("last_link"))


@query("""
WITH p AS (SELECT CASE p_type WHEN 'PROMO' THEN 'AMPLICON' WHEN 'SMALL' THEN 'RNA-Seq' ELSE 'WGS' END AS s,
  CASE WHEN p_size < 10 THEN 'METAGENOMIC' WHEN p_size < 20 THEN 'GENOMIC' WHEN p_size < 30 THEN 'VIRAL RNA' WHEN p_size < 40 THEN 'METATRANSCRIPTOMIC' ELSE 'OTHER' END AS src,
  CASE WHEN p_name LIKE 'old%' THEN 'size fractionation' ELSE '' END AS sel FROM part)
SELECT CASE WHEN s = 'AMPLICON' THEN 'amplicon' WHEN s = 'RNA-Seq' OR src IN ('VIRAL RNA', 'METATRANSCRIPTOMIC') THEN 'rna' WHEN sel <> '' THEN 'dna_virome' WHEN src = 'METAGENOMIC' THEN 'dna_shotgun'
   WHEN src = 'GENOMIC' THEN 'unsupported_isolate_genome' ELSE 'unresolved' END AS branch,
  CASE WHEN s = 'AMPLICON' THEN 'bacterial/archaeal 16S abundance' WHEN src = 'METATRANSCRIPTOMIC' THEN 'expressed taxa / RNA viruses' WHEN s = 'WGS' AND src = 'METAGENOMIC' THEN 'bacterial + viral abundance from DNA shotgun'
   ELSE 'unknown' END AS usable_for, count(*) AS n FROM p GROUP BY ALL
""")
def assay_branch(t: Tables):
    s = case_when([(F.col("p_type") == "PROMO", F.lit("AMPLICON")), (F.col("p_type") == "SMALL", F.lit("RNA-Seq"))], F.lit("WGS"))
    size = F.col("p_size")
    src = case_when([(size < 10, F.lit("METAGENOMIC")), (size < 20, F.lit("GENOMIC")), (size < 30, F.lit("VIRAL RNA")), (size < 40, F.lit("METATRANSCRIPTOMIC"))], F.lit("OTHER"))
    sel = F.when(F.startswith("p_name", F.lit("old")), "size fractionation")
    return t.part.groupBy(taxa.branch_of(s, src, sel)["branch"].alias("branch"), taxa.targets_of(s, src, F.lit("16S V4"))["usable_for"].alias("usable_for")).agg(n_rows())


@query("""
SELECT r_name IN ('ASIA', 'EUROPE') AND (contains(n_name, 'NATION_1') OR contains(n_name, 'NATION_2')) AS in_scope,
  concat_ws('; ', CASE WHEN c_mktsegment = 'BUILDING' THEN 'amplicon status not verified or measured' END, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'reads and facts name different regions' END,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'primers_in_reads disagrees with the reads' END, CASE WHEN c_acctbal < 0 THEN 'sample identity not checked' END,
    CASE WHEN c_acctbal > 9000 THEN 'usable_for is empty' END) AS problems, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def facts_scope(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    facts = {
        "amplicon_status": F.when(seg == "BUILDING", "guessed").otherwise("verified"), "declared_region": F.when(seg == "FURNITURE", "ITS1").otherwise("16S_V4"),
        "primers_in_reads": seg != "MACHINERY", "identity_status": F.when(bal >= 0, "partial"), "usable_for": F.when(bal <= 9000, "abundance").otherwise(""),
    }
    in_scope = taxa.scope_match(F.lit("asia|europe ; nation_1|nation_2"), F.concat_ws(" ", "r_name", "n_name"))
    problems = reads.facts_problems(facts, F.lit("primer_like_16S_V4"), F.lit(True))
    return joined.groupBy(in_scope.alias("in_scope"), problems.alias("problems")).agg(n_rows())


@query(r"""
SELECT page_id, regexp_replace(lower(url), '^https?://blog\.', '') AS id, regexp_replace(url, '[^A-Za-z0-9_]+', '_', 'g') AS safe, left(url, 20) AS clipped,
  CASE WHEN contains(url, '_1.') THEN 'R1' WHEN contains(url, '_2.') THEN 'R2' ELSE 'single' END AS mate FROM pages
""")
def identifier_text(t: Tables):
    url = F.col("url")
    as_doi = F.regexp_replace(url, r"^https?://blog\.", "https://doi.org/")
    return t.pages.select("page_id", text.normalize_id(as_doi).alias("id"), text.safe_name(url).alias("safe"), text.clip(url, 20).alias("clipped"), text.mate_of(url).alias("mate"))


@query("""
WITH p AS (SELECT p_partkey, regexp_replace(upper(p_name), '[^ACGTRYSWKMBVDHN]', 'N', 'g') AS s FROM part)
SELECT p_partkey, translate(reverse(s), 'ACGTRYSWKMBVDHN', 'TGCAYRSWMKVBHDN') AS rc,
  (SELECT coalesce(min(i), -1) FROM (SELECT unnest(range(0, length(s) - 2)) AS i)
   WHERE (substr(s, i + 1, 1) <> 'A')::int + (substr(s, i + 2, 1) NOT IN ('A', 'C', 'G', 'T'))::int + (substr(s, i + 3, 1) <> 'G')::int <= 1)::bigint AS at FROM p
""")
def revcomp(t: Tables):
    letters = F.regexp_replace(F.upper("p_name"), "[^ACGTRYSWKMBVDHN]", "N")
    return t.part.select("p_partkey", bases.revcomp(F.upper("p_name")).alias("rc"), bases.find_approx(letters, "ANG", 1).cast("bigint").alias("at"))
