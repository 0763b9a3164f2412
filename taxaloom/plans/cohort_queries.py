"""Queries over orders, customers, events and documents: catalogues, ledgers, samples, partitions, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import taxa
from ..functions.rules import case_when
from ..operators import candidates, ledger, metadata, ordering, reshape, stats, viral
from ..sources.readers import explode_parallel
from .catalog import Tables, n_rows, query


def _day():
    return F.to_date("ts").alias("day")


# ---------------------------------------------------------------------------
# statistics and catalogues
# ---------------------------------------------------------------------------
@query("""
WITH s AS (SELECT user_id, ts::date AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
p AS (SELECT user_id, day, count(*) AS n_subjects_distinct, bool_or(n > 1) AS is_longitudinal FROM s GROUP BY ALL)
SELECT n_subjects_distinct, is_longitudinal, count(*) AS n FROM p GROUP BY ALL
""")
def longitudinal(t: Tables):
    per = stats.repeats_of(t.events.select("user_id", _day(), "event_type"), ["user_id", "day"], "event_type")
    return per.groupBy("n_subjects_distinct", "is_longitudinal").agg(n_rows())


@query("SELECT p_brand, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def taxon_catalogue(t: Tables):
    sold = t.lineitem.select("l_partkey", "l_suppkey").distinct().join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return stats.taxon_catalogue(sold, ["p_brand"], "l_suppkey", "n_suppliers")


@query("""
WITH p AS (SELECT source, count(*) AS t, count(quality) AS q, coalesce(sum(toxic), 0) AS x, count(*) FILTER (n_chars > 2000) AS l FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1),
u AS (SELECT 'quality' AS field, q AS n, t FROM p UNION ALL SELECT 'toxic', x, t FROM p UNION ALL SELECT 'long', l, t FROM p)
SELECT field, count(*) FILTER (n > 0) AS n_papers_with_any, round(count(*) FILTER (n > 0) / count(*), 6) AS share_of_papers, sum(n)::bigint AS n_samples_with_value,
  round(sum(n) / sum(t), 6) AS share_of_samples FROM u GROUP BY 1
""")
def completeness(t: Tables):
    docs = t.documents.select("doc_id", "source", "n_chars").join(t.labels, "doc_id", "left")
    per = docs.groupBy("source").agg(n_rows("n_samples"), F.count("quality").alias("q"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("x"), F.count_if(F.col("n_chars") > 2000).alias("l"))
    out = stats.completeness(per, {"quality": "q", "toxic": "x", "long": "l"})
    return out.withColumns({c: F.round(c, 6) for c in ("share_of_papers", "share_of_samples")})


@query("""
SELECT 'orders' AS metric, count(*)::double AS value FROM orders UNION ALL SELECT 'total price', round(sum(o_totalprice), 2) FROM orders
UNION ALL SELECT 'largest order', max(o_totalprice) FROM orders UNION ALL SELECT 'open orders', count(*) FILTER (o_orderstatus = 'O') FROM orders
UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'median price', median(o_totalprice) FROM orders
""")
def headline(t: Tables):
    price = F.col("o_totalprice")
    head = stats.metrics(t.orders, {
        "orders": F.count(F.lit(1)), "total price": F.round(F.sum(price), 2), "largest order": F.max(price), "open orders": F.count_if(F.col("o_orderstatus") == "O"),
        "customers": F.count_distinct("o_custkey")})
    median = stats.median_of(t.orders, [], "o_totalprice").select(F.lit("median price").alias("metric"), F.col("median").alias("value"))
    return head.unionByName(median)


@query("""
SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n,
  row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, min(o_orderkey)) AS r FROM orders GROUP BY 1, 2) WHERE r = 1
""")
def dominant_value(t: Tables):
    return ordering.dominant(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderkey"])


@query("""
WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, l_suppkey) AS r FROM c)
SELECT l_suppkey::varchar AS label, n FROM r WHERE r <= 5 UNION ALL SELECT 'Other (' || count(*) || ' categories)', sum(n)::bigint FROM r WHERE r > 5 HAVING count(*) > 0
""")
def top_k_fold(t: Tables):
    counted = t.lineitem.groupBy("l_suppkey").agg(n_rows()).select(F.col("l_suppkey").cast("string").alias("name"), "l_suppkey", "n")
    return ordering.top_k_fold(counted, "name", "n", 5, order="l_suppkey")


@query("""
WITH RECURSIVE r AS (SELECT c_custkey, c_mktsegment AS b, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS m FROM customer),
s AS (SELECT c_custkey, b, m, '' AS suffix FROM r UNION ALL SELECT c_custkey, b, (m - 1) // 26, chr((97 + (m - 1) % 26)::int) || suffix FROM s WHERE m > 0)
SELECT c_custkey, b || suffix AS unique_name FROM s WHERE m = 0
""")
def unique_names(t: Tables):
    return ordering.unique_names(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey").select("c_custkey", "unique_name")


@query("""
WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS k, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderstatus, o_orderkey FROM r WHERE k IN (SELECT round_even(i * (n - 1) / 5.0, 0) FROM (SELECT unnest(range(0, 6)) AS i))
""")
def systematic_sample(t: Tables):
    return ordering.systematic_sample(t.orders.select("o_orderstatus", "o_orderkey"), 6, ["o_orderstatus"], "o_orderkey")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def last_state(t: Tables):
    return ordering.last_state(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""
WITH l AS (SELECT lang, source, md5(text) AS a, n_chars::varchar AS b, doc_id::varchar AS c FROM documents),
g AS (SELECT lang, source, count(*) AS n, count(DISTINCT a) AS na, count(DISTINCT b) AS nb FROM l GROUP BY ALL)
SELECT lang, source, CASE WHEN nb = n THEN 'n_chars' WHEN na = n THEN 'text_md5' ELSE 'doc_id' END AS handle FROM g
""")
def unique_handle(t: Tables):
    docs = t.documents.select("lang", "source", "n_chars", F.md5("text").alias("text_md5"), "doc_id")
    return metadata.pick_handle(docs, ["lang", "source"], "doc_id", ["n_chars", "text_md5", "doc_id"])


@query("""
WITH f AS (SELECT user_id, ts::date::varchar AS day, bool_or(event_type = 'error') AS e, bool_or(event_type = 'purchase') AS p, bool_or(event_type = 'signup') AS s FROM events GROUP BY ALL)
SELECT user_id, day, CASE WHEN e THEN 'error' WHEN p THEN 'purchase' ELSE 'signup' END AS "primary",
  concat_ws(';', CASE WHEN e THEN 'error' END, CASE WHEN p THEN 'purchase' END, CASE WHEN s THEN 'signup' END) AS all_labels FROM f WHERE e OR p OR s
""")
def severity_pick(t: Tables):
    flagged = t.events.select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return ordering.worst_of(flagged, ["user_id", "day"], "event_type", ["error", "purchase", "signup"])


@query("""
WITH d AS (SELECT o_custkey AS k, o_orderpriority AS raw, CASE o_orderpriority WHEN '1-URGENT' THEN 'Cancer' WHEN '2-HIGH' THEN 'Cancer' WHEN '3-MEDIUM' THEN 'Malaria' WHEN '5-LOW' THEN '5-LOW' END AS d FROM orders)
SELECT d AS disease, CASE d WHEN 'Cancer' THEN 'Cancer / neoplasm' WHEN 'Malaria' THEN 'Infection' ELSE 'Other / unspecified' END AS category, count(*) AS n_samples, count(DISTINCT k) AS n_papers,
  string_agg(DISTINCT raw, ' | ' ORDER BY raw) AS raw_variants_merged, round(count(*) / sum(count(*)) OVER (), 6) AS share_of_disease_samples FROM d WHERE d IS NOT NULL GROUP BY d
""")
def disease_catalogue(t: Tables):
    p = F.col("o_orderpriority")
    raw = F.when(p != "4-NOT SPECIFIED", p)
    named = taxa.normalise_disease(raw, {"1-urgent": "Cancer", "2-high": "Cancer", "3-medium": "Malaria"}, [])["name"]
    samples = t.orders.select(F.col("o_custkey").alias("paper_folder"), p.alias("disease_raw"), F.nullif(named, F.lit("")).alias("disease"))
    return stats.disease_catalogue(samples).withColumn("share_of_disease_samples", F.round("share_of_disease_samples", 6))


@query("""
WITH u AS (SELECT 'name' AS field, p_name AS raw_value FROM part UNION ALL SELECT 'brand', p_brand FROM part),
c AS (SELECT field, raw_value, count(*) AS n_samples FROM u GROUP BY ALL)
SELECT field, raw_value, n_samples FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n_samples DESC, raw_value) AS r FROM c) WHERE r <= 10
""")
def unmapped_values(t: Tables):
    return stats.unmapped(t.part, {"name": "p_name", "brand": "p_brand"}, 10)


@query("SELECT coalesce(CASE WHEN toxic IS NOT NULL THEN 'toxic' END, CASE WHEN quality IS NOT NULL THEN 'quality' END, 'source') AS deepest, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def deepest_level(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return docs.groupBy(viral.deepest_of(["lang", "source", "quality", "toxic"]).alias("deepest")).agg(n_rows())


_PART_FEATURES = """
f AS (SELECT p_brand AS paper_folder, p_partkey, p_type, p_name,
  CASE p_type WHEN 'PROMO' THEN 'Bacteria' WHEN 'SMALL' THEN 'Viruses' WHEN 'LARGE' THEN 'Archaea' WHEN 'ECONOMY' THEN 'Fungi' ELSE 'Unclassified' END AS domain,
  CASE p_type WHEN 'PROMO' THEN 'kingdom column' WHEN 'SMALL' THEN 'kingdom column' WHEN 'LARGE' THEN 'lineage string' WHEN 'ECONOMY' THEN 'feature name' ELSE 'paper-level fallback' END AS evidence,
  CASE WHEN p_size < 10 THEN 'Species' WHEN p_size < 25 THEN 'OTU' ELSE 'Other / mixed' END AS row_rank,
  split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part),
l AS (SELECT paper_folder, p_partkey, 'kingdom' AS column_rank, CASE p_type WHEN 'PROMO' THEN 'Bacteria' WHEN 'SMALL' THEN 'Viruses' END AS name, 'kingdom' AS true_rank FROM f
  UNION ALL SELECT paper_folder, p_partkey, 'genus', CASE WHEN w2 = 'ring' THEN 'Ringviridae' WHEN w2 = 'rod' THEN NULL ELSE w2 END, CASE WHEN w2 = 'ring' THEN 'family' ELSE 'genus' END FROM f
  UNION ALL SELECT paper_folder, p_partkey, 'phylum', w1, 'phylum' FROM f)
"""


def _part_rows(t: Tables):
    pick = lambda pairs, other="": case_when([(F.col("p_type") == k, v) for k, v in pairs], F.lit(other))
    second = F.element_at(F.split("p_name", " "), 2)
    row = F.create_map(
        F.lit("Kingdom"), pick([("PROMO", F.lit("k__Bacteria")), ("SMALL", F.lit("Viruses(99)")), ("LARGE", F.lit("unassigned"))]),
        F.lit("host_taxonomy"), F.lit("Fungi"), F.lit("taxonomy"), pick([("LARGE", F.lit("d__Archaea;p__x"))]),
        F.lit("feature_id"), pick([("ECONOMY", F.concat(F.lit("k__Fungi_"), "p_name"))], "otu"),
        F.lit("taxonomic_rank"), F.when(F.col("p_size") < 10, "species-level").when(F.col("p_size") < 25, "97% OTU").otherwise(" "),
        F.lit("silva_genus"), F.when(second == "ring", "Ringviridae").when(second == "rod", "uncultured").otherwise(second),
        F.lit("phylum"), F.element_at(F.split("p_name", " "), 1))
    return t.part.select(F.col("p_brand").alias("paper_folder"), F.col("p_partkey").alias("row_idx"), row.alias("row"))


def _part_features(t: Tables):
    """Classified features, written once because several aggregates read them."""
    papers = t.part.select(F.col("p_brand").alias("paper_folder")).distinct().withColumn("paper_domain", F.lit("Unclassified"))
    return ordering.stored(stats.feature_domain_rows(_part_rows(t), papers).drop("row"))


def _part_lineage(t: Tables):
    return ordering.stored(stats.lineage_fill(_part_rows(t)))


@query("WITH " + _PART_FEATURES + """, e AS (SELECT paper_folder, evidence, row_number() OVER (PARTITION BY paper_folder ORDER BY count(*) DESC, min(p_partkey)) AS r FROM f GROUP BY 1, 2),
k AS (SELECT paper_folder, row_rank, row_number() OVER (PARTITION BY paper_folder ORDER BY count(*) DESC, min(p_partkey)) AS r FROM f GROUP BY 1, 2),
n AS (SELECT paper_folder, count(*) FILTER (true_rank <> column_rank) AS moved, count(DISTINCT name) FILTER (true_rank = 'phylum') AS np, count(DISTINCT name) FILTER (true_rank = 'genus') AS ng FROM l WHERE name IS NOT NULL GROUP BY 1)
SELECT f.paper_folder, count(*) AS n_feature_rows, count(*) FILTER (f.evidence <> 'paper-level fallback') AS n_with_taxonomy, count(*) FILTER (domain = 'Bacteria') AS n_features_bacteria,
  count(*) FILTER (domain = 'Archaea') AS n_features_archaea, count(*) FILTER (domain = 'Viruses') AS n_features_viruses, count(*) FILTER (domain = 'Fungi') AS n_features_fungi,
  count(*) FILTER (domain = 'Eukaryota') AS n_features_eukaryota, count(*) FILTER (domain = 'Unclassified') AS n_features_unclassified,
  any_value(moved) AS n_names_reranked, any_value(np) AS n_distinct_phyla, any_value(ng) AS n_distinct_genera, 0 AS n_distinct_species, any_value(e.evidence) AS domain_evidence, any_value(k.row_rank) AS dominant_row_rank
FROM f JOIN e ON f.paper_folder = e.paper_folder AND e.r = 1 JOIN k ON f.paper_folder = k.paper_folder AND k.r = 1 JOIN n ON f.paper_folder = n.paper_folder GROUP BY 1
""")
def feature_facts(t: Tables):
    return stats.feature_facts(_part_features(t), _part_lineage(t))


@query("WITH " + _PART_FEATURES + """, c AS (SELECT row_rank AS rank, count(*) AS n_features FROM f GROUP BY 1),
k AS (SELECT paper_folder, row_rank AS rank, row_number() OVER (PARTITION BY paper_folder ORDER BY count(*) DESC, min(p_partkey)) AS r FROM f GROUP BY 1, 2),
p AS (SELECT rank, count(*) AS n_papers_dominant FROM k WHERE r = 1 GROUP BY 1)
SELECT rank, n_features, coalesce(n_papers_dominant, 0) AS n_papers_dominant, CASE rank WHEN 'Species' THEN 7 WHEN 'OTU' THEN 9 ELSE 13 END AS position,
  round(n_features / sum(n_features) OVER (), 6) AS share_of_features, round(coalesce(n_papers_dominant, 0) / sum(n_papers_dominant) OVER (), 6) AS share_of_papers FROM c LEFT JOIN p USING (rank)
""")
def row_rank_table(t: Tables):
    features = _part_features(t)
    top = ordering.dominant(features, ["paper_folder"], "row_rank", ["row_idx"]).select("paper_folder", F.col("row_rank").alias("dominant_row_rank"))
    overview = top.withColumns({"paper_rank": F.lit("Genus"), "n_features": F.lit(1).cast("bigint")})
    out = stats.row_rank_table(overview, features)
    return out.withColumns({c: F.round(c, 6) for c in ("share_of_features", "share_of_papers")})


@query("WITH " + _PART_FEATURES + """, v AS (SELECT true_rank AS rank, count(*) AS n_features_with_value FROM l WHERE name IS NOT NULL GROUP BY 1),
c AS (SELECT column_rank AS rank, count(DISTINCT paper_folder) AS n_papers_with_column FROM l GROUP BY 1)
SELECT rank, coalesce(n_papers_with_column, 0) AS n_papers_with_column, coalesce(n_features_with_value, 0) AS n_features_with_value,
  round(coalesce(n_papers_with_column, 0) / (SELECT count(DISTINCT p_brand) FROM part), 6) AS share_of_papers, round(coalesce(n_features_with_value, 0) / (SELECT count(*) FROM part), 6) AS share_of_features
FROM c FULL JOIN v USING (rank)
""")
def lineage_depth(t: Tables):
    lineage, columns = _part_lineage(t), stats.lineage_columns(_part_rows(t))
    n_papers, n_features = stats.whole(t.part, F.count_distinct("p_brand")), stats.whole(t.part, F.count(F.lit(1)))
    out = stats.lineage_depth(lineage, columns, n_papers, n_features)
    return out.withColumns({c: F.round(c, 6) for c in ("share_of_features", "share_of_papers")})


# ---------------------------------------------------------------------------
# ledgers and sets
# ---------------------------------------------------------------------------
@query("""
WITH q AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'), r AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0)
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT k FROM q WHERE k NOT IN (SELECT k FROM r))
""")
def anti_resume(t: Tables):
    queue = ledger.status_in(t.orders, "o_orderstatus", ["P"]).select(F.col("o_custkey").alias("c_custkey"))
    return ledger.without(t.customer, [queue], t.customer.where("c_acctbal < 0"), ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'")
def idempotent_append(t: Tables):
    old, new = t.orders.where("o_orderdate < TIMESTAMP '1998-06-01'"), t.orders.where("o_orderdate > TIMESTAMP '1997-06-01'")
    return ledger.append_new(new, old, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("""
WITH a AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag <> 'R')
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, CASE WHEN b.l_partkey IS NULL THEN 'only_left' WHEN a.l_partkey IS NULL THEN 'only_right' ELSE 'both' END AS side FROM a FULL JOIN b ON a.l_partkey = b.l_partkey
""")
def set_diff_both(t: Tables):
    returned = F.col("l_returnflag") == "R"
    return ledger.compare_sets(t.lineitem.where(returned), t.lineitem.where(~returned), "l_partkey")


@query("""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'removed' ELSE 'kept' END AS side, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL
""")
def status_partition(t: Tables):
    kept, removed = ledger.reset(t.orders, F.col("o_orderstatus") == "P")
    both = kept.withColumn("side", F.lit("kept")).unionByName(removed.withColumn("side", F.lit("removed")))
    return both.groupBy("side", "o_orderstatus").agg(n_rows(), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 11 OFFSET 19")
def positional_slice(t: Tables):
    return ordering.positional_slice(t.customer.select("c_custkey", "c_name"), "20-30", "c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY c_custkey LIMIT 25")
def take_next(t: Tables):
    done = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return ordering.take_next(ledger.pending(t.customer, done, ["c_custkey"]).select("c_custkey"), 25, "c_custkey")


@query("""
WITH f AS (SELECT c_custkey, bool_or(o_orderstatus = 'F' AND o_totalprice > 400000) AS a, bool_and(o_orderstatus = 'P') AS b, bool_or(o_orderstatus = 'P' AND o_totalprice > 300000) AS c,
  bool_or(o_orderstatus = 'O') AS d FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
SELECT CASE WHEN a THEN 'completed' WHEN b THEN 'method_missing' WHEN c THEN 'failed' WHEN d THEN 'in_progress' ELSE 'in_progress' END AS level1, count(*) AS n FROM f GROUP BY 1
""")
def precedence_partition(t: Tables):
    return _level1(t).groupBy("level1").agg(n_rows())


def _level1(t: Tables):
    s, price = F.col("o_orderstatus"), F.col("o_totalprice")
    flags = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.bool_or((s == "F") & (price > 400000)).alias("completed"), F.bool_and(s == "P").alias("only_unsupported"), F.bool_or((s == "P") & (price > 300000)).alias("failed"),
        F.bool_or(s == "O").alias("in_progress"), F.lit(False).alias("method_missing"))
    return ledger.classify_level1(t.customer.select("c_custkey", "c_acctbal").join(flags, "c_custkey", "left"))


@query("SELECT count(*) AS parent_rows, count(*) AS parts_rows, round(sum(c_acctbal), 2) AS parent_c_acctbal, round(sum(c_acctbal), 2) AS parts_c_acctbal, true AS balances FROM customer")
def partition_check(t: Tables):
    # the parts are the labelled rows themselves, read once
    filed = _level1(t).where(F.col("level1").isin("completed", "method_missing", "failed", "in_progress"))
    out = ledger.check_partition(t.customer, [filed], ["c_acctbal"])
    return out.withColumns({c: F.round(c, 2) for c in ("parent_c_acctbal", "parts_c_acctbal")})


@query("""
WITH d AS (SELECT n_chars, quality IS NULL AS u, quality = 0 AS q, toxic = 1 AS x FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT 'all' AS node_id, '' AS parent_id, 'root' AS kind, count(*) AS n, sum(n_chars) AS n_chars FROM d
UNION ALL SELECT 'drop_unlabelled', 'all', 'drop', count(*), sum(n_chars) FROM d WHERE u UNION ALL SELECT 'after_unlabelled', 'all', 'keep', count(*), sum(n_chars) FROM d WHERE NOT u
UNION ALL SELECT 'drop_quality', 'after_unlabelled', 'drop', count(*), sum(n_chars) FROM d WHERE NOT u AND q UNION ALL SELECT 'after_quality', 'after_unlabelled', 'keep', count(*), sum(n_chars) FROM d WHERE NOT u AND NOT q
UNION ALL SELECT 'drop_toxic', 'after_quality', 'drop', count(*), sum(n_chars) FROM d WHERE NOT u AND NOT q AND x UNION ALL SELECT 'after_toxic', 'after_quality', 'keep', count(*), sum(n_chars) FROM d WHERE NOT u AND NOT q AND NOT x)
SELECT node_id, parent_id, kind, n, n_chars::bigint AS n_chars FROM n WHERE n > 0
""")
def filter_tree(t: Tables):
    docs = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    steps = [("unlabelled", "No label", F.col("quality").isNull()), ("quality", "Low quality", F.col("quality") == 0), ("toxic", "Toxic", F.col("toxic") == 1)]
    return stats.filter_tree(docs, steps, ["n_chars"]).drop("label")


@query("""
WITH q AS (SELECT doc_id, 'toxic' AS queue FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'low_quality' FROM labels WHERE quality = 0)
SELECT queue, count(*) AS n_papers, sum(n_chars)::bigint AS n_samples, sum(CASE WHEN lang = 'en' THEN n_chars ELSE 0 END)::bigint AS bacteria, sum(CASE WHEN lang = 'de' THEN n_chars ELSE 0 END)::bigint AS viruses,
  (SELECT count(*) FROM documents WHERE lang = 'es' OR doc_id NOT IN (SELECT doc_id FROM q)) AS n_cohort
FROM q JOIN documents USING (doc_id) WHERE lang <> 'es' GROUP BY 1
""")
def triage_cost(t: Tables):
    papers = t.documents.select(F.col("doc_id").alias("paper_folder"), F.col("n_chars").alias("n_samples"), F.col("n_chars").alias("n_features"), "lang")
    queue = lambda cond, name: t.labels.where(cond).select(F.col("doc_id").alias("paper_folder"), F.lit(name).alias("queue"))
    queues = queue("toxic = 1", "toxic").unionByName(queue("quality = 0", "low_quality"))
    rescued = papers.where("lang = 'es'").select("paper_folder")
    domain = case_when([(F.col("lang") == "en", F.lit("Bacteria")), (F.col("lang") == "de", F.lit("Viruses"))], F.lit("Fungi"))
    cost = stats.excluded_cost(papers, queues, rescued, papers.select("paper_folder", domain.alias("domain"), F.col("n_samples").alias("n")))
    kept = stats.cohort(papers, queues, rescued)
    return cost.groupBy("queue").agg(
        n_rows("n_papers"), F.sum("n_samples").alias("n_samples"), F.sum("n_features_bacteria").alias("bacteria"), F.sum("n_features_viruses").alias("viruses"),
    ).withColumn("n_cohort", stats.whole(kept, F.count(F.lit(1))))


@query("""
SELECT o_orderkey, any_value(l_partkey) AS l_partkey, any_value(l_suppkey) AS l_suppkey FROM (
  SELECT o_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) WHERE r = 1 GROUP BY 1
""")
def first_lookup(t: Tables):
    first = ordering.first_by(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey"), ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return t.orders.select("o_orderkey").join(first, "o_orderkey", "left").select("o_orderkey", "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS ordinal FROM orders")
def multi_sort(t: Tables):
    keyed = t.orders.select("o_orderkey", "o_orderpriority", (-F.col("o_totalprice")).alias("falling_price"))
    return ordering.ranked(keyed, ["o_orderpriority"], "falling_price", ["o_orderkey"]).select("o_orderkey", "ordinal")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_key(t: Tables):
    return ledger.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


_FIRST_WORDS = ["red", "blue", "hot", "cold", "large", "small"]


@query("""
SELECT CASE WHEN split_part(p_name, ' ', 1) IN ('red', 'blue', 'hot', 'cold', 'large', 'small') THEN split_part(p_name, ' ', 1) ELSE 'Not yet categorised' END AS category,
  count(DISTINCT p_name) AS n FROM part GROUP BY 1
""")
def residual_bucket(t: Tables):
    """Names filed by their first word; what no word files is a category of its own."""
    rules = {w: F.startswith("p_name", F.lit(w + " ")) for w in _FIRST_WORDS}
    return ledger.file_by(t.part, "p_name", rules).groupBy("category").agg(n_rows())


@query("""
WITH s AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS v FROM events GROUP BY ALL)
SELECT event_type AS step, CASE WHEN v < 50 THEN 'failed' WHEN v < 250 THEN 'done' ELSE 'open' END AS state, count(*) AS n FROM s GROUP BY ALL
""")
def registry_views(t: Tables):
    v = F.col("value")
    status = case_when([(v < 50, F.lit("metadata_blocked")), (v < 150, F.lit("done")), (v < 250, F.lit("done_partial")), (v < 350, F.lit("preflight_ok"))], F.lit("running"))
    book = t.events.select(F.col("user_id").alias("paper"), F.col("event_type").alias("step"), status.alias("status"), "ts", "event_id")
    return ledger.registry(book, ["paper", "step"], ["ts", "event_id"]).groupBy("step", "state").agg(n_rows())


@query("""
WITH c AS (SELECT user_id, ts::date AS day, count(*) FILTER (event_type = 'error') AS e, count(*) FILTER (event_type = 'click') AS d, count(*) FILTER (event_type <> 'error') AS f,
  count(*) FILTER (event_type = 'view') AS r FROM events GROUP BY ALL)
SELECT CASE WHEN d > 0 AND e > 0 THEN 'downloaded_with_issues' WHEN d > 0 THEN 'downloaded' WHEN e > 0 THEN 'candidate_download_failed' WHEN f > 0 AND r = f THEN 'raw_reads_only' ELSE 'no_candidate_files' END AS outcome,
  CASE WHEN e > 0 THEN 'failed' WHEN d + r > 1 THEN 'partial' ELSE 'complete' END AS download_status, count(*) AS n FROM c GROUP BY ALL
""")
def outcomes(t: Tables):
    e = lambda v: F.count_if(F.col("event_type") == v)
    c = t.events.groupBy("user_id", _day()).agg(e("error").alias("n_issues"), e("click").alias("n_downloaded"), F.count_if(F.col("event_type") != "error").alias("n_files"), e("view").alias("n_raw_read_files"))
    c = c.withColumns({"n_failed": F.col("n_issues"), "n_unresolved": F.greatest(F.col("n_downloaded") + F.col("n_raw_read_files") - 1, F.lit(0)), "n_unsupported": F.lit(0)})
    return ledger.download_status(candidates.outcome(c)).groupBy("outcome", "download_status").agg(n_rows())


_BRANCH_OF = [("view", "amplicon_16s", "done"), ("click", "viral_mapping", "done"), ("signup", "dna_shotgun_bacteria", "missing_dependencies"), ("purchase", "rna", "unsupported"), ("error", "amplicon_16s_single", "failed")]


@query("""
WITH b AS (SELECT user_id, ts::date AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
p AS (SELECT user_id, day, count(*) FILTER (event_type IN ('view', 'click', 'error')) AS ran,
  string_agg(CASE event_type WHEN 'error' THEN 'amplicon_16s_single: reported failed' WHEN 'view' THEN CASE WHEN n > 1 THEN 'amplicon_16s: matrix has ' || (n - 1) || ' rows x 0 features' END
    WHEN 'click' THEN CASE WHEN n > 1 THEN 'viral_mapping: missing ' || (n - 1) || ' files' END END, '; ' ORDER BY CASE event_type WHEN 'view' THEN 1 WHEN 'error' THEN 2 ELSE 3 END) AS problems,
  string_agg(CASE event_type WHEN 'signup' THEN 'dna_shotgun_bacteria(missing_dependencies)' WHEN 'purchase' THEN 'rna(unsupported)' END, ', ' ORDER BY event_type DESC) AS not_run FROM b GROUP BY ALL)
SELECT CASE WHEN ran = 0 OR problems IS NOT NULL THEN 'failed' WHEN not_run IS NOT NULL THEN 'done_partial' ELSE 'done' END AS status,
  CASE WHEN ran = 0 THEN 'no branch reported a result' ELSE coalesce(problems, not_run, '') END AS reason, count(*) AS n FROM p GROUP BY ALL
""")
def step_outcomes(t: Tables):
    per = t.events.groupBy("user_id", _day(), "event_type").agg(n_rows("k"))
    pick = lambda i: case_when([(F.col("event_type") == r[0], F.lit(r[i])) for r in _BRANCH_OF], F.lit(None).cast("string"))
    plan = per.select(F.concat_ws("/", "user_id", "day").alias("paper"), pick(1).alias("branch"), pick(2).alias("branch_status"),
                      F.when(F.col("event_type") == "click", F.col("k") - 1).otherwise(0).alias("n_missing_files"), (F.col("k") - 1).alias("n_rows"),
                      F.when((F.col("event_type") == "view") & (F.col("k") > 1), 1).otherwise(5).alias("n_cols"))
    plan = plan.withColumn("n_rows", F.when(F.col("n_cols") == 5, 3).otherwise(F.col("n_rows")))
    return ledger.step_outcome(plan).groupBy("status", "reason").agg(n_rows())


@query("""
WITH c AS (SELECT o_custkey, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS r, count(*) FILTER (o_orderstatus = 'P') AS d, min(o_orderpriority) AS g FROM orders GROUP BY 1),
x AS (SELECT g = '1-URGENT' AS a, r < 0.8 AS b, d > 3 AS c FROM c WHERE n > 5)
SELECT CASE WHEN a THEN 'no_grouping' WHEN b THEN 'noisy_rare_asvs' ELSE 'partial_branches' END AS "primary",
  concat_ws(';', CASE WHEN a THEN 'no_grouping' END, CASE WHEN b THEN 'noisy_rare_asvs' END, CASE WHEN c THEN 'partial_branches' END) AS all_labels, count(*) AS n FROM x WHERE a OR b OR c GROUP BY ALL
""")
def paper_risks(t: Tables):
    per = t.orders.groupBy(F.col("o_custkey").alias("paper")).agg(
        n_rows("k"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("chimera_retention"), F.count_if(F.col("o_orderstatus") == "P").alias("p"), F.min("o_orderpriority").alias("g"))
    papers = per.withColumns({
        "status": F.when(F.col("k") > 5, "done_quantification_only").otherwise("preflight_ok"), "gate": F.when(F.col("g") == "1-URGENT", "pass_quantification_only:x").otherwise("pass"),
        "grouped_supported": F.lit(True), "n_deferred": F.greatest(F.col("p") - 3, F.lit(0))})
    return ordering.worst_of(ledger.paper_risks(papers), ["paper"], "risk", ["no_grouping", "noisy_rare_asvs", "partial_branches"]).groupBy("primary", "all_labels").agg(n_rows())


@query("""
WITH b AS (SELECT DISTINCT user_id, ts::date AS day, event_type FROM events)
SELECT CASE event_type WHEN 'view' THEN '16s_paired' WHEN 'click' THEN 'viral_mapping' ELSE 'missing:rna' END AS method, count(*) AS n FROM b WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1
""")
def method_rows(t: Tables):
    pick = lambda i: case_when([(F.col("event_type") == r[0], F.lit(r[i])) for r in _BRANCH_OF], F.lit(None).cast("string"))
    plans = t.events.select(F.concat_ws("/", "user_id", _day()).alias("paper"), pick(1).alias("branch"), pick(2).alias("status"))
    return ledger.method_rows(plans).groupBy("method").agg(n_rows())


@query("""
WITH b AS (SELECT user_id, bool_or(event_type = 'signup') AS s, bool_or(event_type = 'purchase') AS p, bool_or(event_type = 'error') AS e, bool_or(event_type = 'view') AS v FROM events GROUP BY user_id, ts::date)
SELECT s::int + p::int AS n_deferred, e::int AS n_fatal, CASE WHEN e OR NOT v THEN 'blocked' ELSE 'runs' END AS verdict, count(*) AS n FROM b GROUP BY ALL
""")
def deferred_branches(t: Tables):
    has = lambda v: F.bool_or(F.col("event_type") == v)
    b = t.events.groupBy(F.concat_ws("/", "user_id", _day()).alias("paper")).agg(has("signup").alias("s"), has("purchase").alias("p"), has("error").alias("e"), has("view").alias("v"))
    branch = lambda flag, name, status: F.when(F.col(flag), F.struct(F.lit(name).alias("branch"), F.lit(status).alias("status")))
    plan = b.select("paper", F.array_compact(F.array(branch("s", "dna_shotgun", "missing_dependencies"), branch("p", "rna", "unsupported"), branch("v", "viral_mapping", "ready"))).alias("branches"),
                    F.array_compact(F.array(F.when(F.col("s"), F.lit("branch 'dna_shotgun' has no database")), F.when(F.col("p"), F.lit("branch 'rna' is not implemented")),
                                            F.when(F.col("e"), F.lit("metadata blocked")))).alias("blockers"))
    out = ledger.deferred_branches(plan)
    return out.groupBy(F.size("deferred").alias("n_deferred"), F.size("fatal").alias("n_fatal"), "verdict").agg(n_rows())


# ---------------------------------------------------------------------------
# samples, claims, gates
# ---------------------------------------------------------------------------
@query("""
WITH x AS (SELECT l.doc_id, d.lang, d.source, l.quality FROM labels l JOIN documents d USING (doc_id)),
f AS (SELECT lang AS paper, 'disease' AS field, CASE WHEN quality = 1 THEN 'high' ELSE 'default ' || lang END AS value, CASE WHEN quality = 1 THEN 'confirmed' ELSE 'inferred' END AS confidence,
        CASE WHEN quality = 1 THEN 'labels' ELSE 'title [paper-wide default]' END AS evidence FROM x
  UNION ALL SELECT lang, 'body_site', source, 'confirmed', 'source' FROM x UNION ALL SELECT lang, 'host_species', lang, 'inferred', 'title [paper-wide default]' FROM x
  UNION ALL SELECT lang, 'sex', '', 'unknown', '' FROM x)
SELECT paper, field, value, confidence, evidence, count(*) AS n FROM f GROUP BY ALL
""")
def default_merge(t: Tables):
    docs = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id")
    entry = lambda field, value, conf, ev, pos: F.struct(F.lit(field).alias("field"), value.alias("value"), F.lit(conf).alias("confidence"), F.lit(ev).alias("evidence"), F.lit(pos).alias("position"))
    own = F.array(entry("disease", F.when(F.col("quality") == 1, "high").otherwise(" "), "confirmed", "labels", 0), entry("Tissue", F.col("source"), "confirmed", "source", 1))
    claims = docs.select(F.col("lang").alias("paper"), F.col("doc_id").alias("sample"), F.inline(own))
    paper = F.array(F.struct(F.lit("disease").alias("field"), F.concat(F.lit("default "), "lang").alias("value")), F.struct(F.lit("host").alias("field"), F.col("lang").alias("value")))
    defaults = t.documents.select("lang").distinct().select(F.col("lang").alias("paper"), F.inline(paper)).withColumns({"confidence": F.lit("inferred"), "evidence": F.lit("title")})
    merged = metadata.merge_defaults(claims, defaults, ["disease", "body_site", "host_species", "sex"])
    return merged.groupBy("paper", "field", "value", "confidence", "evidence").agg(n_rows())


@query("""
WITH c AS (SELECT CASE role WHEN 'user' THEN 'paper_sample_id' WHEN 'assistant' THEN 'experimental_group' ELSE 'disease' END AS field,
  CASE WHEN role = 'system' THEN 'confidence is not a known level' WHEN role = 'assistant' AND length(text) < 40 THEN 'required field is missing' WHEN role = 'user' AND length(text) <= 100 THEN 'confirmed with no evidence'
    WHEN turn > 3 THEN 'x' END AS problem, turn FROM conversations)
SELECT field, problem, count(*) AS n FROM c WHERE problem IS NOT NULL AND problem <> 'x' GROUP BY ALL
UNION ALL SELECT '', 'sample was not expected', count(*) FROM conversations WHERE turn > 3 HAVING count(*) > 0
""")
def claims_validate(t: Tables):
    r, size = F.col("role"), F.length("text")
    resolved = t.conversations.select(
        F.col("conv_id").alias("paper"), F.col("turn").alias("sample"), case_when([(r == "user", F.lit("paper_sample_id")), (r == "assistant", F.lit("experimental_group"))], F.lit("disease")).alias("field"),
        F.col("text").alias("value"), case_when([(r == "user", F.lit("confirmed")), (r == "assistant", F.lit("inferred"))], F.lit("guess")).alias("confidence"),
        F.when(size > 100, "text").otherwise("").alias("evidence"), (~((r == "assistant") & (size < 40))).alias("is_given"))
    expected = t.conversations.where("turn <= 3").select(F.col("conv_id").alias("paper"), F.col("turn").alias("sample"))
    return metadata.validate_claims(resolved, expected).groupBy("field", "problem").agg(n_rows())


@query("""
SELECT doc_id AS sample, CASE WHEN quality = 1 THEN '1' ELSE 'unresolved' END AS disease, 'unresolved' AS treatment,
  CASE WHEN quality = 1 THEN '{"treatment":{"value":"' || toxic || '","confidence":"inferred","evidence":""}}'
       ELSE '{"disease":{"value":"0","confidence":"inferred","evidence":"labels"},"treatment":{"value":"' || toxic || '","confidence":"inferred","evidence":""}}' END AS proposed_values,
  'disease=' || CASE WHEN quality = 1 THEN 'confirmed' ELSE 'inferred' END || ';treatment=inferred' AS metadata_confidence, CASE WHEN quality = 1 THEN 'disease: labels' ELSE '' END AS metadata_evidence FROM labels
""")
def claims_columns(t: Tables):
    one = lambda field, value, conf, ev: F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), conf.alias("confidence"), F.lit(ev).alias("evidence"))
    claims = t.labels.select(F.lit("p").alias("paper"), F.col("doc_id").alias("sample"), F.inline(F.array(
        one("disease", F.col("quality"), F.when(F.col("quality") == 1, "confirmed").otherwise("inferred"), "labels"), one("treatment", F.col("toxic"), F.lit("inferred"), ""))))
    return reshape.claims_to_columns(claims, ["disease", "treatment"]).drop("paper")


@query("""
WITH s AS (SELECT o_custkey, o_orderdate::date::varchar AS label, o_orderpriority <> '4-NOT SPECIFIED' AS grp, o_totalprice > 20000 AS own FROM orders WHERE o_orderstatus <> 'P'),
g AS (SELECT o_custkey, count(*) AS n, count(*) - count(DISTINCT label) AS rep, count(*) FILTER (grp) AS ng, count(*) FILTER (own) AS ni FROM s GROUP BY 1),
b AS (SELECT o_custkey, count(*) FILTER (o_totalprice < 2000) AS nb FROM orders GROUP BY 1)
SELECT CASE WHEN nb > 0 OR rep > 0 THEN 'blocked' WHEN ng < n THEN 'pass_quantification_only' ELSE 'pass' END AS gate,
  CASE WHEN nb > 0 THEN nb || ' blocking problem(s)' WHEN rep > 0 THEN '0 sample(s) without a name, ' || rep || ' name(s) repeated'
    WHEN ng < n THEN concat_ws('; ', 'group label confirmed for only ' || ng || ' of ' || n || ' samples', CASE WHEN ni < n THEN 'own sample id confirmed for only ' || ni || ' of ' || n END) ELSE '' END AS gate_reason,
  count(*) AS n FROM g JOIN b USING (o_custkey) GROUP BY ALL
""")
def gate_verdict(t: Tables):
    samples = t.orders.select(
        F.col("o_custkey").alias("paper"), (F.col("o_orderstatus") == "P").alias("is_technical_control"), F.to_date("o_orderdate").cast("string").alias("sample_label"),
        F.when(F.col("o_totalprice") > 20000, F.col("o_orderkey").cast("string")).otherwise("unresolved").alias("paper_sample_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).otherwise("not_reported").alias("experimental_group"))
    blockers = t.orders.groupBy(F.col("o_custkey").alias("paper")).agg(F.count_if(F.col("o_totalprice") < 2000).alias("n_blockers"))
    facts = metadata.gate_facts(samples).join(blockers, "paper").withColumns({"n_missing_facts": F.lit(0), "facts_confidence": F.lit("confirmed")})
    return metadata.metadata_gate(facts).groupBy("gate", "gate_reason").agg(n_rows())


@query("""
WITH r AS (SELECT conv_id, role, count(*) AS n, count(*) FILTER (length(text) > 60) AS d FROM conversations GROUP BY ALL),
s AS (SELECT conv_id, count(*) AS n_runs, sum(n)::bigint AS n_files, sum(d)::bigint AS n_on_disk, bool_and(n = 2) AS pairs, bool_or(role = 'system') AS sys, bool_or(role = 'assistant') AS asst FROM r GROUP BY 1)
SELECT conv_id AS sample, n_runs, n_files, n_on_disk, 'PAIRED' AS library_layout, CASE WHEN pairs THEN 'complete' ELSE 'INCOMPLETE' END AS pairing_status,
  CASE WHEN n_files = n_on_disk THEN 'complete' ELSE 'INCOMPLETE' END AS download_status,
  concat_ws('; ', CASE WHEN n_runs > 1 THEN 'several runs for one sample' END, CASE WHEN NOT asst THEN 'isolation source not given' END) AS open_questions FROM s
""")
def pair_completeness(t: Tables):
    files = t.conversations.select(F.col("conv_id").alias("sample"), F.concat_ws("/", "conv_id", "role").alias("run"), F.col("turn").alias("file"), (F.length("text") > 60).alias("on_disk"), "role")
    runs = files.select("run", "role").distinct().select("run", F.lit("paired").alias("library_layout"), F.when(F.col("role") == "assistant", "gut").otherwise("missing").alias("isolation_source"))
    return metadata.sample_inventory(files, runs)


@query("""
WITH r AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL), s AS (SELECT conv_id, count(*) AS n_runs, bool_and(n = 2) AS pairs, min(role) AS first FROM r GROUP BY 1)
SELECT conv_id AS sample, n_runs, 'PAIRED' AS library_layout, CASE WHEN first = 'assistant' THEN 'dna_shotgun' ELSE 'unresolved' END AS branch,
  CASE WHEN n_runs = 1 THEN 'single_run' ELSE 'MULTIPLE_EXPERIMENTS_do_not_merge_without_review' END AS multi_run_handling,
  concat_ws('; ', CASE WHEN NOT pairs THEN 'paired library with files missing' END, CASE WHEN n_runs > 1 THEN 'runs across several experiments' END, CASE WHEN first <> 'assistant' THEN 'assay unresolved' END) AS blockers FROM s
""")
def run_to_sample(t: Tables):
    files = t.conversations.select(
        F.col("conv_id").alias("sample"), F.concat_ws("/", "conv_id", "role").alias("run"), F.col("role").alias("experiment"), F.lit("PAIRED").alias("library_layout"),
        F.when(F.col("role") == "assistant", "dna_shotgun").otherwise("unresolved").alias("branch"))
    return metadata.run_to_sample(files)


@query("""
SELECT concat_ws('; ', CASE WHEN s_acctbal < 0 THEN 'flagged as technical control (nation ' || s_nationkey || ')' END, CASE WHEN s_name LIKE 'Supplier#00000001%' OR s_name LIKE 'Supplier#00000000%' THEN 'alias prefix listed for exclusion' END) AS excluded_because,
  count(*) AS n FROM supplier GROUP BY 1
""")
def split_controls(t: Tables):
    kept, dropped = metadata.split_controls(t.supplier, "s_name", F.col("s_acctbal") < 0, ["Supplier#00000001", "Supplier#00000000"], F.concat(F.lit("nation "), "s_nationkey"))
    return dropped.unionByName(kept.withColumn("excluded_because", F.lit(""))).groupBy("excluded_because").agg(n_rows())


@query("SELECT event_type, count(*) AS n, sum((props->>'k')::bigint)::bigint AS k, max('{\"k\":' || (props->>'k') || '}') AS last_json FROM events GROUP BY 1")
def json_props(t: Tables):
    parsed = F.from_json("props", "k bigint")
    return t.events.select("event_type", parsed.alias("p")).groupBy("event_type").agg(n_rows(), F.sum("p.k").alias("k"), F.max(F.to_json("p")).alias("last_json"))


@query("""
WITH u AS (SELECT 0 AS position, 'quantity' AS name, l_quantity AS v FROM lineitem UNION ALL SELECT 1, 'discount', l_discount FROM lineitem UNION ALL SELECT 2, 'tax', l_tax FROM lineitem)
SELECT position, name, count(*) AS n, round(sum(v), 2) AS total FROM u GROUP BY ALL
""")
def explode_lists(t: Tables):
    lists = t.lineitem.select(F.concat_ws(";", "l_quantity", "l_discount", "l_tax").alias("v"), F.lit("quantity;discount;tax").alias("name"))
    return explode_parallel(lists, ["v", "name"]).groupBy("position", "name").agg(n_rows(), F.round(F.sum(F.col("v").cast("double")), 2).alias("total"))


@query("""
SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, median(o_totalprice) AS median_price, max(date_diff('day', o_orderdate::date, DATE '2001-08-02')) AS oldest_days,
  format('{:,}', count(*)) AS n_text FROM orders GROUP BY 1
""")
def numbers_and_ages(t: Tables):
    base = t.orders.groupBy("o_orderstatus").agg(n_rows(), F.max(F.datediff(F.lit("2001-08-02").cast("date"), F.to_date("o_orderdate"))).alias("oldest_days"))
    med = stats.median_of(t.orders, ["o_orderstatus"], "o_totalprice").select("o_orderstatus", F.col("median").alias("median_price"))
    out = stats.with_share(base, "n").join(med, "o_orderstatus")
    return out.withColumns({"share": F.round("share", 6), "n_text": F.format_number("n", 0)})


@query("""
SELECT CASE WHEN n_nationkey IS NULL THEN 'x' ELSE n_name END AS n_name, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS seg_automobile, count(*) FILTER (c_mktsegment = 'BUILDING') AS seg_building,
  count(*) FILTER (c_mktsegment = 'FURNITURE') AS seg_furniture, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS seg_household, count(*) FILTER (c_mktsegment = 'MACHINERY') AS seg_machinery
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1
""")
def zero_filled_grid(t: Tables):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(n_rows())
    hits = t.nation.join(counts, "n_nationkey", "left")
    grid = reshape.zero_filled(hits, "n_name", "c_mktsegment", "n", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "seg_{}")
    return grid.toDF(*[c.lower() for c in grid.columns])
