"""Queries over cells, matrices and reads: table verdicts, reshaping, coverage, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import case_when
from ..operators import candidates, cells, coverage, ordering, reads, reshape, viral
from ..operators.ordering import scratch
from ..sources import writers
from .catalog import Tables, n_rows, query

# ---------------------------------------------------------------------------
# several given tables, and abundance-shaped tables derived from them, as one cell table
# ---------------------------------------------------------------------------
_PLAIN = {
    "part": ("p_partkey", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
    "nation": ("n_nationkey", ["n_nationkey", "n_name", "n_regionkey"]),
    "customer": ("c_custkey", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    "orders": ("o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]),
    "documents": ("doc_id", ["doc_id", "text", "lang", "source", "n_chars"]),
}
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _lineage(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("n_nationkey").alias("k"), F.concat(F.lit("d__"), "r_name", F.lit(";p__"), "n_name").alias("lineage"))


def _taxa_rows(t: Tables) -> DataFrame:
    """Taxa in rows: order value per nation and priority."""
    spent = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    sums = spent.groupBy(F.col("c_nationkey").alias("k")).agg(*[F.round(F.sum(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))), 2).alias(f"run {p}") for p in _PRIORITIES])
    wide = _lineage(t).join(sums, "k", "left")
    return cells.cells_of(wide, "taxa_rows", "k", ["lineage", *[f"run {p}" for p in _PRIORITIES]])


def _taxa_cols(t: Tables) -> DataFrame:
    """Taxa in columns: share of a segment's customers per nation."""
    seg = F.array_position(F.array(*[F.lit(s) for s in _SEGMENTS]), F.col("c_mktsegment"))
    counts = t.customer.groupBy("c_mktsegment", F.col("c_nationkey").alias("k")).agg(n_rows())
    shares = coverage.relative_abundance(counts, ["c_mktsegment"], "n", name="v").join(_lineage(t), "k")
    body = shares.select(F.lit("taxa_cols").alias("table_id"), seg.alias("row_idx"), (F.col("k") + 1).alias("col_idx"), F.col("lineage").alias("col_name"), F.col("v").cast("string").alias("value"))
    first = t.customer.select("c_mktsegment").distinct().select(
        F.lit("taxa_cols").alias("table_id"), seg.alias("row_idx"), F.lit(0).alias("col_idx"), F.lit("segment").alias("col_name"), F.col("c_mktsegment").alias("value"))
    return first.unionByName(body)


def _all_cells(t: Tables) -> DataFrame:
    out = _taxa_rows(t).unionByName(_taxa_cols(t))
    for name, (row, columns) in _PLAIN.items():
        out = out.unionByName(cells.cells_of(getattr(t, name), name, row, columns))
    long_form = t.part.select("p_partkey", F.col("p_brand").alias("sample"), F.col("p_type").alias("taxon"), F.col("p_size").alias("count"))
    bare = t.supplier.select("s_suppkey", F.concat(F.lit("TAX"), "s_nationkey").alias("id"), F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("b"), F.col("s_nationkey").alias("c"))
    out = out.unionByName(cells.cells_of(long_form, "long_form", "p_partkey", ["sample", "taxon", "count"]))
    # judged by several aggregates, so the cells are written once and read by each of them
    return ordering.stored(out.unionByName(cells.cells_of(bare, "bare_ids", "s_suppkey", ["id", "a", "b", "c"])))


def _known_ids(t: Tables) -> DataFrame:
    """Ids a lookup table of the same deposit gives a lineage to, found by the lookup operators themselves."""
    table = _lineage(t).select("k", F.concat(F.lit("TAX"), "k").alias("id"), "lineage")
    lookup = ordering.stored(cells.cells_of(table, "lookup", "k", ["id", "lineage"]))
    return cells.id_to_lineage(lookup, cells.lookup_tables(lookup))


def _verdicts(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells, facts of their columns, verdicts."""
    found = _all_cells(t)
    facts = cells.column_facts(found)
    ids = _known_ids(t).select(F.lit("bare_ids").alias("table_id"), "taxon_id")
    # one row per table, read by every later step
    return found, facts, ordering.stored(cells.sniff(found, ids, facts=facts))


_NUM = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def _plain_sql(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}', {_PLAIN[n][0]}::bigint, {i}, '{c}', {c}::varchar FROM {n}" for n in names for i, c in enumerate(_PLAIN[n][1]))


_CELLS_SQL = f"""
lin AS (SELECT n_nationkey AS k, 'd__' || r_name || ';p__' || n_name AS lineage FROM nation JOIN region ON n_regionkey = r_regionkey),
spent AS (SELECT c_nationkey AS k, o_orderpriority AS p, round(sum(o_totalprice), 2) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
seg AS (SELECT c_mktsegment AS s, c_nationkey AS k, count(*) AS n FROM customer GROUP BY ALL),
cells(table_id, row_idx, col_idx, col_name, value) AS (
SELECT 'taxa_rows', k::bigint, 0, 'lineage', lineage FROM lin
{' '.join(f"UNION ALL SELECT 'taxa_rows', lin.k, {i + 1}, 'run {p}', v::varchar FROM lin LEFT JOIN spent ON lin.k = spent.k AND p = '{p}'" for i, p in enumerate(_PRIORITIES))}
UNION ALL SELECT DISTINCT 'taxa_cols', list_position({_SEGMENTS}, s), 0, 'segment', s FROM seg
UNION ALL SELECT 'taxa_cols', list_position({_SEGMENTS}, s), k + 1, lineage, (n / sum(n) OVER (PARTITION BY s))::varchar FROM seg JOIN lin USING (k)
UNION ALL SELECT 'long_form', p_partkey, 0, 'sample', p_brand FROM part UNION ALL SELECT 'long_form', p_partkey, 1, 'taxon', p_type FROM part UNION ALL SELECT 'long_form', p_partkey, 2, 'count', p_size::varchar FROM part
UNION ALL SELECT 'bare_ids', s_suppkey, 0, 'id', 'TAX' || s_nationkey FROM supplier UNION ALL SELECT 'bare_ids', s_suppkey, 1, 'a', s_suppkey::varchar FROM supplier
UNION ALL SELECT 'bare_ids', s_suppkey, 2, 'b', s_acctbal::varchar FROM supplier UNION ALL SELECT 'bare_ids', s_suppkey, 3, 'c', s_nationkey::varchar FROM supplier
UNION ALL {_plain_sql(list(_PLAIN))})
"""
_TAXON = "'(?i)" + V.TAXON_TEXT.replace("'", "''") + "'"
_RANK_LIST = "(" + ", ".join(f"'{r}'" for r in V.RANK_HEADERS) + ")"


@query(f"""
WITH {_CELLS_SQL},
sizes AS (SELECT table_id, count(DISTINCT row_idx) AS n_rows, count(DISTINCT row_idx) FILTER (value IS NOT NULL) AS filled, max(col_idx) + 1 AS n_cols FROM cells GROUP BY 1),
cols AS (SELECT table_id, col_idx, col_name, count(value) AS nf, count(*) FILTER (regexp_matches(trim(value), {_NUM})) AS nn FROM cells GROUP BY ALL HAVING count(value) > 0),
c2 AS (SELECT cols.*, nn / filled > 0.8 AS num FROM cols JOIN sizes USING (table_id)),
head AS (SELECT table_id, bool_or(lower(trim(col_name)) IN {_RANK_LIST}) AS tax, bool_or(regexp_matches(col_name, '(?i){V.ABUNDANCE_HEADER}')) AS ab, bool_or(regexp_matches(col_name, '(?i){V.SAMPLE_HEADER}')) AS sa,
  count(*) FILTER (num) AS nnum, avg(regexp_matches(col_name, {_TAXON})::int) AS cb FROM c2 GROUP BY 1),
lab AS (SELECT *, col_idx AS place FROM c2 WHERE NOT num),
firsts AS (SELECT cells.*, place FROM cells JOIN lab USING (table_id, col_idx) WHERE trim(cells.value) <> ''),
sc AS (SELECT table_id, col_idx, any_value(col_name) AS col_name, any_value(place) AS place, avg(regexp_matches(trim(value), {_TAXON})::int) AS f, avg((table_id = 'bare_ids' AND value LIKE 'TAX%')::int) AS idf,
  coalesce(avg(regexp_matches(value, '(?i){V.READ_FILE_NAME}')::int) > 0.5 OR avg(regexp_matches(value, '[/\\\\].*[/\\\\]')::int) > 0.5, false) AS path FROM firsts GROUP BY 1, 2),
best AS (SELECT table_id, max(f) AS rb, arg_max(col_name, (f, -place)) AS rcol, max(idf) AS idr, arg_max(col_name, (idf, -place)) AS idcol FROM sc WHERE NOT path GROUP BY 1),
v AS (SELECT s.*, tax, ab, sa, nnum, cb, coalesce(rb, 0) AS rb, rcol, coalesce(idr, 0) AS idr, idcol, greatest(coalesce(rb, 0), cb) AS frac FROM sizes s JOIN head USING (table_id) LEFT JOIN best USING (table_id)),
w AS (SELECT *, frac < 0.5 AND idr > frac AS rescued, n_rows < 5 OR n_cols < 2 AS small, tax AND ab AND sa AND n_rows >= 10 AS longf, nnum < 3 AS few FROM v),
x AS (SELECT *, CASE WHEN rescued OR rb >= cb THEN 'rows' ELSE 'cols' END AS ax, CASE WHEN rescued THEN idr ELSE frac END AS sco FROM w),
nums AS (SELECT table_id, CASE WHEN ax = 'cols' THEN row_idx ELSE col_idx END AS smp, value::double AS v FROM cells JOIN c2 USING (table_id, col_idx) JOIN x USING (table_id) WHERE num AND regexp_matches(trim(value), {_NUM})),
sums AS (SELECT table_id, smp, sum(v) AS s, bool_and(abs(v - round(v)) <= 1e-8 + 1e-5 * abs(round(v))) AS wh, max(v) AS hi FROM nums GROUP BY ALL),
vt AS (SELECT table_id, CASE WHEN coalesce(median(CASE WHEN s > 0 THEN abs(s - 1) END) < 0.02, false) THEN 'relative_fraction' WHEN coalesce(median(CASE WHEN s > 0 THEN abs(s - 100) END) < 1, false) THEN 'relative_percent'
  WHEN bool_and(wh) AND max(hi) > 10 THEN 'count' ELSE 'unknown' END AS t FROM sums GROUP BY 1)
SELECT x.table_id, n_rows, n_cols, nnum AS n_numeric_cols, (NOT small AND (longf OR (NOT few AND sco >= 0.3))) AS is_abundance,
  CASE WHEN small THEN 'none' WHEN longf THEN 'long' WHEN few THEN 'none' WHEN sco >= 0.3 THEN 'wide' ELSE 'none' END AS kind,
  CASE WHEN small OR longf OR few THEN '' ELSE ax END AS axis,
  CASE WHEN small OR longf OR few THEN NULL WHEN rescued THEN idcol WHEN ax = 'rows' AND rb > 0 THEN rcol END AS label_col,
  round(CASE WHEN small THEN 0 WHEN longf THEN 0.9 WHEN few THEN 0 ELSE sco END, 6) AS score, (NOT small AND NOT longf AND NOT few AND sco >= 0.3 AND sco < 0.5) AS needs_review,
  (NOT small AND NOT longf AND NOT few AND rescued) AS id_matched_lineage,
  CASE WHEN small THEN 'too small' WHEN longf THEN 'sample/taxon/abundance columns' WHEN few THEN 'fewer than 3 numeric columns' WHEN sco >= 0.5 THEN 'looks taxonomic' WHEN sco >= 0.3 THEN 'weak taxonomic signal'
    ELSE 'no taxonomic signal' END AS reason, CASE WHEN small OR longf OR few THEN 'unknown' ELSE coalesce(t, 'unknown') END AS value_type FROM x LEFT JOIN vt ON x.table_id = vt.table_id
""")
def sniff_tables(t: Tables):
    _, _, verdicts = _verdicts(t)
    return verdicts.drop("label_idx").withColumn("score", F.round("score", 6))


@query(f"""
WITH {_CELLS_SQL}, l AS (
SELECT 'taxa_rows' AS table_id, lineage AS taxon, split_part(split_part(lineage, ';', 1), '__', 2) AS kingdom, value FROM lin JOIN cells ON cells.table_id = 'taxa_rows' AND row_idx = k AND col_idx > 0
UNION ALL SELECT 'taxa_cols', col_name, split_part(split_part(col_name, ';', 1), '__', 2), value FROM cells WHERE table_id = 'taxa_cols' AND col_idx > 0
  AND col_name IN (SELECT col_name FROM cells WHERE table_id = 'taxa_cols' GROUP BY 1 HAVING count(value) > 0.5 * (SELECT count(DISTINCT row_idx) FROM cells WHERE table_id = 'taxa_cols'))
UNION ALL SELECT 'long_form', p_type, '', p_size::varchar FROM part
UNION ALL SELECT 'bare_ids', 'TAX' || s_nationkey, '', value FROM supplier JOIN cells ON table_id = 'bare_ids' AND row_idx = s_suppkey AND col_idx > 0)
SELECT table_id, taxon, kingdom, 'unknown' AS domain, count(*) AS n, count(*) FILTER (value IS NULL) AS n_missing, round(sum(value::double), 4) AS total FROM l GROUP BY ALL
""")
def long_rows(t: Tables):
    found, facts, verdicts = _verdicts(t)
    long = reshape.to_long(found, verdicts, facts=facts)
    return long.groupBy("table_id", "taxon", "kingdom", "domain").agg(n_rows(), F.count_if("is_missing").alias("n_missing"), F.round(F.sum("value"), 4).alias("total"))


@query("""
SELECT DISTINCT 'TAX' || c_nationkey AS raw_taxon_string, 'TAX' || c_nationkey AS col_name, r_name AS kingdom, n_name AS phylum, 'from_paper_sibling_taxonomy_file' AS lineage_source, 'lookup' AS lineage_source_file
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def lookup_detect(t: Tables):
    lookup = _known_ids(t).select(F.lit("d").alias("dataset_id"), "taxon_id", "lineage", F.lit("lookup").alias("source_file"), F.lit(0).alias("file_order"))
    long = t.customer.select(F.lit("customers").alias("table_id"), F.lit("d").alias("dataset_id"), F.concat(F.lit("TAX"), "c_nationkey").alias("taxon"))
    return reshape.taxonomy_table(long, lookup).select("raw_taxon_string", "col_name", "kingdom", "phylum", "lineage_source", "lineage_source_file")


_TRIAGE = ["part", "orders", "documents"]


@query(f"""
WITH cells(table_id, row_idx, col_idx, col_name, value) AS ({_plain_sql(_TRIAGE)}),
st AS (SELECT table_id, col_idx, col_name, count(value) AS nf, count(*) FILTER (regexp_matches(trim(value), {_NUM})) AS nn, min(CASE WHEN regexp_matches(trim(value), {_NUM}) THEN value::double END) AS lo FROM cells GROUP BY ALL),
b AS (SELECT table_id, string_agg(value, chr(10)) AS body FROM cells GROUP BY 1),
h AS (SELECT table_id, string_agg(col_name, ' ' ORDER BY col_idx) AS header, count(*) FILTER (nn / nf >= 0.9) AS num, coalesce(bool_or(nn / nf >= 0.9 AND lo < 0), false) AS neg FROM st GROUP BY 1),
p AS (SELECT *, lower(concat_ws(' ', CASE table_id WHEN 'part' THEN 'OTU sizes' WHEN 'orders' THEN 'prices' ELSE 'texts' END, header, body)) AS preview FROM h JOIN b USING (table_id))
SELECT table_id, CASE WHEN regexp_matches(preview, 'number of gene hits|kegg level|brite hierarchies') THEN 'functional_summary'
  WHEN regexp_matches(preview, '\\bp[- _]?value\\b|\\badjusted p\\b|\\bpadj\\b|\\bstandard deviation\\b|\\bstandard error\\b') THEN 'statistical_summary'
  WHEN regexp_matches(preview, 'clean reads|filtered reads|q20|q30|sequencing depth') THEN 'sequencing_summary' WHEN num < 2 OR neg THEN 'needs_review'
  WHEN regexp_matches(preview, 'abundance|otu|asv|rpkm|tpm|count.matrix|taxonomic.profile') THEN 'possible_abundance' ELSE 'needs_review' END AS triage FROM p
""")
def cell_quality(t: Tables):
    found = None
    for name in _TRIAGE:
        row, columns = _PLAIN[name]
        one = cells.cells_of(getattr(t, name), name, row, columns)
        found = one if found is None else found.unionByName(one)
    names = t.spark.createDataFrame([("part", "OTU sizes"), ("orders", "prices"), ("documents", "texts")], "table_id string, name string")
    return cells.triage_tables(found, names)


@query("""
SELECT 'a' AS col_name, count(*) FILTER (o_orderpriority <> '5-LOW') AS n FROM orders UNION ALL SELECT 'c', count(*) FILTER (o_orderpriority <> '5-LOW') FROM orders
""")
def drop_empty_cells(t: Tables):
    low = F.col("o_orderpriority") == "5-LOW"
    wide = t.orders.select("o_orderkey", F.when(~low, F.col("o_orderpriority")).alias("a"), F.lit(None).cast("string").alias("b"), F.when(~low, F.col("o_orderstatus")).alias("c"))
    return cells.drop_empty(cells.cells_of(wide, "orders", "o_orderkey", ["a", "b", "c"])).groupBy("col_name").agg(n_rows())


@query(f"""
WITH c AS (SELECT 'path' AS col_name, url AS v FROM pages UNION ALL SELECT 'file', 'r' || page_id || '_1.fastq.gz' FROM pages UNION ALL SELECT 'hash', md5(html) FROM pages)
SELECT col_name FROM c GROUP BY 1 HAVING avg(regexp_matches(v, '(?i){V.READ_FILE_NAME}')::int) > 0.5 OR avg(regexp_matches(v, '[/\\\\].*[/\\\\]')::int) > 0.5
""")
def pathlike_columns(t: Tables):
    wide = t.pages.select("page_id", F.col("url").alias("path"), F.concat(F.lit("r"), "page_id", F.lit("_1.fastq.gz")).alias("file"), F.md5("html").alias("hash"))
    found = cells.cells_of(wide, "pages", "page_id", ["path", "file", "hash"])
    names = found.select("table_id", "col_idx", "col_name").distinct()
    return cells.pathlike_columns(found).join(names, ["table_id", "col_idx"]).select("col_name")


@query("""
WITH n AS (SELECT DISTINCT p_brand, split_part(p_name, ' ', 1) || CASE WHEN p_size > 25 THEN '.1' ELSE '' END AS c FROM part)
SELECT p_brand, c AS col, CASE WHEN c LIKE '%.1' AND EXISTS (SELECT 1 FROM n m WHERE m.p_brand = n.p_brand AND m.c || '.1' = n.c) THEN replace(c, '.1', '') ELSE c END AS original_name FROM n
""")
def undedupe_names(t: Tables):
    word = F.element_at(F.split("p_name", " "), 1)
    names = t.part.select("p_brand", F.concat(word, F.when(F.col("p_size") > 25, ".1").otherwise("")).alias("col")).distinct()
    return reshape.undedupe_names(names, ["p_brand"], "col")


# ---------------------------------------------------------------------------
# pivots and matrices
# ---------------------------------------------------------------------------
@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN count(*) = 1 THEN max(l_quantity) END AS q FROM lineitem GROUP BY ALL)
SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN q END) AS line_1, max(CASE WHEN l_linenumber = 2 THEN q END) AS line_2, max(CASE WHEN l_linenumber = 3 THEN q END) AS line_3,
  max(CASE WHEN l_linenumber = 4 THEN q END) AS line_4, max(CASE WHEN l_linenumber = 5 THEN q END) AS line_5, max(CASE WHEN l_linenumber = 6 THEN q END) AS line_6, max(CASE WHEN l_linenumber = 7 THEN q END) AS line_7
FROM c GROUP BY 1
""")
def safe_pivot(t: Tables):
    wide, _ = reshape.safe_pivot(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_linenumber", "l_quantity", range(1, 8), name="line_{}")
    return wide


@query("""
WITH rows AS (SELECT DISTINCT l_returnflag, l_linenumber FROM lineitem), cols AS (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem),
c AS (SELECT l_returnflag, l_linenumber, l_orderkey, CASE WHEN count(*) = 1 THEN max(l_quantity)::varchar END AS q FROM lineitem GROUP BY ALL),
body AS (
  SELECT l_returnflag, l_linenumber::varchar AS label, l_linenumber || chr(9) || string_agg(coalesce(q, ''), chr(9) ORDER BY l_orderkey) AS line
  FROM rows JOIN cols USING (l_returnflag) LEFT JOIN c USING (l_returnflag, l_linenumber, l_orderkey) GROUP BY l_returnflag, l_linenumber),
head AS (SELECT l_returnflag, 'l_linenumber' AS label, 'l_linenumber' || chr(9) || string_agg(l_orderkey::varchar, chr(9) ORDER BY l_orderkey) AS line FROM cols GROUP BY 1)
SELECT l_returnflag, label, md5(line) AS line_md5, length(line) AS n_chars FROM (FROM body UNION ALL FROM head)
""")
def dense_matrices(t: Tables):
    """Tables with one column per order, far beyond what a pivot takes, written as text and read back."""
    folder = scratch(t.spark)
    lines = reshape.dense_lines(t.lineitem, "l_returnflag", "l_linenumber", "l_orderkey", "l_quantity")
    writers.write_dense(lines, "l_returnflag", folder)
    read = t.spark.read.text(folder)
    label = F.substring_index("value", "\t", 1)
    return read.select(F.col("l_returnflag").cast("string"), label.alias("label"), F.md5("value").alias("line_md5"), F.length("value").cast("bigint").alias("n_chars"))


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity::varchar AS raw_value, count(*) AS n_of_value FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey, l_linenumber, sum(n_of_value)::bigint AS n_values FROM c GROUP BY ALL HAVING sum(n_of_value) > 1)
SELECT * FROM c JOIN s USING (l_orderkey, l_linenumber)
""")
def duplicate_report(t: Tables):
    return reshape.duplicate_report(t.lineitem, ["l_orderkey"], "l_linenumber", "l_quantity")


@query("""
SELECT name AS col_name, count(*) AS n, round(sum(value), 2) AS total FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME name VALUE value) GROUP BY 1
""")
def wide_to_long(t: Tables):
    long = cells.cells_of(t.lineitem, "lineitem", "l_orderkey", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return long.groupBy("col_name").agg(n_rows(), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"))


@query("""
WITH l AS (SELECT l_suppkey AS table_id, l_orderkey AS sample_id, regexp_replace(p_name, '[^A-Za-z0-9_]+', '_', 'g') AS col_name, l_quantity AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT table_id, sample_id, col_name, count(*) AS n_values, CASE WHEN count(*) = 1 THEN max(v) END AS value FROM l GROUP BY ALL),
m AS (SELECT table_id, count(DISTINCT sample_id) AS n_samples, count(*) AS n_long_rows, count(DISTINCT col_name) AS n_taxa FROM l GROUP BY 1)
SELECT c.table_id, sample_id, col_name, n_values, value, n_samples, n_long_rows, n_taxa, n_samples * n_taxa AS n_cells FROM c JOIN m USING (table_id)
""")
def matrix_cells(t: Tables):
    long = _supplier_long(t).withColumn("taxon", F.col("p_name"))
    found, _, sizes = reshape.table_matrices(long)
    return found.join(sizes, "table_id").select("table_id", "sample_id", "col_name", "n_values", "value", "n_samples", "n_long_rows", "n_taxa", "n_cells")


def _supplier_long(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return t.lineitem.join(part, "l_partkey").select(F.col("l_suppkey").alias("table_id"), F.col("l_orderkey").alias("sample_id"), "p_name", "p_brand", F.col("l_quantity").alias("value"))


@query("""
WITH l AS (SELECT l_suppkey AS table_id, l_orderkey, p_brand, l_quantity AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
d AS (SELECT table_id, l_orderkey, p_brand, count(*) AS n FROM l GROUP BY ALL)
SELECT table_id, 's' || table_id || '.csv' AS source_file, count(DISTINCT l_orderkey) AS n_samples, count(*) AS n_rows, count(DISTINCT p_brand) AS n_taxa, 'unknown' AS domains, 0 AS n_control_samples,
  (SELECT count(*) FROM d WHERE d.table_id = l.table_id AND n > 1) AS n_duplicate_cells, sha256(s_name) AS sha256 FROM l JOIN supplier ON table_id = s_suppkey GROUP BY table_id, s_name
""")
def table_rollup(t: Tables):
    long = _supplier_long(t).withColumns({"taxon": F.col("p_brand"), "source_file": F.concat(F.lit("s"), "table_id", F.lit(".csv")), "domain": F.lit("unknown"), "sample_flag": F.lit(""), "col_name": F.col("p_brand")})
    report = reshape.duplicate_report(long, ["table_id", "sample_id"], "col_name", "value")
    files = t.supplier.select(F.concat(F.lit("s"), "s_suppkey", F.lit(".csv")).alias("source_file"), F.sha2("s_name", 256).alias("sha256"))
    return reshape.table_manifest(long, report, files)


@query("""
WITH s AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)
SELECT s_nationkey AS study_id, count(*) AS n_tables, sum(n)::bigint AS n_samples_not_deduplicated, string_agg(DISTINCT CASE WHEN s_acctbal < 0 THEN 'virus' WHEN s_acctbal > 5000 THEN 'prokaryote' ELSE 'unknown' END, ';'
  ORDER BY CASE WHEN s_acctbal < 0 THEN 'virus' WHEN s_acctbal > 5000 THEN 'prokaryote' ELSE 'unknown' END) AS domains FROM supplier JOIN s ON s_suppkey = l_suppkey GROUP BY 1
""")
def study_rollup(t: Tables):
    samples = t.lineitem.select("l_suppkey", "l_orderkey").distinct().groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(n_rows("n_samples"))
    domain = F.when(F.col("s_acctbal") < 0, "virus").when(F.col("s_acctbal") > 5000, "prokaryote").otherwise("unknown")
    return candidates.study_rollup(t.supplier.join(samples, "s_suppkey").select(F.col("s_nationkey").alias("study_id"), "n_samples", domain.alias("domain")))


@query("""
WITH u AS (SELECT l_suppkey, l_orderkey, 'discount' AS f, l_discount AS v FROM lineitem UNION ALL SELECT l_suppkey, l_orderkey, 'tax', CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax END FROM lineitem)
SELECT l_suppkey, count(*) AS n_cells, count(*) FILTER (v <> 0) AS n_nonzero, count(*) FILTER (v = 0) AS n_zero, count(*) FILTER (v IS NULL) AS n_blank, count(DISTINCT l_orderkey) AS n_samples, count(DISTINCT f) AS n_features,
  round(count(*) FILTER (v <> 0) / count(*), 6) AS share_nonzero FROM u GROUP BY 1
""")
def nonzero_cells(t: Tables):
    pair = lambda name, v: F.struct(F.lit(name).alias("f"), v.cast("string").alias("v"))
    long = t.lineitem.select("l_suppkey", "l_orderkey", F.inline(F.array(pair("discount", F.col("l_discount")), pair("tax", F.when(F.col("l_linenumber") != 7, F.col("l_tax"))))))
    return viral.blocks(long, ["l_suppkey"], "l_orderkey", "f", "v").withColumn("share_nonzero", F.round("share_nonzero", 6))


@query("""
SELECT l_suppkey || '::tax' AS feature_uid, count(*) AS n, min(l_suppkey || '::' || l_orderkey) AS first_uid FROM lineitem WHERE l_tax <> 0 AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1
""")
def namespaced_cells(t: Tables):
    long = t.lineitem.select(F.col("l_suppkey").alias("paper_folder"), F.col("l_orderkey").alias("sample_id"), F.inline(F.array(
        F.struct(F.lit("discount").alias("feature_id"), F.col("l_discount").cast("string").alias("value")), F.struct(F.lit("tax").alias("feature_id"), F.col("l_tax").cast("string").alias("value")))))
    features = t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("paper_folder"), F.lit("tax").alias("feature_id"))
    return reshape.domain_blocks(long, features).groupBy("feature_uid").agg(n_rows(), F.min("sample_uid").alias("first_uid"))


# ---------------------------------------------------------------------------
# abundance and coverage
# ---------------------------------------------------------------------------
@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 8) AS relative_abundance FROM lineitem")
def relative_abundance(t: Tables):
    out = coverage.relative_abundance(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey"], "l_quantity")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("relative_abundance", 8).alias("relative_abundance"))


_BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query(f"""
WITH s AS (SELECT l_suppkey, p_brand, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), r AS (SELECT *, q / sum(q) OVER (PARTITION BY l_suppkey) AS share FROM s)
SELECT s_suppkey AS l_suppkey, {', '.join(f"coalesce(sum(q) FILTER (p_brand = '{b}'), 0) AS {b.lower().replace('#', '_')}" for b in _BRANDS)} FROM supplier LEFT JOIN r ON s_suppkey = l_suppkey AND share >= 0.05 GROUP BY 1
""")
def detection_matrix(t: Tables):
    sums = _supplier_long(t).groupBy(F.col("table_id").alias("l_suppkey"), "p_brand").agg(F.sum("value").alias("q"))
    hits = coverage.relative_abundance(sums, ["l_suppkey"], "q").where("relative_abundance >= 0.05")
    grid = t.supplier.select(F.col("s_suppkey").alias("l_suppkey")).join(hits, "l_suppkey", "left")
    wide = reshape.zero_filled(grid, "l_suppkey", "p_brand", "q", _BRANDS)
    return wide.toDF(*[c.lower().replace("#", "_") for c in wide.columns])


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + (round(value)::bigint * 1000000) AS e FROM events), v AS (SELECT * FROM e WHERE e > s),
o AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM v),
c AS (SELECT user_id, sum(greatest(e - greatest(s, coalesce(m, s)), 0))::bigint AS covered_length FROM o GROUP BY 1)
SELECT e.user_id, count(*) AS n_intervals, sum(greatest(e.e - e.s, 0))::bigint AS summed_length, coalesce(any_value(covered_length), 0) AS covered_length FROM e LEFT JOIN c USING (user_id) GROUP BY 1
""")
def interval_coverage(t: Tables):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    spans = t.events.select("user_id", start.alias("start"), (start + F.round("value").cast("bigint") * 1_000_000).alias("end"))
    return coverage.union_length(spans, ["user_id"])


@query("""
WITH e AS (SELECT user_id AS sample, event_type AS genome, epoch(ts)::bigint AS s, epoch(ts)::bigint + round(value)::bigint AS e FROM events), d AS (SELECT * FROM e WHERE e > s),
o AS (SELECT *, max(e) OVER (PARTITION BY sample, genome ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM d),
c AS (SELECT sample, genome, count(*) AS reads, sum(greatest(e - greatest(s, coalesce(m, s)), 0)) / 10000.0 AS b, sum(e - s) / 10000.0 AS m FROM o GROUP BY ALL)
SELECT sample, count(*) AS genomes_with_any_read, count(*) FILTER (b >= 0.4 AND m >= 0.42) AS genomes_detected, sum(reads)::bigint AS reads FROM c GROUP BY 1
""")
def mapping_stats(t: Tables):
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    aln = t.events.select(F.col("user_id").alias("sample"), F.col("event_type").alias("genome"), start.alias("start"), (start + F.round("value").cast("bigint")).alias("end")).where("end > start")
    lengths = t.events.select(F.col("event_type").alias("genome")).distinct().withColumn("length", F.lit(10000))
    return coverage.mapping_stats(coverage.interval_coverage(aln, lengths), 0.4, 0.42)


@query("SELECT l_suppkey, count(*) AS n_before, count(*) FILTER (l_tax * 100 <= 0.25 * l_quantity) AS n_after FROM lineitem GROUP BY 1")
def identity_counts(t: Tables):
    aln = t.lineitem.select("l_suppkey", (F.col("l_tax") * 100).alias("nm"), F.col("l_quantity").alias("read_len"))
    return coverage.identity_counts(aln, ["l_suppkey"], F.col("nm") <= 0.25 * F.col("read_len"))


# ---------------------------------------------------------------------------
# reads
# ---------------------------------------------------------------------------
@query("""
WITH u AS (SELECT label, vec_id, i AS cut, sum(abs(e::double)) OVER (PARTITION BY vec_id ORDER BY i) AS s FROM (SELECT label, vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)),
n AS (SELECT label, count(*) AS n_reads FROM embeddings GROUP BY 1)
SELECT label, cut, count(*) AS n_pass, any_value(n_reads) AS n_reads, round(count(*) / any_value(n_reads), 8) AS share_pass FROM u JOIN n USING (label) WHERE s <= 3.0 GROUP BY ALL
""")
def error_profile(t: Tables):
    errors = F.transform("embedding", lambda e: F.abs(e.cast("double")))
    return reads.error_profile(t.embeddings, ["label"], errors, 3.0).withColumn("share_pass", F.round("share_pass", 8))


@query("""
WITH f AS (SELECT vec_id, label, embedding AS x FROM embeddings), r AS (SELECT vec_id, label, list_reverse(embedding) AS x FROM embeddings),
uf AS (SELECT label, vec_id, i, sum(abs(e::double)) OVER (PARTITION BY vec_id ORDER BY i) AS s FROM (SELECT label, vec_id, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM f)),
ur AS (SELECT label, vec_id, i, sum(abs(e::double)) OVER (PARTITION BY vec_id ORDER BY i) AS s FROM (SELECT label, vec_id, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM r)),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
g AS (SELECT n.label, a.f, b.r, coalesce((SELECT count(*) FROM uf WHERE uf.label = n.label AND i = a.f AND s <= 6.5), 0) / n AS kf, coalesce((SELECT count(*) FROM ur WHERE ur.label = n.label AND i = b.r AND s <= 6.5), 0) / n AS kr
  FROM n, (SELECT unnest([64, 54]) AS f) a, (SELECT unnest([64, 54]) AS r) b WHERE f + r >= 118)
SELECT label AS paper, f, r, round(kf * kr, 8) AS keep, f + r - 118 AS slack, row_number() OVER (PARTITION BY label ORDER BY kf * kr DESC, f + r DESC, f DESC) AS position FROM g
""")
def trunc_choice(t: Tables):
    side = lambda x: F.transform(x, lambda e: F.abs(e.cast("double")))
    fwd = reads.error_profile(t.embeddings, ["label"], side(F.col("embedding")), 6.5).withColumnRenamed("label", "paper")
    rev = reads.error_profile(t.embeddings, ["label"], side(F.reverse("embedding")), 6.5).withColumnRenamed("label", "paper")
    size = t.embeddings.groupBy(F.col("label").alias("paper")).agg(F.max(F.size("embedding")).alias("length"))
    budget = reads.merge_budget(size.select("paper", (F.col("length") + 42).alias("insert_p99"), F.lit(0).alias("trim_f"), F.lit(0).alias("trim_r"), F.col("length").alias("cap_f"), F.col("length").alias("cap_r")))
    return reads.trunc_choice(budget, fwd, rev).select("paper", "f", "r", F.round("keep", 8).alias("keep"), "slack", "position")


@query("""
WITH q AS (SELECT label, list_transform(embedding, lambda e: least(40, floor(abs(e::double) * 400))::int) AS q FROM embeddings),
u AS (SELECT label, q, coalesce(list_position(list_transform(q, lambda x: x <= 2), true), 0) AS bad FROM q),
k AS (SELECT label, (CASE WHEN bad > 0 THEN bad - 1 ELSE len(q) END) >= 10 AND list_sum(list_transform(q[3:10], lambda x: pow(10.0, -x / 10.0))) <= 1.0 AS keep FROM u)
SELECT label AS run, count(*) AS reads_in, count(*) FILTER (keep) AS reads_out, count(*) FILTER (keep) >= 5 AS kept FROM k GROUP BY 1
""")
def quality_filter(t: Tables):
    score = lambda e: F.least(F.lit(40), F.floor(F.abs(e.cast("double")) * 400).cast("int"))
    qual = F.array_join(F.transform("embedding", lambda e: F.char(score(e) + 33)), "")
    found = t.embeddings.select(F.col("label").alias("run"), F.col("vec_id").alias("read_idx"), F.repeat(F.lit("A"), F.size("embedding")).alias("seq"), qual.alias("qual"))
    return reads.filter_counts(found, reads.filter_reads(found, 10, 2, 1.0, 2, 0), ["run"], 5)


@query("""
WITH s AS (SELECT lang, doc_id, text, substr(text, 1, 10) AS c FROM documents), m AS (SELECT lang, c, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, min(doc_id)) AS r FROM s GROUP BY 1, 2),
p AS (SELECT lang, count(*) AS n_reads, count(*) FILTER (starts_with(text, 'Th')) AS a, count(*) FILTER (starts_with(text, 'D')) AS b FROM s GROUP BY 1)
SELECT p.lang, n_reads, CASE WHEN a > n_reads * 0.5 THEN 'article' WHEN b > n_reads * 0.5 THEN 'preposition' ELSE 'no primer detected' END AS target, c AS common_start, n AS n_common FROM p JOIN m ON p.lang = m.lang AND r = 1
""")
def prefix_share(t: Tables):
    return reads.prefix_scan(t.documents, "lang", "text", "doc_id", [("article", "Th"), ("preposition", "D")])


_DOC_SEQ = "CASE WHEN lang IN ('en', 'fr') THEN 'CCTACGGGAGGCAGCAG' ELSE '' END || regexp_replace(upper(text), '[^ACGT]', '', 'g')"


def _mismatch_sql(seq: str, primer: str) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains('{V.IUPAC[c]}', substr({seq}, {i + 1}, 1)) THEN 0 ELSE 1 END)" for i, c in enumerate(primer)) + ")"


_CALLS_SQL = f"""
WITH d AS (SELECT lang || '/' || source AS run, lang, doc_id, {_DOC_SEQ} AS s FROM documents),
n AS (SELECT run, any_value(lang) AS lang, count(*) AS n1, {', '.join(f"count(*) FILTER (length(s) >= {len(f)} AND {_mismatch_sql('s', f)} <= 2) / count(*) > 0.6 AS p{i}" for i, (f, _) in enumerate(V.PRIMERS.values()))} FROM d GROUP BY 1),
m AS (SELECT run, substr(s, 1, 10) AS tenmer, count(*) AS c, row_number() OVER (PARTITION BY run ORDER BY count(*) DESC, min(doc_id)) AS r FROM d GROUP BY 1, 2),
v AS (SELECT run, lang, n1, tenmer, (c * 100) // n1 AS pct, {' + '.join(f'p{i}::int' for i in range(7))} AS hits, {', '.join(f'p{i}' for i in range(7))} FROM n JOIN m USING (run) WHERE r = 1),
calls AS (SELECT run, lang, n1, tenmer AS common_10mer, pct AS common_10mer_percent, CASE WHEN hits = 1 THEN CASE {' '.join(f"WHEN p{i} THEN '{k}'" for i, k in enumerate(V.PRIMERS))} END WHEN hits > 1 THEN 'ambiguous'
  {' '.join(f"WHEN pct > 60 AND length(tenmer) >= 10 AND {_mismatch_sql('tenmer', f[:10])} <= 1 THEN 'primer_like_{k}'" for k, (f, _) in V.PRIMERS.items())} ELSE 'unknown_pretrimmed' END AS region FROM v)
"""


def _document_reads(t: Tables) -> DataFrame:
    """Letters A, C, G, T of whole documents as reads; documents of two languages carry a primer in front."""
    primer = F.when(F.col("lang").isin("en", "fr"), "CCTACGGGAGGCAGCAG").otherwise("")
    seq = F.concat(primer, F.regexp_replace(F.upper("text"), "[^ACGT]", ""))
    return t.documents.select(F.concat_ws("/", "lang", "source").alias("run"), F.lit("R1").alias("mate"), F.col("doc_id").alias("read_idx"), seq.alias("seq"))


@query(_CALLS_SQL + "SELECT run, region, common_10mer, common_10mer_percent, region <> 'unknown_pretrimmed' AS primers_present FROM calls")
def primer_regions(t: Tables):
    return reads.primer_call(_document_reads(t)).select("run", "region", "common_10mer", "common_10mer_percent", "primers_present")


@query(_CALLS_SQL + "SELECT lang, count(*) AS n_runs, count(DISTINCT region) AS n_regions, min(region) AS region, count(DISTINCT region) = 1 AS agrees FROM calls GROUP BY 1")
def region_agreement(t: Tables):
    calls = reads.primer_call(_document_reads(t)).withColumn("lang", F.element_at(F.split("run", "/"), 1))
    return reads.region_agreement(calls, ["lang"])


@query("""
WITH l AS (SELECT CASE WHEN label < 5 THEN 'low' ELSE 'high' END AS grp, 64 + 8 + label % 10 AS x FROM embeddings), s AS (SELECT grp, list(x ORDER BY x) AS v, count(*) AS n FROM l GROUP BY 1),
q AS (SELECT grp, v, n, p, greatest(1, least((p * (n + 1)) // 100, n - 1)) AS j FROM s, (SELECT unnest([1, 5, 95, 99]) AS p)), e AS (SELECT grp, p, (v[j] * (100 - (p * (n + 1) - 100 * j)) + v[j + 1] * (p * (n + 1) - 100 * j)) / 100.0 AS x FROM q),
m AS (SELECT grp, string_agg(x::varchar, ';' ORDER BY n DESC, x) AS modes FROM (SELECT grp, x, count(*) AS n, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, x) AS r FROM l GROUP BY 1, 2) WHERE r <= 5 GROUP BY 1)
SELECT l.grp, count(*) AS n_pairs, count(*) AS n_overlapped, min(x) AS shortest, max(x) AS longest, (SELECT x FROM e WHERE e.grp = l.grp AND p = 1) AS p1, (SELECT x FROM e WHERE e.grp = l.grp AND p = 5) AS p5,
  (SELECT x FROM e WHERE e.grp = l.grp AND p = 95) AS p95, (SELECT x FROM e WHERE e.grp = l.grp AND p = 99) AS p99, median(x) AS median, any_value(modes) AS modes FROM l JOIN m USING (grp) GROUP BY 1
""")
def insert_lengths(t: Tables):
    letters = F.array_join(F.transform("embedding", lambda e: F.substring(F.lit("ACGT"), (F.floor(F.abs(e.cast("double")) * 1000) % 4 + 1).cast("int"), F.lit(1))), "")
    shift = (F.col("label") % 10 + 8).cast("int")
    pairs = t.embeddings.select(F.when(F.col("label") < 5, "low").otherwise("high").alias("grp"), letters.alias("seq1"), shift.alias("k"))
    turned = F.concat(F.substring("seq1", F.col("k") + 1, F.length("seq1")), F.reverse(F.substring("seq1", F.lit(1), F.col("k"))))
    measured = reads.insert_lengths(pairs.select("grp", "seq1", turned.alias("seq2_rc"))).select("grp", "insert_length")
    return reads.insert_summary(ordering.stored(measured), ["grp"])


@query("""
WITH s AS (SELECT l_returnflag, list(l_extendedprice ORDER BY l_extendedprice) AS v, count(*) AS n FROM lineitem GROUP BY 1), q AS (SELECT *, greatest(1, least((p * (n + 1)) // 100, n - 1)) AS j FROM s, (SELECT unnest([1, 5, 95, 99]) AS p))
SELECT l_returnflag, p AS percent, n, round((v[j] * (100 - (p * (n + 1) - 100 * j)) + v[j + 1] * (p * (n + 1) - 100 * j)) / 100, 4) AS quantile FROM q
""")
def exclusive_quantiles(t: Tables):
    out = ordering.exclusive_quantiles(t.lineitem.select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", [1, 5, 95, 99])
    return out.withColumn("quantile", F.round("quantile", 4))


@query(r"""
WITH p AS (SELECT regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS paper, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host, length(html) AS n FROM pages),
q AS (SELECT paper, CASE WHEN bool_or(starts_with(host, 'm.')) OVER (PARTITION BY paper) AND paper = 'de' THEN 'unknown_single_model' ELSE host END AS batch, n FROM p),
b AS (SELECT paper, batch, count(*) AS n_samples, sum(n)::bigint AS bases FROM q GROUP BY ALL), s AS (SELECT paper, count(*) AS ns, sum(bases) AS sb FROM b WHERE bases < 12000 GROUP BY 1)
SELECT b.paper, batch, n_samples, bases, CASE WHEN bases >= 12000 THEN batch WHEN ns > 1 AND sb >= 12000 THEN 'pooled_small_batches' ELSE 'own_model_below_threshold:' || batch END AS error_model FROM b LEFT JOIN s USING (paper)
""")
def batch_group(t: Tables):
    paper, host = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1), F.regexp_extract("url", "^https?://([^/?#:]+)", 1)
    samples = t.pages.select(paper.alias("paper"), host.alias("host"), F.length("html").cast("bigint").alias("reads_out"), F.lit(1).alias("retained_length"))
    stripped = (F.col("paper") == "de") & F.startswith("host", F.lit("m."))
    return reads.error_groups(samples.withColumn("batch", F.when(~stripped, F.col("host"))), threshold=12000)


_STEP_OF = [("view", "raw"), ("click", "filtered"), ("signup", "merged"), ("purchase", "nonchimeric")]


@query("""
WITH d AS (SELECT ts::date::varchar AS day, user_id, count(*) FILTER (event_type = 'view') AS raw, count(*) FILTER (event_type = 'click') AS f, count(*) FILTER (event_type = 'signup') AS m, count(*) FILTER (event_type = 'purchase') AS x FROM events GROUP BY ALL),
a AS (SELECT day, count(*) FILTER (f >= 1) AS n_analysed, count(*) FILTER (f >= 1 AND x = 0) AS n_empty, count(*) FILTER (f >= 1 AND m / greatest(f, 1) < 0.3) AS n_weak, median(CASE WHEN f >= 1 THEN m / greatest(f, 1) END) AS med,
  CASE WHEN sum(m) > 0 THEN sum(x) / sum(m) END AS c FROM d GROUP BY 1)
SELECT day, n_analysed, n_empty, n_weak, round(med, 8) AS median_retention, round(n_empty / greatest(n_analysed, 1), 8) AS share_empty,
  CASE WHEN coalesce(med, 0) < 0.3 OR n_empty / greatest(n_analysed, 1) > 0.05 THEN 'merge_failure' ELSE 'ok' END AS verdict, round(c, 8) AS chimera_retention, coalesce(c < 0.8, false) AS noisy FROM a
""")
def retention_track(t: Tables):
    day = F.to_date("ts").cast("string").alias("day")
    step = case_when([(F.col("event_type") == k, F.lit(v)) for k, v in _STEP_OF], F.lit("other"))
    counts = t.events.groupBy(day, "user_id", step.alias("step")).agg(n_rows())
    track = ordering.stored(reads.track_reads(t.events.select(day, "user_id"), counts, ["day", "user_id"]))
    out = reads.merge_verdict(track, "day", min_reads=1).join(reads.chimera_retention(track, "day"), "day")
    return out.withColumns({c: F.round(c, 8) for c in ("median_retention", "share_empty", "chimera_retention")})


@query("SELECT lang, (n_chars // 100) * 100 AS length, count(*) AS n, sum(n_chars)::bigint AS weight, (n_chars // 100) * 100 BETWEEN 500 AND 2000 AS kept FROM documents GROUP BY ALL")
def length_window(t: Tables):
    return reads.length_window(t.documents, F.floor(F.col("n_chars") / 100) * 100, 500, 2000, F.col("n_chars"), ["lang"])

