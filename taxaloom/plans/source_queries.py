"""Queries over files: tables are written out as people deposit them and read back by the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import scratch
from ..sources import readers
from .catalog import Tables, n_rows, query

_WRITE = {"header": True, "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_BREAKS = r"'\r\n|\r', chr(10), 'g'"


def _digest(fields: list[Column]) -> Column:
    return F.md5(F.concat_ws("\x01", *fields))


@query(rf"""
SELECT dialect, kind, digest, count(*) AS n FROM (
  SELECT 'comma' AS dialect, 'row' AS kind, md5(doc_id || chr(1) || regexp_replace(coalesce(text, ''), {_BREAKS}) || chr(1) || coalesce(source, '')) AS digest FROM documents
  UNION ALL
  SELECT 'tab', 'row', md5(conv_id || chr(1) || turn || chr(1) || regexp_replace(coalesce(text, ''), {_BREAKS})) FROM conversations
  UNION ALL
  SELECT 'semicolon', 'row', md5(p_partkey || chr(1) || p_name || chr(1) || p_size || '" pipe') FROM part WHERE p_partkey % 7 <> 3
  UNION ALL
  SELECT 'semicolon', 'bad', md5(p_partkey || ';"' || p_name || ';' || p_size) FROM part WHERE p_partkey % 7 = 3)
GROUP BY ALL
""")
def delimited_round_trip(t: Tables):
    """Whole texts with line breaks in quotes, stray inch marks and quotes that never close, in three dialects."""
    folder = scratch(t.spark)
    t.documents.select("doc_id", "text", "source").write.options(**_WRITE).csv(f"{folder}/comma")
    t.conversations.select("conv_id", "turn", "text").write.options(**_WRITE, sep="\t").csv(f"{folder}/tab")
    inches = F.concat_ws(";", "p_partkey", "p_name", F.concat("p_size", F.lit('" pipe')))
    torn = F.concat("p_partkey", F.lit(';"'), "p_name", F.lit(";"), "p_size")
    lines = t.part.select(F.when(F.col("p_partkey") % 7 == 3, torn).otherwise(inches).alias("line"))
    # every file begins with its header, as each part of a deposit does
    parts = lines.repartition(4).mapInPandas(_with_header, "line string")
    parts.write.text(f"{folder}/semicolon")
    cells, bad, _ = readers.read_table_cells(t.spark, [f"{folder}/{d}" for d in ("comma", "tab", "semicolon")], missing=None)
    dialect = F.element_at(F.split("table_id", "/"), -2).alias("dialect")
    fields = F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "value"))), lambda f: f["value"])
    rows = cells.groupBy("table_id", "row_idx").agg(F.md5(F.array_join(fields, "\x01")).alias("digest")).select(dialect, F.lit("row").alias("kind"), "digest")
    wrong = bad.select(dialect, F.lit("bad").alias("kind"), F.md5("line").alias("digest"))
    return rows.unionByName(wrong).groupBy("dialect", "kind", "digest").agg(n_rows())


def _with_header(batches):
    import pandas as pd

    first = True
    for batch in batches:
        yield pd.concat([pd.DataFrame({"line": ["key;name;size"]}), batch]) if first else batch
        first = False


@query("""
SELECT page_id % 16 AS bucket, sum(octet_length(encode(html)) + 1)::bigint AS size_bytes, sha256(string_agg(html || chr(10), '' ORDER BY page_id)) AS sha256,
       regexp_matches(left(arg_min(html, page_id), 512), '<!DOCTYPE|<!doctype|<html|<HTML') AS is_challenge_page
FROM pages WHERE html IS NOT NULL GROUP BY 1
""")
def file_digests(t: Tables):
    """Files of many pages each, hashed as streams."""
    folder = scratch(t.spark)
    pages = t.pages.where("html IS NOT NULL").select((F.col("page_id") % 16).alias("bucket"), "page_id", "html")
    # all pages of a bucket go to one file: that is what makes the files large
    pages.repartition(16, "bucket").sortWithinPartitions("bucket", "page_id").select("bucket", F.col("html").alias("value")).write.partitionBy("bucket").text(folder)
    found = readers.file_manifest(t.spark, f"{folder}/bucket=*/*.txt")
    return found.select(F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"), "size_bytes", "sha256", "is_challenge_page")


@query("""
SELECT event_id::varchar AS name, translate(md5(event_id::varchar), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, translate(md5('q' || event_id), '0123456789abcdef', '!+5?I!+5?I!+5?I!') AS qual
FROM events WHERE event_id % 10 > 0
""")
def fastq_back(t: Tables):
    """Reads of compressed files; a tenth of the records has lost a quality and is reported, not returned."""
    folder = scratch(t.spark)
    name = F.col("event_id").cast("string")
    seq = F.translate(F.md5(name), "0123456789abcdef", "ACGTACGTACGTACGT")
    qual = F.translate(F.md5(F.concat(F.lit("q"), name)), "0123456789abcdef", "!+5?I!+5?I!+5?I!")
    torn = F.when(F.col("event_id") % 10 == 0, F.substring(qual, 2, 31)).otherwise(qual)
    t.events.select(F.concat_ws("\n", F.concat(F.lit("@"), name), seq, F.lit("+"), torn)).write.option("compression", "gzip").text(folder)
    reads, _ = readers.read_fastq(t.spark, f"{folder}/*.gz")
    return reads.select(F.substr("header", F.lit(2)).alias("name"), "seq", "qual")


@query("""
SELECT 'o' || l_orderkey || '_' || l_linenumber AS rname, l_partkey::bigint AS reads, l_suppkey::bigint AS covered_bases, l_discount::double / 100 AS breadth, l_tax::double AS mean_depth FROM lineitem
""")
def coverage_back(t: Tables):
    """Nine columns, comments and short rows between them."""
    folder = scratch(t.spark)
    name = F.concat(F.lit("o"), "l_orderkey", F.lit("_"), "l_linenumber")
    row = F.concat_ws("\t", name, F.lit(1), F.lit(100), "l_partkey", "l_suppkey", F.col("l_discount").cast("double"), F.col("l_tax").cast("double"), F.lit(30), F.lit(40))
    noise = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("#rname\tstartpos\n"), row, F.lit("\nshort\t1"))).otherwise(row)
    t.lineitem.select(noise).write.text(folder)
    return readers.read_coverage(t.spark, folder).drop("source_path")


@query(rf"""
SELECT c_custkey::varchar AS c_custkey, c_name, NULL AS other, 'csv' AS kind FROM customer
UNION ALL SELECT doc_id::varchar, regexp_replace(text, {_BREAKS}), lang, 'tsv' FROM documents
UNION ALL SELECT s_suppkey::varchar, s_name, NULL, 'gz' FROM supplier
""")
def headed_tables(t: Tables):
    """Comma, tab and compressed tab tables with a header and declared columns; quoted line breaks stay."""
    folder = scratch(t.spark)
    # each row names its table: rows without any value would be blank lines, which the tab dialect leaves out
    kind = lambda k: F.lit(k).alias("kind")
    t.customer.select("c_custkey", "c_name", kind("csv")).write.options(**_WRITE).csv(f"{folder}/csv")
    plain = F.regexp_replace("text", "\r\n|\r", "\n")
    t.documents.select("doc_id", plain.alias("text"), "lang", kind("tsv")).write.options(**_WRITE, sep="\t").csv(f"{folder}/tsv")
    t.supplier.select("s_suppkey", "s_name", kind("gz")).write.options(**_WRITE, sep="\t", compression="gzip").csv(f"{folder}/gz")

    def shaped(df: DataFrame, other: str | None = None) -> DataFrame:
        return df.select(F.col(df.columns[0]).alias("c_custkey"), F.col(df.columns[1]).alias("c_name"), (F.col(other) if other else F.lit(None).cast("string")).alias("other"), "kind")

    comma = readers.read_csv(t.spark, f"{folder}/csv", "c_custkey string, c_name string, kind string")
    tab = readers.read_tsv(t.spark, f"{folder}/tsv", "doc_id string, text string, lang string, kind string")
    packed = readers.read_tsv(t.spark, f"{folder}/gz", "s_suppkey string, s_name string, kind string")
    return shaped(comma).unionByName(shaped(tab, "lang")).unionByName(shaped(packed))


@query("""
SELECT CASE WHEN event_id % 9 = 4 THEN NULL ELSE event_id END AS event_id, CASE WHEN event_id % 9 = 4 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 9 = 4 THEN '{"event_id":' || event_id || ',"event_type"' END AS broken
FROM events
""")
def json_lines_back(t: Tables):
    """A ninth of the lines is cut off and reported, blank lines are skipped."""
    folder = scratch(t.spark)
    whole = F.to_json(F.struct("event_id", "event_type"))
    cut = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"event_type"'))
    line = F.when(F.col("event_id") % 9 == 4, cut).otherwise(F.concat(whole, F.lit("\n")))
    t.events.select(line).write.text(folder)
    good, bad = readers.read_jsonl(t.spark, folder, "event_id bigint, event_type string")
    none = F.lit(None)
    return good.select("event_id", "event_type", none.cast("string").alias("broken")).unionByName(
        bad.select(none.cast("bigint").alias("event_id"), none.cast("string").alias("event_type"), F.col("line").alias("broken")))


@query("""
SELECT r_regionkey, r_name, len(nations)::int AS n_nations, list_aggregate(nations, 'string_agg', ',') AS nations FROM (
  SELECT r_regionkey, r_name, list(n_name ORDER BY n_name) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)
""")
def json_docs_back(t: Tables):
    """One nested document per file."""
    folder = scratch(t.spark)
    nations = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("nations"))  # a region's nations: the document itself
    docs = t.region.join(nations, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", F.struct("r_name", "nations").alias("facts"))
    text = F.regexp_replace(F.to_json(F.struct("r_regionkey", "facts")), r"([{,\[])", "$1\n ")
    docs.select(F.col("r_regionkey").alias("k"), text.alias("value")).write.partitionBy("k").text(folder)
    found = readers.read_json_docs(t.spark, f"{folder}/k=*/*.txt", "r_regionkey int, facts struct<r_name: string, nations: array<string>>")
    return found.select("r_regionkey", "facts.r_name", F.size("facts.nations").alias("n_nations"), F.array_join("facts.nations", ",").alias("nations"))
