"""Registered queries of this package, with SQL where SQL can state the result."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, fill_middle, license_scan, line_dedup, merkle, mixing, ngram_join, packing, page_diff, quality, suffix_dedup, toxicity, vp_search, wavelet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document, over five-word shingles at 0.8."""
    return ngram_join.join(_table(spark, folder, "documents"))


@query
def op2_nearest_url_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return page_diff.extract(_table(spark, folder, "pages"))


@query
def op3_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, read back from wavelet-matrix files in the shared folder."""
    files = f"{common.shared_folder(spark)}/wavelet/{uuid.uuid4().hex}"
    wavelet.write(_table(spark, folder, "documents"), files)
    return wavelet.read(spark, files)


@query
def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document, and the shards and positions it takes them to."""
    found = mixing.taken(mixing.mix(_table(spark, folder, "documents")))
    places = F.array_join(F.transform("places", lambda p: F.concat_ws(":", p["shard"].cast("string"), p["position"].cast("string"))), " ").alias("places")
    return found.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "source", "draws", places)


@query
def op5_vantage_point_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors of largest inner product for every twentieth vector."""
    return vp_search.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_noisy_channel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated passages of every document, with their places, and a digest of the text without them."""
    cut = line_dedup.dedup(_table(spark, folder, "documents").select("doc_id", "text"), unit="passage").select("doc_id", "cut.*")
    return cut.select("doc_id", "n_units", "n_removed", "removed_chars", "spans", F.md5("kept_text").alias("kept_md5"))


#: Segments are long lines and runs of short ones; their pieces part the text; pieces of few words belong to the unit before them.
SQL["op7_line_dedup"] = rf"""
WITH given AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS rows FROM documents),
lines AS (
  SELECT doc_id, pos, line || CASE WHEN pos < last THEN chr(10) ELSE '' END AS line, len(regexp_extract_all(line, '[^ \t\n\v\f\r]+')) >= {line_dedup.LEAST} AS long
  FROM (SELECT doc_id, unnest(rows) AS line, generate_subscripts(rows, 1) AS pos, len(rows) AS last FROM given)),
marked AS (SELECT *, long OR coalesce(lag(long) OVER (PARTITION BY doc_id ORDER BY pos), true) AS starts FROM lines),
numbered AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS seg FROM marked),
segments AS (SELECT doc_id, seg, string_agg(line, '' ORDER BY pos) AS body, bool_or(long) AS long FROM numbered GROUP BY doc_id, seg),
cut AS (
  SELECT doc_id, seg, CASE WHEN long THEN regexp_extract_all(body, '{line_dedup.clause_pattern(line_dedup.LEAST)}')
                           ELSE regexp_extract_all(body, '{line_dedup.lines_pattern(line_dedup.LEAST)}') END AS pieces FROM segments),
pieces AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seg, k) AS pos, piece, len(regexp_extract_all(piece, '[^ \t\n\v\f\r]+')) >= {line_dedup.LEAST} AS full_one
  FROM (SELECT doc_id, seg, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM cut)),
owned AS (SELECT *, sum((full_one OR pos = 1)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS unit FROM pieces),
units AS (SELECT doc_id, unit, string_agg(piece, '' ORDER BY pos) AS body FROM owned GROUP BY doc_id, unit),
placed AS (
  SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length(body) - length(regexp_replace(body, '^[ \t\n\v\f\r]+', '')) AS start,
         length(regexp_replace(regexp_replace(body, '^[ \t\n\v\f\r]+', ''), '[ \t\n\v\f\r]+$', '')) AS n,
         lower(trim(regexp_replace(body, '[ \t\n\v\f\r]+', ' ', 'g'), ' ')) AS plain
  FROM units),
judged AS (SELECT *, plain <> '' AS counted, plain <> '' AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, unit) > 1 AS gone FROM placed),
summed AS (
  SELECT doc_id, count(*) FILTER (WHERE counted) AS n_units, count(*) FILTER (WHERE gone) AS n_removed, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS removed_chars,
         coalesce(string_agg(start::BIGINT || '-' || (start + n)::BIGINT, ';' ORDER BY unit) FILTER (WHERE gone), '') AS spans,
         md5(coalesce(string_agg(body, '' ORDER BY unit) FILTER (WHERE NOT gone), '')) AS kept_md5
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars, coalesce(spans, '') AS spans,
       coalesce(kept_md5, md5('')) AS kept_md5
FROM documents LEFT JOIN summed USING (doc_id)
"""


@query
def op8_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of the quality cascade for every document."""
    return quality.judge(_table(spark, folder, "documents"))


@query
def op10_run_length_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier documents."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs).select("doc_id", "cut.*")


@query
def op9_histogram_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, folder, "documents"))

@query
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and digests of every document rewritten to fill its middle in, and of the text rebuilt from that."""
    rewritten = fill_middle.transform(_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    digests = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return fill_middle.restore(rewritten).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL["op13_fill_middle"] = """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS two,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS three, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS four FROM given),
cut AS (
  SELECT doc_id, text, n,
         array_to_string(units[1:least(one, two)], '') AS prefix, array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR three >= 90 THEN 'plain'
              WHEN four < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


@query
def op12_license_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the base phrases, all licence labels and a score of every document."""
    wanted = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return license_scan.scan(_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", *[f"licences.{c}" for c in wanted])


def _lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether it still verifies after a third of the texts were tampered with."""
    docs = _table(spark, folder, "documents")
    whole = [docs[c] for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 3 == 0, F.lit(False))
    tampered = F.when(hit, merkle.leaf_of(*whole, _lower(docs["text"]))).alias("tampered")
    found = merkle.manifest(docs.select("doc_id", "lang", merkle.leaf_of(*whole, docs["text"]).alias("leaf"), tampered))
    opened = found.select("doc_id", "leaf", "tampered", "merkle.*").withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    proof = F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256")
    return opened.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(parts) + ")"


def _levels_sql(name: str, levels: int) -> str:
    """Tables name1, name2, ...: each the parents of the one before."""
    return ", ".join(
        f"""{name}{h + 1} AS (
  SELECT lang, place // 8 AS place, sha256(string_agg(node, '' ORDER BY place)) AS node, any_value((width + 7) // 8) AS width
  FROM {name}{h} WHERE width > 1 GROUP BY lang, place // 8)""" for h in range(levels))


def _folds_sql(name: str, nodes: str, levels: int) -> str:
    """Tables name1, name2, ...: documents, each folded with its siblings one level further."""
    left, right = "array_to_string(met[1:f.place % 8], '')", "array_to_string(met[f.place % 8 + 2:], '')"
    return ", ".join(
        f"""{name}{h + 1} AS (
  SELECT f.* EXCLUDE (place, acc, proof), f.place // 8 AS place, CASE WHEN met IS NULL THEN acc ELSE sha256({left} || acc || {right}) END AS acc,
         CASE WHEN met IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
  FROM {name}{h} f LEFT JOIN (SELECT lang, place // 8 AS run, list(node ORDER BY place) AS met FROM {nodes}{h} WHERE width > 1 GROUP BY ALL) r
    ON f.lang = r.lang AND f.place // 8 = r.run)""" for h in range(levels))


def _tops_sql(name: str, levels: int) -> str:
    return " UNION ALL ".join(f"SELECT lang, node FROM {name}{h} WHERE width = 1" for h in range(levels + 1))


def _merkle_sql(levels: int) -> str:
    """Trees of up to 8^levels leaves, one level after the other; a table of CRC-32 steps finds the documents that are tampered with."""
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH RECURSIVE crc(doc_id, bytes, c, k) AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::BIGINT, 0 FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN k % 9 = 0 THEN bytes[2:] ELSE bytes END,
         CASE WHEN k % 9 = 0 THEN xor(c, ascii(bytes)::BIGINT) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) END, k + 1
  FROM crc WHERE k % 9 > 0 OR bytes <> ''),
hit AS (SELECT doc_id AS hit_id, xor(max_by(c, k), 4294967295::BIGINT) % 3 = 0 AS hit FROM crc GROUP BY doc_id),
given AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS lang, {_leaf_sql('text')} AS leaf, CASE WHEN hit THEN {_leaf_sql(lowered)} ELSE {_leaf_sql('text')} END AS found
  FROM documents LEFT JOIN hit ON doc_id = hit_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS width FROM given),
n0 AS (SELECT lang, place, leaf AS node, width FROM placed),
{_levels_sql('n', levels)},
subroots AS (SELECT *, row_number() OVER (ORDER BY lang) - 1 AS place FROM ({_tops_sql('n', levels)})),
t0 AS (SELECT '' AS lang, place, node, count(*) OVER () AS width FROM subroots),
{_levels_sql('t', levels)},
root AS ({_tops_sql('t', levels)}),
f0 AS (SELECT doc_id, lang, leaf, place, found AS acc, '' AS proof FROM placed),
{_folds_sql('f', 'n', levels)},
g0 AS (SELECT doc_id, '' AS lang, leaf, s.node AS subroot, s.place, acc, proof FROM f{levels} f JOIN subroots s ON f.lang = s.lang),
{_folds_sql('g', 't', levels)}
SELECT doc_id, leaf, subroot, root.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root.node AS verified FROM g{levels}, root
"""


SQL["op11_merkle_manifest"] = _merkle_sql(7)
