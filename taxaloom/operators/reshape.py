"""Cells to long abundance rows, long rows to matrices, claims to columns."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import matches
from ..functions.taxa import sample_flags, split_taxonomy, table_domain
from ..functions.text import lenient_double, nonblank, safe_name, trim_ws
from .cells import COL, column_facts
from .ordering import counted, running_total, stored


def undedupe_names(names: DataFrame, keys: Sequence[str], column: str, name: str = "original_name") -> DataFrame:
    """Strip ``.1`` style suffixes only where the name without the suffix exists in the same table."""
    base = F.regexp_extract(column, r"^(.*)\.(\d+)$", 1)
    known = names.select(*keys, F.col(column).alias("_base")).distinct().withColumn("_known", F.lit(True))
    out = names.withColumn("_base", F.when(F.col(column).rlike(r"^.*\.\d+$"), base)).join(known, [*keys, "_base"], "left")
    return out.withColumn(name, F.when(F.coalesce("_known", F.lit(False)), F.col("_base")).otherwise(F.col(column))).select(*names.columns, name)


def column_roles(cells: DataFrame, verdicts: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Role of every column of an accepted table: sample, taxon or value, with its restored name. ``facts`` are the cells' ``column_facts``."""
    stats = (column_facts(cells) if facts is None else facts).select(*COL, "col_name", "n_numeric", "n_rows")
    stats = stats.withColumn("_mostly", F.col("n_numeric") / F.col("n_rows") > 0.5)
    cols = undedupe_names(stats, ["table_id"], "col_name").join(
        verdicts.where("is_abundance").select("table_id", "kind", "axis", "label_idx"), "table_id")
    low = F.lower(trim_ws(F.col("col_name")))
    hits = cols.groupBy("table_id").agg(
        F.min(F.when(matches(F.col("col_name"), V.SAMPLE_HEADER, True), F.col("col_idx"))).alias("_s"),
        F.min(F.when(low.isin(V.RANK_HEADERS), F.col("col_idx"))).alias("_t"),
        F.min(F.when(matches(F.col("col_name"), V.ABUNDANCE_HEADER, True), F.col("col_idx"))).alias("_v"))
    cols = cols.join(hits, "table_id")
    label = F.when(F.col("axis") == "rows", F.coalesce("label_idx", F.lit(0))).otherwise(F.lit(0))
    idx, long_form = F.col("col_idx"), F.col("kind") == "long"
    role = (
        F.when(long_form & (idx == F.col("_s")), "sample").when(long_form & (idx == F.col("_t")), "taxon")
        .when(long_form & (idx == F.col("_v")), "value").when(long_form, F.lit(None))
        .when(idx == label, F.when(F.col("axis") == "rows", "taxon").otherwise("sample")).when(F.col("_mostly"), "value")
    )
    name = F.when(F.col("axis") == "cols", F.col("original_name")).otherwise(F.col("col_name"))
    return cols.withColumns({"role": role, "name": name}).where("role IS NOT NULL").select("table_id", "col_idx", "role", "name", "kind", "axis")


def to_long(cells: DataFrame, verdicts: DataFrame, meta: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """Long abundance rows of every accepted table. Missing cells stay rows with ``is_missing``; nothing becomes zero.

    ``meta`` (table_id, paper_id, dataset_id, source_file) is joined when given. The labels of a row are carried to its values in one exchange of cells;
    a row without any label cell gives none.
    """
    # written, so that Spark knows how few columns these are and sends no column's cells to one task
    tagged = cells.join(stored(column_roles(cells, verdicts, facts)), COL)
    row = Window.partitionBy("table_id", "row_idx")
    label = lambda role: F.max(F.when(F.col("role") == role, F.col("value"))).over(row)
    labelled = F.max(F.col("role") != "value").over(row)
    rows = tagged.withColumns({"_sample": label("sample"), "_taxon": label("taxon"), "_labelled": labelled}).where("role = 'value' AND _labelled")
    by_rows, by_cols = F.col("axis") == "rows", F.col("axis") == "cols"
    number = lenient_double(F.col("value"))
    long = rows.select(
        "table_id", "row_idx", "col_idx",
        trim_ws(F.when(by_rows & (F.col("kind") == "wide"), F.col("name")).otherwise(F.col("_sample"))).alias("sample_id"),
        trim_ws(F.when(by_cols & (F.col("kind") == "wide"), F.col("name")).otherwise(F.col("_taxon"))).alias("taxon"),
        number.alias("value"), nonblank(F.col("value")).isNull().alias("is_missing"), F.col("value").alias("value_raw"),
    ).where("sample_id IS NOT NULL AND taxon IS NOT NULL")
    long = long.join(verdicts.select("table_id", "value_type"), "table_id")
    if meta is None:
        meta_cols = {"paper_id": F.lit(""), "dataset_id": F.col("table_id"), "source_file": F.col("table_id")}
        long = long.withColumns(meta_cols)
    else:
        long = long.join(meta, "table_id", "left")
    return annotate_long(long)


def annotate_long(long: DataFrame) -> DataFrame:
    """Add ranks, domain with evidence, and sample marks to (taxon, sample_id, source_file) rows."""
    out = long.withColumns({"_r": split_taxonomy(F.col("taxon")), "_d": table_domain(F.col("taxon")),
                            "_f": sample_flags(F.col("sample_id"), F.col("source_file"))})
    return out.select(*long.columns, "_r.*", F.col("_d.domain").alias("domain"), F.col("_d.evidence").alias("domain_evidence"),
                      F.col("_f.control").alias("sample_flag"), F.col("_f.assay").alias("sequencing_type_hint"))


def single_cells(df: DataFrame, index: Sequence[str], column: str, value: str) -> DataFrame:
    """One row per (index, column): the value where there is exactly one, blank where there are several."""
    return df.groupBy(*index, column).agg(
        F.count(F.lit(1)).alias("n_values"), F.when(F.count(F.lit(1)) == 1, F.max(value)).alias(value))


def safe_pivot(df: DataFrame, index: Sequence[str], column: str, value: str, columns: Sequence, name: str = "{}") -> tuple[DataFrame, DataFrame]:
    """(wide, duplicates) for a known list of columns: never sums repeats, never writes zero for an absent pair. ``dense_lines`` takes any number."""
    cells = single_cells(df, index, column, value)
    picks = [F.max(F.when(F.col(column) == F.lit(c), F.col(value))).alias(name.format(c)) for c in columns]
    return cells.groupBy(*index).agg(*picks), duplicate_report(df, index, column, value)


def column_dictionary(cells: DataFrame, table: str, column: str) -> DataFrame:
    """Columns of every table with their 0-based places in the order of their names, and how many the table has."""
    return running_total(cells.select(table, column).distinct(), [table], column, name="col_no", whole="n_cols")


def dense_lines(cells: DataFrame, table: str, row: str, column: str, value: str, sep: str = "\t", missing: str = "") -> DataFrame:
    """Dense matrices of all tables as lines of text, whatever their width: table, line_no (grows along a table), line.

    The first line of a table holds its column names. Cells are sorted once by (table, row, place of the column), and a task fills the gaps between
    them as they pass by, so nothing is pivoted, no header is collected, and a task holds one line. A pair with several values is blank, as in
    ``single_cells``; a separator or line break inside a name becomes a blank.
    """
    text = lambda c: F.regexp_replace(F.col(c).cast("string"), "[\t\r\n" + re.escape(sep) + "]", " ")
    places = stored(column_dictionary(cells, table, column))
    body = single_cells(cells, [table, row], column, value).join(places, [table, column])
    inside = body.select(F.col(table).alias("t"), F.lit(True).alias("body"), F.col(row).alias("o"), text(row).alias("r"), "col_no", "n_cols", text(value).alias("v"))
    head = places.select(F.col(table).alias("t"), F.lit(False).alias("body"), F.lit(None).cast(cells.schema[row].dataType).alias("o"), F.lit(row).alias("r"), "col_no", "n_cols", text(column).alias("v"))
    spread = head.unionByName(inside).repartitionByRange("t", "body", "o").sortWithinPartitions("t", "body", "o", "col_no")
    # all cells of a line are in one range, because they agree in what the ranges are cut by
    kind = cells.schema[table].dataType.simpleString()
    lines = spread.mapInArrow(lambda batches: _fill_gaps(batches, sep, missing), f"t {kind}, line string")
    return lines.select(F.col("t").alias(table), F.monotonically_increasing_id().alias("line_no"), "line")


#: a line from this many bytes on leaves the task in a batch of its own
_LONG_LINE = 1 << 20


def _fill_gaps(batches: Iterator[pa.RecordBatch], sep: str, missing: str) -> Iterator[pa.RecordBatch]:
    """Sorted cells to lines; a line may run over batches. What is known of a line is held as its bytes, not as one text for each cell."""
    now: tuple | None = None
    line, parts, filled, width = bytearray(), [], 0, 0
    gap = sep + missing

    def rows(tables: list, lines: list[bytearray]) -> pa.RecordBatch:
        if len(lines) == 1:
            offsets = np.array([0, len(lines[0])], "int32")
            texts = pa.StringArray.from_buffers(1, pa.py_buffer(offsets), pa.py_buffer(lines[0]))
        else:
            texts = pa.array([bytes(x) for x in lines], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(tables, kind), texts], names=["t", "line"])

    for batch in batches:
        kind = batch.column(0).type
        tables, lines = [], []
        for t, body, o, r, at, n, v in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or (t, body, o) != now:
                if now is not None:
                    line += ("".join(parts) + gap * (width - filled)).encode()
                    tables.append(now[0])
                    lines.append(line)
                    if len(line) >= _LONG_LINE:
                        yield rows(tables, lines)
                        tables, lines = [], []
                now, line, parts, filled, width = (t, body, o), bytearray(), [r if r is not None else missing], 0, n
            parts.append(gap * (at - filled) + sep + (v if v is not None else missing))
            filled = max(filled, at) + 1
        line += "".join(parts).encode()
        parts = []
        if lines:
            yield rows(tables, lines)
    if now is not None:
        line += (gap * (width - filled)).encode()
        yield rows([now[0]], [line])


def duplicate_report(df: DataFrame, index: Sequence[str], column: str, value: str) -> DataFrame:
    """Every pair with more than one value: one row per (pair, raw value) with how often that value occurs.

    Equal values are counted before anything is gathered, so a pair repeated without end stays a short report.
    """
    keys = [*index, column]
    text = F.coalesce(F.col(value).cast("string"), F.lit("nan"))
    found = counted(df.select(*keys, text.alias("raw_value")), [*keys, "raw_value"], keys, "n_of_value")
    # rows of a pair are in one task already, and a pair has one row for each of its different values
    return found.withColumn("n_values", F.sum("n_of_value").over(Window.partitionBy(*keys))).where("n_values > 1")


def duplicate_text(report: DataFrame, keys: Sequence[str], sep: str = ";") -> DataFrame:
    """Raw values of each pair in one text cell, for exports of reports known to be short."""
    each = F.array_repeat("raw_value", F.col("n_of_value").cast("int"))
    listed = F.array_join(F.array_sort(F.flatten(F.collect_list(each))), sep)
    return report.groupBy(*keys).agg(listed.alias("raw_values"))


def table_matrices(long: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, duplicates, sizes) of every table at once, whatever its size.

    ``cells`` holds one row per (table, sample, column) with the value or blank; it is the matrix in sparse form, ready
    for ``dense_lines``. ``sizes`` says how large each dense matrix would be.
    """
    named = long.withColumn("col_name", safe_name(F.col("taxon")))
    index = ["table_id", "sample_id"]
    return single_cells(named, index, "col_name", "value"), duplicate_report(named, index, "col_name", "value"), matrix_sizes(named)


def matrix_sizes(named: DataFrame) -> DataFrame:
    """Samples, taxa, long rows and dense cells of each table; both distinct counts are two-step aggregates."""
    rows = named.groupBy("table_id", "sample_id").agg(F.count(F.lit(1)).alias("_n"))
    samples = rows.groupBy("table_id").agg(F.count(F.lit(1)).alias("n_samples"), F.sum("_n").alias("n_long_rows"))
    taxa = named.select("table_id", "col_name").distinct().groupBy("table_id").agg(F.count(F.lit(1)).alias("n_taxa"))
    return samples.join(taxa, "table_id").withColumn("n_cells", F.col("n_samples") * F.col("n_taxa"))


def taxonomy_table(long: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """One row per (table, matrix column, raw taxon): ranks, domain, and where the lineage comes from.

    ``lookup`` (dataset_id, taxon_id, lineage, source_file, file_order): the authors' own assignment, the first file wins
    and it overrides what the label says.
    """
    base = long.select("table_id", "dataset_id", "taxon").distinct().withColumn("col_name", safe_name(F.col("taxon")))
    if lookup is None:
        base = base.withColumns({"lineage": F.lit(None).cast("string"), "lineage_source_file": F.lit("")})
    else:
        first = lookup.groupBy("dataset_id", "taxon_id").agg(F.min_by(F.struct("lineage", "source_file"), "file_order").alias("_l"))
        first = first.select("dataset_id", F.col("taxon_id").alias("taxon"), "_l.lineage", F.col("_l.source_file").alias("lineage_source_file"))
        base = base.join(first, ["dataset_id", "taxon"], "left").withColumn("lineage_source_file", F.coalesce("lineage_source_file", F.lit("")))
    text = F.coalesce("lineage", "taxon")
    out = base.withColumns({"_r": split_taxonomy(text), "_d": table_domain(text)})
    stated = F.concat(*[F.col(f"_r.{r}") for r in V.LINEAGE_RANKS]) != ""
    source = F.when(F.col("lineage").isNotNull(), "from_paper_sibling_taxonomy_file").when(stated, "explicit_in_source").otherwise("no_lineage_info_in_source")
    return out.select("table_id", "col_name", F.col("taxon").alias("raw_taxon_string"), "_r.*", F.col("_d.domain").alias("domain"),
                      F.col("_d.evidence").alias("domain_evidence"), source.alias("lineage_source"), "lineage_source_file")


def domain_blocks(cells: DataFrame, features: DataFrame, sep: str = "::") -> DataFrame:
    """Nonzero cells of the listed features, ids made unique across papers.

    cells: paper_folder, sample_id, feature_id, value (text); features: paper_folder, feature_id.
    """
    kept = cells.join(features.select("paper_folder", "feature_id").distinct(), ["paper_folder", "feature_id"], "left_semi")
    uid = lambda c: F.concat("paper_folder", F.lit(sep), c)
    return nonzero(kept, "value").select("paper_folder", uid("sample_id").alias("sample_uid"), uid("feature_id").alias("feature_uid"), "value")


def is_nonzero(c: Column) -> Column:
    """Filled and not numerically zero; text that is no number is an observation."""
    number = lenient_double(c.cast("string"))
    return nonblank(c.cast("string")).isNotNull() & F.coalesce(number != 0, F.lit(True))


def nonzero(df: DataFrame, value: str) -> DataFrame:
    return df.where(is_nonzero(F.col(value)))


def claims_to_columns(claims: DataFrame, fields: Sequence[str] = V.CLAIM_FIELDS) -> DataFrame:
    """Confirmed claims become columns, the others stay beside them as JSON, with a confidence summary.

    claims: paper, sample, field, value, confidence, evidence (one row per field).
    """
    sure = (F.col("confidence") == "confirmed") & nonblank(F.col("value")).isNotNull()
    columns = [F.coalesce(F.max(F.when(sure & (F.col("field") == f), F.col("value"))), F.lit(V.UNRESOLVED)).alias(f) for f in fields]
    # a sample has at most one claim per field of a fixed list
    open_claim = F.when(~sure & nonblank(F.col("value")).isNotNull(), F.struct("field", F.struct("value", "confidence", "evidence").alias("claim")))
    order = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field"))
    proposed = F.array_sort(F.collect_list(open_claim))
    summary = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.concat_ws("=", "field", F.coalesce("confidence", F.lit("unknown"))).alias("t"))))
    evidence = F.array_sort(F.collect_list(F.when(sure & nonblank(F.col("evidence")).isNotNull(), F.struct(order.alias("o"), F.concat_ws(": ", "field", "evidence").alias("t")))))
    out = claims.where(F.col("field").isin(list(fields))).groupBy("paper", "sample").agg(*columns, proposed.alias("_p"), summary.alias("_s"), evidence.alias("_e"))
    texts = lambda c, sep: F.array_join(F.transform(c, lambda x: x["t"]), sep)
    return out.select("paper", "sample", *fields, F.when(F.size("_p") > 0, F.to_json(F.map_from_entries("_p"))).otherwise("").alias("proposed_values"),
                      texts("_s", ";").alias("metadata_confidence"), texts("_e", " | ").alias("metadata_evidence"))


def samples_from_tables(long: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per (table, sample) with its marks. manifest: table_id plus whatever describes the table."""
    return long.groupBy("table_id", "sample_id").agg(
        F.max("sample_flag").alias("sample_flag"), F.max("sequencing_type_hint").alias("sequencing_type_hint"),
    ).join(manifest, "table_id", "left")


def table_manifest(long: DataFrame, duplicates: DataFrame, files: DataFrame) -> DataFrame:
    """Per table: distinct samples and taxa, domains, blank ids, repeated cells, and the hash of the table's own file."""
    ids = ["table_id", "sample_id"]
    flags = counted(long.select(*ids, F.coalesce(F.col("sample_flag") != "", F.lit(False)).alias("_control")), [*ids, "_control"], ids, "_n")
    rows = flags.groupBy(*ids).agg(F.sum("_n").alias("_n"), F.bool_or("_control").alias("_control"))
    samples = rows.groupBy("table_id").agg(F.count(F.lit(1)).alias("n_samples"), F.sum("_n").alias("n_rows"), F.count_if("_control").alias("n_control_samples"))
    kinds = long.select("table_id", "taxon", "domain", "source_file").distinct().groupBy("table_id").agg(
        F.count(F.lit(1)).alias("n_taxa"), F.array_join(F.array_sort(F.collect_set("domain")), ";").alias("domains"), F.max("source_file").alias("source_file"))
    repeats = duplicates.select("table_id", "sample_id", "col_name").distinct().groupBy("table_id").agg(F.count(F.lit(1)).alias("n_duplicate_cells"))
    out = samples.join(kinds, "table_id").join(repeats, "table_id", "left").withColumn("n_duplicate_cells", F.coalesce("n_duplicate_cells", F.lit(0)))
    return out.join(files.select("source_file", "sha256"), "source_file", "left")


def zero_filled(df: DataFrame, row: str, column: str, value: str, columns: Sequence, name: str = "{}") -> DataFrame:
    """Wide grid with zero for pairs without a hit. Only for measured-zero data with a fixed column list."""
    picks = [F.coalesce(F.sum(F.when(F.col(column) == F.lit(c), F.col(value))), F.lit(0)).alias(name.format(c)) for c in columns]
    return df.groupBy(row).agg(*picks)


def zero_filled_long(rows: DataFrame, row: str, hits: DataFrame, column: str, value: str, columns: Sequence) -> DataFrame:
    """Long grid: every row with every listed column, zero where there is no hit (each row writes its own columns)."""
    grid = rows.select(row).distinct().select(row, F.explode(F.array(*[F.lit(c) for c in columns])).alias(column))
    return grid.join(hits.select(row, column, value), [row, column], "left").withColumn(value, F.coalesce(value, F.lit(0)))
