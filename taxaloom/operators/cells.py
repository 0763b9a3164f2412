"""All deposited tables as one cell table, judged in one job.

Cell table: ``table_id, row_idx, col_idx, col_name, value`` (text, NULL = missing).  Statistics are aggregates over
(table, column) or (table, row), so a table of any size is spread over the cluster and partially aggregated first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import blank, case_when, matches
from ..functions.taxa import looks_taxonomic
from ..functions.text import lenient_double, nonblank, trim_ws
from .ordering import stored

COL = ["table_id", "col_idx"]


def cells_of(df: DataFrame, table_id: Column | str, row_idx: str, columns: Sequence[str], first_col: int = 0) -> DataFrame:
    """Unpivot a wide DataFrame into cells, map-side only."""
    tid = F.lit(table_id) if isinstance(table_id, str) else table_id
    cells = [
        F.struct(F.lit(first_col + i).alias("col_idx"), F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(columns)
    ]
    return df.select(tid.alias("table_id"), F.col(row_idx).cast("bigint").alias("row_idx"), F.inline(F.array(*cells)))


def median_below(v: Column, limit: float) -> Column:
    """Aggregate: is the median of v below the limit? Counts and two extremes decide it, no values are gathered."""
    n, k = F.count(v), F.count_if(v < limit)
    below, above = F.max(F.when(v < limit, v)), F.min(F.when(v >= limit, v))
    return F.when(2 * k > n, F.lit(True)).when(2 * k < n, F.lit(False)).otherwise((below + above) / 2 < limit)


def table_sizes(cells: DataFrame) -> DataFrame:
    """n_rows (all rows), n_filled_rows and n_cols per table."""
    rows = cells.groupBy("table_id", "row_idx").agg(
        F.max(F.col("value").isNotNull()).alias("_filled"), F.max("col_idx").alias("_last"))
    return rows.groupBy("table_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_filled").alias("n_filled_rows"), (F.max("_last") + 1).alias("n_cols"))


def column_stats(cells: DataFrame) -> DataFrame:
    """Per column, in one pass over all values: filled and numeric cells, extremes, sum, whether all numbers are whole; and of the values
    that are not blank the shares that read like taxa, like lineage lists, like ranks, and whether most are files or paths."""
    number = F.col("_number")
    whole = F.abs(number - F.round(number)) <= 1e-8 + 1e-5 * F.abs(F.round(number))
    share = lambda test: F.avg(F.when(~blank(F.col("value")), test.cast("int")))
    text = trim_ws(F.col("value"))
    return cells.withColumn("_number", lenient_double(F.col("value"))).groupBy("table_id", "col_idx", "col_name").agg(
        F.count("value").alias("n_filled"), F.count(number).alias("n_numeric"), F.sum(number).alias("total"),
        F.min(number).alias("lowest"), F.max(number).alias("highest"), F.bool_and(whole).alias("whole"),
        share(looks_taxonomic(text)).alias("taxa_fraction"), share(F.col("value").contains(";")).alias("list_fraction"), share(matches(text, V.RANK_PREFIX, True)).alias("rank_fraction"),
        F.coalesce((share(matches(F.col("value"), V.READ_FILE_NAME, True)) > 0.5) | (share(matches(F.col("value"), V.TWO_SLASHES)) > 0.5), F.lit(False)).alias("pathlike"))


def column_facts(cells: DataFrame) -> DataFrame:
    """``column_stats`` beside the sizes of each column's table, written once: every judgement about tables reads these few rows, not the cells."""
    return stored(column_stats(cells).join(table_sizes(cells), "table_id"))


def sizes_of(facts: DataFrame) -> DataFrame:
    return facts.select("table_id", "n_rows", "n_filled_rows", "n_cols").distinct()


def drop_empty(cells: DataFrame) -> DataFrame:
    """Remove columns, then rows, without any filled cell."""
    filled = cells.where(F.col("value").isNotNull())
    kept = cells.join(filled.select(*COL).distinct(), COL, "left_semi")
    return kept.join(filled.select("table_id", "row_idx").distinct(), ["table_id", "row_idx"], "left_semi")


def numeric_columns(cells: DataFrame, min_frac: float, of_filled: bool = False) -> DataFrame:
    """Columns whose share of numeric cells exceeds ``min_frac`` of the non-empty rows (or reaches it, of filled cells)."""
    stats = column_stats(cells).where("n_filled > 0")
    if of_filled:
        return stats.withColumn("fraction", F.col("n_numeric") / F.col("n_filled")).where(F.col("fraction") >= min_frac)
    sized = stats.join(table_sizes(cells).select("table_id", "n_filled_rows"), "table_id")
    return sized.withColumn("fraction", F.col("n_numeric") / F.col("n_filled_rows")).where(F.col("fraction") > min_frac)


def pathlike_columns(cells: DataFrame) -> DataFrame:
    """Columns whose values are mostly read files or paths."""
    return column_stats(cells).where("pathlike").select(*COL)


def taxa_fraction(cells: DataFrame) -> DataFrame:
    """Share of taxonomic values among the values of every column that has any."""
    return column_stats(cells).where("taxa_fraction IS NOT NULL").select(*COL, "taxa_fraction")


def sniff(cells: DataFrame, known_ids: DataFrame | None = None, axis_aware: bool = True, facts: DataFrame | None = None) -> DataFrame:
    """Verdict per table: is it an abundance table, which layout, which label column, which value type. ``facts`` are the cells' ``column_facts``.

    ``known_ids`` (table_id, taxon_id): ids a sibling lookup gives a lineage to; they rescue tables of bare ids.
    """
    facts = column_facts(cells) if facts is None else facts
    sizes = sizes_of(facts)
    stats = facts.where("n_filled > 0")
    stats = stats.withColumn("numeric", F.col("n_numeric") / F.col("n_filled_rows") > 0.80)

    low = F.lower(trim_ws(F.col("col_name")))
    header = stats.groupBy("table_id").agg(
        F.bool_or(low.isin(V.RANK_HEADERS)).alias("_tax"), F.bool_or(matches(F.col("col_name"), V.ABUNDANCE_HEADER, True)).alias("_abund"),
        F.bool_or(matches(F.col("col_name"), V.SAMPLE_HEADER, True)).alias("_samp"), F.count_if("numeric").alias("n_numeric_cols"),
        F.coalesce(F.avg(F.when(low != "", looks_taxonomic(trim_ws(F.col("col_name"))).cast("int"))), F.lit(0.0)).alias("_col_best"))

    labels = stats.where(~F.col("numeric") & F.col("taxa_fraction").isNotNull()).select(*COL, "col_name", F.col("taxa_fraction").alias("_f"), F.col("pathlike").alias("_path"))
    if known_ids is None:
        scored = labels.withColumn("_idf", F.lit(0.0))
        header = header.withColumn("_id_col_best", F.lit(0.0))
    else:
        ids = known_ids.select("table_id", F.col("taxon_id").alias("_id")).distinct().withColumn("_known", F.lit(True))
        # only a table with ids can hold one of them; its columns are written, so that Spark knows how few they are and no table's cells are sent to one task
        asked = stored(labels.join(ids.select("table_id"), "table_id", "left_semi").select(*COL))
        text = cells.where(~blank(F.col("value"))).join(asked, COL, "left_semi").groupBy(*COL, trim_ws(F.col("value")).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
        known = text.join(ids, ["table_id", "_id"], "left").groupBy(*COL).agg((F.sum(F.when(F.col("_known"), F.col("_n")).otherwise(0)) / F.sum("_n")).alias("_idf"))
        scored = stored(labels.join(known, COL, "left").withColumn("_idf", F.coalesce("_idf", F.lit(0.0))))
        names = stats.select("table_id", trim_ws(F.col("col_name")).alias("_id")).join(ids, ["table_id", "_id"], "left")
        header = header.join(names.groupBy("table_id").agg(F.avg(F.coalesce("_known", F.lit(False)).cast("int")).alias("_id_col_best")), "table_id", "left")
    usable = scored.where(~F.col("_path"))
    best = usable.groupBy("table_id").agg(
        F.max_by(F.struct(F.col("_f").alias("f"), "col_idx", "col_name"), F.struct("_f", -F.col("col_idx"))).alias("_row"),
        F.max_by(F.struct(F.col("_idf").alias("f"), "col_idx", "col_name"), F.struct("_idf", -F.col("col_idx"))).alias("_idrow"))

    v = sizes.join(header, "table_id").join(best, "table_id", "left")
    row_best = F.coalesce(F.col("_row.f"), F.lit(0.0))
    id_row, id_col = F.coalesce(F.col("_idrow.f"), F.lit(0.0)), F.coalesce(F.col("_id_col_best"), F.lit(0.0))
    first_rows = row_best >= F.col("_col_best")
    first_frac = F.greatest(row_best, F.col("_col_best"))
    rescue_rows = (first_frac < V.MIN_TAXA_FRACTION) & (id_row >= id_col) & (id_row > first_frac)
    rescue_cols = (first_frac < V.MIN_TAXA_FRACTION) & ~rescue_rows & (id_col > first_frac)
    v = v.withColumns({
        "_rescued": rescue_rows | rescue_cols,
        "axis": case_when([(rescue_rows, F.lit("rows")), (rescue_cols, F.lit("cols")), (first_rows, F.lit("rows"))], F.lit("cols")),
        "score": case_when([(rescue_rows, id_row), (rescue_cols, id_col)], first_frac),
        "_label": case_when([(rescue_rows, F.col("_idrow")), (rescue_cols, F.lit(None).cast("struct<f:double,col_idx:int,col_name:string>")),
                             (first_rows & (row_best > 0), F.col("_row"))], F.lit(None).cast("struct<f:double,col_idx:int,col_name:string>")),
    })
    small = (F.col("n_rows") < 5) | (F.col("n_cols") < 2)
    long_form = F.col("_tax") & F.col("_abund") & F.col("_samp") & (F.col("n_rows") >= 10)
    few = F.col("n_numeric_cols") < 3
    accept, review = F.col("score") >= V.MIN_TAXA_FRACTION, F.col("score") >= V.REVIEW_TAXA_FRACTION
    kind = case_when([(small, F.lit("none")), (long_form, F.lit("long")), (few, F.lit("none")), (review, F.lit("wide"))], F.lit("none"))
    wide = kind == "wide"
    reason = case_when(
        [(small, F.lit("too small")), (long_form, F.lit("sample/taxon/abundance columns")), (few, F.lit("fewer than 3 numeric columns")),
         (accept, F.lit("looks taxonomic")), (review, F.lit("weak taxonomic signal"))], F.lit("no taxonomic signal"))
    scored_wide = ~small & ~long_form & ~few
    verdict = stored(v.select(
        "table_id", "n_rows", "n_cols", "n_numeric_cols", (kind != "none").alias("is_abundance"), kind.alias("kind"),
        F.when(scored_wide, F.col("axis")).otherwise(F.lit("")).alias("axis"),
        F.when(scored_wide, F.col("_label.col_idx")).alias("label_idx"), F.when(scored_wide, F.col("_label.col_name")).alias("label_col"),
        case_when([(small | few & ~long_form, F.lit(0.0)), (long_form, F.lit(0.9))], F.col("score")).alias("score"),
        (wide & ~accept).alias("needs_review"), (scored_wide & F.col("_rescued")).alias("id_matched_lineage"), reason.alias("reason")))
    types = value_type(cells, stats.where("numeric"), verdict if axis_aware else None)
    typed = verdict.join(types, "table_id", "left")
    return typed.withColumn("value_type", F.when(F.col("axis") != "", F.coalesce("value_type", F.lit("unknown"))).otherwise(F.lit("unknown")))


def value_type(cells: DataFrame, numeric: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """relative_fraction / relative_percent / count / unknown from the sums along the sample axis. ``numeric``: the numeric columns with their ``column_stats``.

    Samples are columns where taxa are in rows, and rows where taxa are in columns. Without verdicts the sums are
    always those of the columns, which are facts already; cells are read only of tables whose samples are rows.
    """
    sums = numeric.groupBy(*COL).agg(F.sum("total").alias("s"), F.bool_and("whole").alias("whole"), F.max("highest").alias("hi")).drop("col_idx")
    if verdicts is not None:
        turned = verdicts.where("axis = 'cols'").select("table_id")
        number = F.col("v")
        whole = F.abs(number - F.round(number)) <= 1e-8 + 1e-5 * F.abs(F.round(number))
        # written, so that Spark knows how few columns these are: a table's cells stay where they lie until its rows are summed
        inside = stored(numeric.join(turned, "table_id", "left_semi").select(*COL))
        values = cells.join(inside, COL, "left_semi").select("table_id", "row_idx", lenient_double(F.col("value")).alias("v")).where("v IS NOT NULL")
        rows = values.groupBy("table_id", "row_idx").agg(F.sum("v").alias("s"), F.bool_and(whole).alias("whole"), F.max("v").alias("hi")).drop("row_idx")
        sums = sums.join(turned, "table_id", "left_anti").unionByName(rows)
    positive = F.when(F.col("s") > 0, F.col("s"))
    judged = sums.groupBy("table_id").agg(
        median_below(F.abs(positive - 1), 0.02).alias("_frac"), median_below(F.abs(positive - 100), 1.0).alias("_pct"),
        F.bool_and("whole").alias("_whole"), F.max("hi").alias("_hi"))
    return judged.select("table_id", case_when(
        [(F.coalesce("_frac", F.lit(False)), F.lit("relative_fraction")), (F.coalesce("_pct", F.lit(False)), F.lit("relative_percent")),
         (F.col("_whole") & (F.col("_hi") > 10), F.lit("count"))], F.lit("unknown")).alias("value_type"))


def lookup_tables(cells: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Tables that map ids to lineages: one joined lineage column, or two and more columns of prefixed ranks. ``facts`` are the cells' ``column_facts``.

    Result: table_id, mode, lineage_cols array<int>.
    """
    other = (column_facts(cells) if facts is None else facts).where("col_idx > 0")
    numeric = other.groupBy("table_id").agg(F.avg(F.col("n_numeric") / F.col("n_rows")).alias("_numeric"))
    per_col = other.where("taxa_fraction IS NOT NULL")
    single = F.when((F.col("list_fraction") > 0.3) & (F.col("taxa_fraction") > 0.5), F.col("col_idx"))
    # column lists are bounded by the header of one file
    judged = per_col.groupBy("table_id").agg(
        F.min(single).alias("_single"), F.array_sort(F.collect_list(F.when(F.col("rank_fraction") > 0.3, F.col("col_idx")))).alias("_multi"))
    judged = judged.join(numeric, "table_id").where("_numeric <= 0.2")
    mode = F.when(F.col("_single").isNotNull(), F.lit("single_col")).when(F.size("_multi") >= 2, F.lit("multi_col"))
    cols = F.when(F.col("_single").isNotNull(), F.array("_single")).otherwise(F.col("_multi"))
    return judged.select("table_id", mode.alias("mode"), cols.alias("lineage_cols")).where("mode IS NOT NULL")


def id_to_lineage(cells: DataFrame, lookups: DataFrame) -> DataFrame:
    """table_id, taxon_id, lineage out of the lookup tables; a repeated id keeps its last row."""
    inside = cells.join(lookups.select("table_id", "lineage_cols"), "table_id")
    wanted = (F.col("col_idx") == 0) | F.array_contains("lineage_cols", F.col("col_idx"))
    value = nonblank(F.col("value"))
    rows = inside.where(wanted & value.isNotNull()).groupBy("table_id", "row_idx").agg(
        F.max(F.when(F.col("col_idx") == 0, value)).alias("taxon_id"),
        F.array_sort(F.collect_list(F.when(F.col("col_idx") > 0, F.struct("col_idx", value.alias("v"))))).alias("_parts"))
    joined = F.array_join(F.transform("_parts", lambda p: p["v"]), ";")
    lines = rows.where("taxon_id IS NOT NULL AND size(_parts) > 0").select("table_id", "row_idx", "taxon_id", joined.alias("lineage"))
    return lines.groupBy("table_id", "taxon_id").agg(F.max_by("lineage", "row_idx").alias("lineage"))


def triage_tables(cells: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Conservative class of a table from its name, its headers, all its values and its numbers: table_id, triage.

    A pattern counts when it fits the name, the header line or any cell; cells are tested where they lie, nothing is joined to one text.
    """
    filled = cells.where("value IS NOT NULL")
    patterns = [pattern for _, pattern in V.TRIAGE_TEXT] + [V.TRIAGE_ABUNDANCE]
    columns = column_stats(filled).where("n_filled > 0")
    numeric = F.col("n_numeric") / F.col("n_filled") >= 0.9
    header = columns.groupBy("table_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "col_name"))), lambda s: s["col_name"]), " ").alias("_header"),
        F.count_if(numeric).alias("_numeric"), F.coalesce(F.bool_or(numeric & (F.col("lowest") < 0)), F.lit(False)).alias("_negative"))
    body = filled.groupBy("table_id").agg(*[F.bool_or(matches(F.lower("value"), p)).alias(f"_b{i}") for i, p in enumerate(patterns)])
    both = header.join(body, "table_id")
    both = both.join(names, "table_id", "left") if names is not None else both.withColumn("name", F.col("table_id"))
    head = F.lower(F.concat_ws(" ", "name", "_header"))
    found = [matches(head, p) | F.col(f"_b{i}") for i, p in enumerate(patterns)]
    branches = [(hit, F.lit(label)) for hit, (label, _) in zip(found, V.TRIAGE_TEXT)]
    branches += [((F.col("_numeric") < 2) | F.col("_negative"), F.lit("needs_review")), (found[-1], F.lit("possible_abundance"))]
    return both.select("table_id", case_when(branches, F.lit("needs_review")).alias("triage"))


def triage_files(tables: DataFrame) -> DataFrame:
    """File verdict out of its tables (file_id, triage): possible abundance wins, one common class holds, else review."""
    return tables.groupBy("file_id").agg(
        F.when(F.bool_or(F.col("triage") == "possible_abundance"), F.lit("possible_abundance"))
        .when(F.min("triage") == F.max("triage"), F.min("triage")).otherwise(F.lit("needs_review")).alias("triage"))
