"""Readers: delimited text, JSON, free-header rows, table cells, FASTQ, coverage, file manifests."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.text import lenient_double, nonblank

Paths = str | Sequence[str]


def read_csv(spark: SparkSession, path: Paths, schema: str | T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Text table with a header; byte-order mark, quoted line breaks and long fields are fine; every field stays text.

    A field left out is missing, ``""`` is an empty text. Spark takes both for missing unless missing fields have a name of their own, which no file
    holds as it is new in every call. The other escape stands for none: Spark's default of none takes NUL for one.
    """
    reader = spark.read.options(header=True, multiLine=True, escape='"', charToEscapeQuoteEscaping='"', sep=sep, enforceSchema=False, encoding="UTF-8", nullValue=uuid.uuid4().hex)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_tsv(spark: SparkSession, path: Paths, schema: str | T.StructType | None = None) -> DataFrame:
    """Tab dialect; rows of blanks only are dropped."""
    df = read_csv(spark, path, schema, "\t")
    return df.where(F.coalesce(*[nonblank(F.col(f"`{c}`").cast("string")) for c in df.columns]).isNotNull())


def read_jsonl(spark: SparkSession, path: Paths, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines). Blank lines are skipped, a broken line never stops the job."""
    lines = spark.read.text(path).where(nonblank(F.col("value")).isNotNull())
    parsed = lines.select("value", F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    good = parsed.where("r._corrupt_record IS NULL").select("r.*").drop("_corrupt_record")
    return good, parsed.where("r._corrupt_record IS NOT NULL").select(F.col("value").alias("line"))


def read_json_docs(spark: SparkSession, path: Paths, schema: str | T.StructType | None = None) -> DataFrame:
    """One nested document per file, with the file it came from."""
    reader = spark.read.option("multiLine", True)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return df.withColumn("source_path", F.col("_metadata.file_path"))


def read_coverage(spark: SparkSession, path: Paths) -> DataFrame:
    """Nine-column coverage rows; short and comment rows are skipped, and no row at all is an error, not a result."""
    lines = spark.read.text(path).where(~F.startswith(F.col("value"), F.lit("#")))
    parts = F.split("value", "\t")
    rows = lines.where(F.size(parts) >= 9).select(parts.alias("p"), F.col("_metadata.file_path").alias("source_path"))
    number = lambda i: lenient_double(F.col("p")[i])
    out = rows.select("source_path", F.col("p")[0].alias("rname"), number(3).cast("bigint").alias("reads"), number(4).cast("bigint").alias("covered_bases"),
                      (number(5) / 100).alias("breadth"), number(6).alias("mean_depth"))
    if out.isEmpty():
        raise ValueError(f"no coverage rows in {path}")
    return out


def explode_parallel(df: DataFrame, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Parallel joined lists to one row per position; lists of unequal length raise."""
    lists = [F.split(F.col(c), sep) for c in columns]
    same = F.lit(True)
    for other in lists[1:]:
        same = same & (F.size(other) == F.size(lists[0]))
    # named, so that the struct fields keep the column names
    named = df.withColumns({f"_l{i}": x for i, x in enumerate(lists)}).withColumn("_same", same)
    zipped = F.arrays_zip(*[F.col(f"_l{i}") for i in range(len(columns))])
    checked = F.when(F.col("_same"), zipped).otherwise(F.raise_error(F.lit("parallel lists differ in length")))
    rest = [c for c in df.columns if c not in columns]
    out = named.select(*rest, F.posexplode(checked).alias("position", "_z"))
    return out.select(*rest, "position", *[F.col(f"_z._l{i}").alias(c) for i, c in enumerate(columns)])


def https_url(c: Column) -> Column:
    """``ftp://`` and bare hosts become ``https://``."""
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit("https://"), F.regexp_replace(c, "^ftp://", "")))


HEAD = 512  # bytes in which a web page shows itself
_CHUNK = 4 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 and first bytes of each file, read from its file system in chunks, so that memory does not depend on its size."""
    from pyarrow import fs

    for batch in batches:
        digests, heads = [], []
        for path in batch.column("path").to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            digest, head = hashlib.sha256(), b""
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(_CHUNK):
                    head = head or chunk[:HEAD]
                    digest.update(chunk)
            digests.append(digest.hexdigest())
            heads.append(head)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string()), pa.array(heads, pa.binary())], names=["path", "length", "sha256", "head"])


def file_manifest(spark: SparkSession, path: Paths) -> DataFrame:
    """File, size, SHA-256 and whether the content is a web page put in place of the file.

    Files of any size: Spark lists them and deals them by size, a task streams the bytes of its files through their file system, and no row holds content.
    Empty files have no row, because Spark lists none of them.
    """
    from ..functions.text import flag_challenge_page

    files = spark.read.format("binaryFile").load(path).select(F.replace("path", F.lit(" "), F.lit("%20")).alias("path"), "length")
    found = files.mapInArrow(_digests, "path string, length long, sha256 string, head binary").withColumn("path", F.replace("path", F.lit("%20"), F.lit(" ")))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", F.col("length").alias("size_bytes"), "sha256",
                        flag_challenge_page(F.col("head")).alias("is_challenge_page"))


# ---------------------------------------------------------------------------
# free-header tables
# ---------------------------------------------------------------------------
SEPARATORS = [",", "\t", ";"]


def _fields(line: Column, sep: str) -> Column:
    """Fields of one record; a quote opens only at the start of a field, may hide the separator, and two stand for one."""
    quoted = '"[^"]*+(?:""[^"]*+)*+"'
    raw = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{sep}({quoted}[^{sep}]*+|[^{sep}]*+)"), F.lit(1))

    def plain(f: Column) -> Column:
        inside = F.regexp_extract(f, f"^{quoted}", 0)
        opened = F.replace(F.substring(inside, F.lit(2), F.length(inside) - 2), F.lit('""'), F.lit('"'))
        return F.when(inside != "", F.concat(opened, F.substring(f, F.length(inside) + 1, F.length(f)))).otherwise(f)

    return F.transform(raw, plain)


def _lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Lines of all files with a position that grows along each file.

    Files are split as usual. The position is the block a line lies in (in units no block is smaller than), then the line's
    number within its task, so that the order needs no second pass over the files.
    """
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftright(F.col("_metadata.file_block_start"), 12)
    text = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("table_id"), (F.shiftleft(block, 33) + number).alias("line_idx"), text.alias("line"))


def _line_map(line: Column, sep: Column, inside: bool) -> Column:
    """What a line does to a reader that meets it inside or outside a quoted field: state at its end, separators outside quotes, broken closings.

    A quote opens only at the start of a field; a quote that closes must be followed by a separator or the line's end, after blanks or none.
    """
    parts = F.split(F.concat(line, sep), '"')  # the line's end is a separator, too
    steps = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts) - 1), lambda x, y: F.struct(x.alias("before"), y.alias("behind")))
    seps = lambda text: F.length(text) - F.length(F.replace(text, sep, F.lit("")))

    def acc(state: Column, n: Column, bad: Column, fresh: Column) -> Column:
        return F.struct(state.cast("int").alias("state"), n.cast("int").alias("seps"), bad.cast("int").alias("bad"), fresh.alias("fresh"))

    def at_quote(a: Column, step: Column) -> Column:
        before, behind = step["before"], step["behind"]
        opens = F.endswith(before, sep) | (a["fresh"] & (before == ""))
        # 0 outside, 1 inside, 2 behind a quote that closes unless another one follows at once
        state = F.when(a["state"] == 1, 2).when((a["state"] == 2) & (before == ""), 1).when(opens, 1).otherwise(0)
        closed = (state == 2) & (behind != "")
        fine = F.startswith(F.ltrim(behind), sep)
        counted = F.when(closed | (state == 0), seps(behind)).otherwise(0)
        return acc(F.when(closed, 0).otherwise(state), a["seps"] + counted, a["bad"] + (closed & ~fine).cast("int"), F.lit(False))

    start = acc(F.lit(int(inside)), F.lit(0) if inside else seps(F.element_at(parts, 1)), F.lit(0), F.lit(not inside))
    return F.aggregate(steps, start, at_quote, lambda a: F.struct(a["state"], (a["seps"] - (a["state"] != 1).cast("int")).alias("seps"), a["bad"]))


def _long_records(lines: DataFrame, lone: str | None) -> tuple[DataFrame, DataFrame]:
    """(records over several lines: table_id, line_idx, last), (lines that open a quote: table_id, line_idx).

    Every line is mapped for both states it may be met in, so no line waits for the ones before it. A line that opens a quote could begin a record up to
    the next line that leaves the quoted state. It does if no closing between is broken and the record has no more fields than the header, unless an
    earlier record runs into it; whether one does is again a machine of two states over the closing lines. Only lines with quotes take part, without
    their text.
    """
    from ..operators.ordering import machine_states, running, stored

    heads = stored(_headers(lines, lone).where("sep IS NOT NULL").select("table_id", "sep", "header_idx", F.size("header").alias("width")))
    quoted = lines.where(F.contains("line", F.lit('"'))).join(heads, "table_id").where("line_idx >= header_idx")
    maps = quoted.select("table_id", "line_idx", "header_idx", _line_map(F.col("line"), F.col("sep"), False).alias("out"), _line_map(F.col("line"), F.col("sep"), True).alias("in"))
    closes = F.col("in.state") != 1
    marks = running(maps, ["table_id"], "line_idx", {"part": closes.cast("long"), "seps": F.col("in.seps").cast("long"), "bad": F.col("in.bad").cast("long")})
    marks = stored(marks.select("table_id", "line_idx", "header_idx", "part", closes.alias("closes"), (F.col("out.state") == 1).alias("opens"), F.col("out.seps").alias("own"),
                                (F.col("seps") + F.col("in.seps")).alias("seps"), (F.col("bad") + F.col("in.bad")).alias("bad")))
    # a part of a file ends with the line that closes
    ends = marks.where("closes").select("table_id", "part", F.col("line_idx").alias("last"), F.col("seps").alias("end_seps"), F.col("bad").alias("end_bad"))
    openers = marks.where("opens").withColumn("part", F.col("part") + F.col("closes").cast("long")).join(ends, ["table_id", "part"])
    openers = openers.where("bad = end_bad").withColumn("fields", F.col("own") + F.col("end_seps") - F.col("seps") + 1)
    own_width = openers.where("line_idx = header_idx").select("table_id", F.col("fields").alias("own_width"))
    widths = heads.join(own_width, "table_id", "left").select("table_id", F.coalesce("own_width", "width").alias("width"))
    whole = openers.join(widths, "table_id").where("fields <= width")
    first = whole.groupBy("table_id", "part").agg(F.min(F.when(~F.col("closes"), F.col("line_idx"))).alias("first"), F.max(F.when(F.col("closes"), F.col("line_idx"))).alias("border"))
    parts = ends.select("table_id", "part", "last").join(first, ["table_id", "part"], "left")
    # state 1: a record ends with the line before this part, so that line begins none
    met = machine_states(parts, ["table_id"], "part", F.col("first").isNotNull() | F.col("border").isNotNull(), F.col("first").isNotNull())
    begin = F.when((F.col("state") == 0) & F.col("border").isNotNull(), F.col("border")).otherwise(F.col("first"))
    return met.select("table_id", begin.alias("line_idx"), "last").where("line_idx IS NOT NULL"), marks.where("opens").select("table_id", "line_idx")


def _records(lines: DataFrame, lone: str | None = None) -> DataFrame:
    """Records of all files: table_id, line_idx, line, odd. Lines of a record over line breaks are joined; ``odd`` marks a quote that never closes."""
    from ..operators.ordering import running, stored

    found, opening = _long_records(lines, lone)
    found = stored(found)
    odd = opening.join(found, ["table_id", "line_idx"], "left_anti").withColumn("odd", F.lit(True))
    torn = found.select("table_id").distinct()
    plain = lines.join(torn, "table_id", "left_anti").select("table_id", "line_idx", "line")
    # in files with long records a line belongs to the last record that began before it, if that has not ended; places are enough to tell
    held = lines.join(torn, "table_id", "left_semi")
    starts = held.select("table_id", "line_idx").join(found, ["table_id", "line_idx"], "left")
    last = running(starts, ["table_id"], "line_idx", highs={"_open": F.when(F.col("last").isNotNull(), F.struct("line_idx", "last"))})
    owner = last.where(F.col("line_idx") <= F.col("_open.last")).select("table_id", "line_idx", F.col("_open.line_idx").alias("_owner"))
    owned = held.join(owner, ["table_id", "line_idx"], "left").select("table_id", F.coalesce("_owner", "line_idx").alias("_record"), "line_idx", "line")
    joined = owned.groupBy("table_id", "_record").agg(F.array_sort(F.collect_list(F.struct("line_idx", "line"))).alias("_l"))
    whole = joined.select("table_id", F.col("_record").alias("line_idx"), F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("line"))
    # joined to each part by itself: whole records are dealt by their places already
    records = plain.join(odd, ["table_id", "line_idx"], "left").unionByName(whole.join(odd, ["table_id", "line_idx"], "left"))
    return records.select("table_id", "line_idx", "line", F.coalesce("odd", F.lit(False)).alias("odd"))


def _headers(lines: DataFrame, lone: str | None = None) -> DataFrame:
    """Separator, header line and header fields per file; ``sep`` is blank, or ``lone``, where no separator splits the header.

    Separators are tried in order and the first that gives more than one column wins. The header is the first line that is no ``#`` note, or
    the last note before it if that splits into several fields itself. Any number of notes may come first.
    """
    filled = lines.where("line <> ''")
    note = F.startswith(F.ltrim(F.col("line")), F.lit("#"))
    row = F.struct("line_idx", "line")
    plain = filled.groupBy("table_id").agg(F.min_by(row, F.when(~note, F.col("line_idx"))).alias("plain"))
    before = filled.where(note).join(plain, "table_id").where("plain IS NULL OR line_idx < plain.line_idx")
    notes = before.groupBy("table_id").agg(F.max_by(row, F.col("line_idx")).alias("note"))
    both = plain.join(notes, "table_id", "left")

    def option(sep: str) -> Column:
        several = F.coalesce(F.size(F.filter(F.split("note.line", sep), lambda f: F.trim(f) != "")) > 1, F.lit(False))
        chosen = F.when(several, F.col("note")).otherwise(F.col("plain"))
        return F.struct(F.lit(sep).alias("sep"), chosen["line_idx"].alias("header_idx"), _fields(chosen["line"], sep).alias("header"))

    options = F.array(*[option(s) for s in SEPARATORS])
    usable = F.filter(options, lambda o: F.coalesce(F.size(o["header"]) > 1, F.lit(False)))
    found = F.try_element_at(usable, F.lit(1)) if lone is None else F.coalesce(F.try_element_at(usable, F.lit(1)), option(lone))
    return both.select("table_id", found.alias("o")).select("table_id", "o.*")


def _parsed(lines: DataFrame, lone: str | None = None) -> DataFrame:
    """Body records with the header of their file and their own fields: table_id, line_idx, line, odd, header, f."""
    body = lines.where("line <> ''").join(_headers(lines, lone).where("sep IS NOT NULL"), "table_id").where("line_idx > header_idx")
    split = F.when(F.col("sep") == ",", _fields(F.col("line"), ",")).when(F.col("sep") == "\t", _fields(F.col("line"), "\t")).otherwise(_fields(F.col("line"), ";"))
    return body.select("table_id", "line_idx", "line", "odd", "header", split.alias("f"))


def read_table_cells(spark: SparkSession, path: Paths, missing: Sequence[str] | None = V.MISSING_TEXT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, malformed lines, unreadable files) of delimited files of any dialect, parsed in parallel inside and across files.

    Short lines are padded with missing cells; lines with too many fields, or with a quote that never closes, are reported, not guessed at;
    a file that no separator splits is reported with the reason.
    """
    lines = _records(_lines(spark, path))
    parsed = _parsed(lines)
    reason = F.when(F.col("odd"), "quote that never closes").when(F.size("f") > F.size("header"), "more fields than the header")
    judged = parsed.withColumn("reason", reason)
    cells = judged.where("reason IS NULL").select("table_id", F.col("line_idx").alias("row_idx"), "f", F.posexplode("header").alias("col_idx", "col_name"))
    value = F.try_element_at("f", F.col("col_idx") + 1)
    if missing is not None:
        value = F.when(~value.isin(list(missing)), value)
    unreadable = _headers(lines).where("sep IS NULL").select("table_id", F.lit("no separator splits the header").alias("reason"))
    return (cells.select("table_id", "row_idx", "col_idx", "col_name", value.alias("value")),
            judged.where("reason IS NOT NULL").select("table_id", "line_idx", "line", "reason"), unreadable)


def read_rows_as_map(spark: SparkSession, path: Paths, key: Column | None = None) -> DataFrame:
    """Rows of files that each have their own header: paper_folder, row_idx, row map(header -> text).

    ``key`` turns the file path (column ``path``) into the paper; default: the parent folder. Line breaks inside quotes are fine, and files are split as
    usual; ``row_idx`` grows along a file. A file that no separator splits has one column.
    """
    folder = F.element_at(F.split("path", "/"), -2) if key is None else key
    # a record holds its whole row, so the map is built in place; of repeated headers the first counts
    pairs = F.transform("header", lambda h, i: F.struct(h.alias("key"), F.coalesce(F.try_element_at("f", i + 1), F.lit("")).alias("value"), i.alias("i")))
    kept = F.filter(pairs, lambda p: (p["key"] != "") & (F.array_position("header", p["key"]) == p["i"] + 1))
    row = F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"], p["value"])))
    records = _records(_lines(spark, path), lone=",")
    return _parsed(records, lone=",").withColumn("path", F.col("table_id")).select(folder.alias("paper_folder"), F.col("line_idx").alias("row_idx"), row.alias("row"))


def read_fastq(spark: SparkSession, path: Paths, n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(reads, broken records) of FASTQ files, plain or gzip: path, read_idx, header, seq, qual; ``n`` keeps the first reads of each file.

    Files are read as lines and split as usual; a line's rank in its file says to which record it belongs. A last record with lines
    missing, or one whose sequence and qualities differ in length, is broken: path, read_idx, n_lines.
    """
    from ..operators.ordering import ranked

    lines = _lines(spark, path).withColumnRenamed("table_id", "path")
    placed = ranked(lines, ["path"], "line_idx", name="_spot").withColumn("_spot", F.col("_spot") - 1)
    record, part = F.floor(F.col("_spot") / 4), F.col("_spot") % 4
    text = lambda i: F.max(F.when(F.col("_part") == i, F.trim("line")))
    found = placed.select("path", record.alias("read_idx"), part.alias("_part"), "line").groupBy("path", "read_idx").agg(
        F.count(F.lit(1)).alias("n_lines"), text(0).alias("header"), text(1).alias("seq"), text(3).alias("qual"))
    if n is not None:
        found = found.where(F.col("read_idx") < n)
    whole = F.coalesce((F.col("n_lines") == 4) & (F.length("seq") == F.length("qual")), F.lit(False))
    return found.where(whole).select("path", "read_idx", "header", "seq", "qual"), found.where(~whole & (F.col("header") != "")).select("path", "read_idx", "n_lines")
