"""Readers and sinks on literal files."""

import gzip
import hashlib
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import oracle
from taxaloom.operators import ordering
from taxaloom.sources import readers, writers


def put(folder, name, text, mode="w"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def test_csv_dialects(spark, tmp_path):
    path = put(tmp_path, "a.csv", '﻿id,note\r\n1,"two\nlines, ""q"""\r\n2,\r\n')
    df = readers.read_csv(spark, path)
    assert df.columns == ["id", "note"] and [tuple(r) for r in df.collect()] == [("1", 'two\nlines, "q"'), ("2", None)]
    tsv = put(tmp_path, "a.tsv", "x\ty\n1\t2\n \t \n3\t\n")
    assert [tuple(r) for r in readers.read_tsv(spark, tsv).collect()] == [("1", "2"), ("3", None)]
    assert readers.read_tsv(spark, put(tmp_path, "b.tsv.gz", "x\ty\n1\t2\n")).count() == 1


def test_headed_tables_keep_empty_texts_and_nul(spark, tmp_path):
    path = put(tmp_path, "e.tsv", 'k\ttext\n1\t""\n2\t\n3\t"a\x00""b\x00"\n\t""\n4\t"""\x00\tb"\n')
    want = [("1", ""), ("2", None), ("3", 'a\x00"b\x00'), ("4", '"\x00\tb')]
    assert [tuple(r) for r in readers.read_tsv(spark, path, "k string, text string").collect()] == want
    assert [tuple(r) for r in readers.read_tsv(spark, path).collect()] == want


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Customers, documents and suppliers with missing, empty and blank values, quotes and NUL."""
    texts = [None, "", " ", "\t", "\n", "\r", "a\r\nb", '"', '"",', 'a\x00"b', '"\x00', "\x00", "null", "#", "\\\""]
    two = [(i, v) for i, v in enumerate(texts)] + [(None, None), (None, "")]
    three = [(10 * i + j, v, w) for i, v in enumerate(texts) for j, w in enumerate([None, "", "en", "\t"])] + [(None, None, None), (None, " ", "")]
    spark.createDataFrame(two, "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(two, "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame(three, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_headed_tables_agrees_with_sql_on_odd_values(spark, odd_tables):
    con = duckdb.connect()
    for name in ("customer", "supplier", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{odd_tables}/{name}.parquet/*.parquet'")
    assert oracle.compare(spark, con, "headed_tables", odd_tables) is None


def test_jsonl_and_documents(spark, tmp_path):
    path = put(tmp_path, "p.jsonl", '{"paper_id":"a","status":"done"}\n\n{broken\n{"paper_id":"b"}\n')
    good, bad = readers.read_jsonl(spark, path, "paper_id string, status string")
    assert sorted(tuple(r) for r in good.collect()) == [("a", "done"), ("b", None)] and [r.line for r in bad.collect()] == ["{broken"]
    doc = put(tmp_path, "facts.json", '{\n "amplicon": {"status": "verified", "trim_left": [17, 21]}\n}')
    row = readers.read_json_docs(spark, doc).first()
    assert row.amplicon.trim_left == [17, 21] and row.source_path.endswith("facts.json")


def test_table_cells_of_any_dialect(spark, tmp_path):
    put(tmp_path, "t/biom.tsv", "# Constructed from biom file\n#OTU ID\ts1\ts2\nA\t1\t2\nB\tNA\t\n")
    put(tmp_path, "t/prose.csv", "# a note\nname,x,x\n\"q,1\",2,\"say \"\"hi\"\"\"\nshort,5\nlong,1,2,3\n")
    put(tmp_path, "t/semi.txt", "﻿a;b\r\n1;\r\n")
    put(tmp_path, "t/one.txt", "no separator here\n")
    put(tmp_path, "t/notes.tsv", "".join(f"# note {i}\n" for i in range(9)) + "#OTU ID\ts1\nA\t1\n")
    put(tmp_path, "t/torn.csv", "id,note,n\n1,\"two\nlines\",5\n2,plain,6\n")
    put(tmp_path, "t/open.csv", "id,note\n1,5\" pipe\n2,x\n")
    cells, bad, unreadable = readers.read_table_cells(spark, [str(tmp_path / "t")])
    got = {}
    for r in cells.collect():
        got.setdefault(r.table_id.rsplit("/", 1)[1], {}).setdefault(r.row_idx, {})[r.col_idx] = (r.col_name, r.value)
    table = {name: [list(row[j] for j in sorted(row)) for _, row in sorted(rows.items())] for name, rows in got.items()}
    assert table["biom.tsv"] == [[("#OTU ID", "A"), ("s1", "1"), ("s2", "2")], [("#OTU ID", "B"), ("s1", None), ("s2", None)]]
    assert table["prose.csv"] == [[("name", "q,1"), ("x", "2"), ("x", 'say "hi"')], [("name", "short"), ("x", "5"), ("x", None)]]
    assert table["semi.txt"] == [[("a", "1"), ("b", None)]] and "one.txt" not in table
    assert table["notes.tsv"] == [[("#OTU ID", "A"), ("s1", "1")]]
    assert table["torn.csv"] == [[("id", "1"), ("note", "two\nlines"), ("n", "5")], [("id", "2"), ("note", "plain"), ("n", "6")]]
    assert table["open.csv"] == [[("id", "1"), ("note", '5" pipe')], [("id", "2"), ("note", "x")]]
    assert [(r.line, r.reason) for r in bad.collect()] == [("long,1,2,3", "more fields than the header")]
    assert [r.table_id.rsplit("/", 1)[1] for r in unreadable.collect()] == ["one.txt"]


def test_cells_of_a_split_file_keep_line_order(spark, tmp_path):
    text = "k,v\n" + "".join(f"r{i},{i}\n" for i in range(5000))
    path = put(tmp_path, "big.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        cells, bad, _ = readers.read_table_cells(spark, path)
        values = [int(r.value) for r in cells.where("col_idx = 1").orderBy("row_idx").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert values == list(range(5000)) and bad.count() == 0
    assert cells.select("row_idx").distinct().count() == 5000


def test_rows_as_map(spark, tmp_path):
    put(tmp_path, "m/P1/sample_metadata.csv", "Sample_ID,Host\nS1,pig\n")
    put(tmp_path, "m/P2/sample_metadata.csv", "id,note\nS2,\"a\nb\"\n")
    rows = {r.paper_folder: r.row for r in readers.read_rows_as_map(spark, str(tmp_path / "m" / "*")).collect()}
    assert rows == {"P1": {"Sample_ID": "S1", "Host": "pig"}, "P2": {"id": "S2", "note": "a\nb"}}
    plain = readers.read_rows_as_map(spark, str(tmp_path / "m" / "P1")).first()
    assert plain.paper_folder == "P1" and plain.row == {"Sample_ID": "S1", "Host": "pig"}


def test_coverage_and_fastq(spark, tmp_path):
    path = put(tmp_path, "c.tsv", "#rname\tstartpos\tendpos\tnumreads\tcovbases\tcoverage\tmeandepth\tmeanbaseq\tmeanmapq\ng1\t1\t100\t7\t75\t75.0\t1.5\t30\t40\nshort\t1\n")
    assert [tuple(r)[1:] for r in readers.read_coverage(spark, path).collect()] == [("g1", 7, 75, 0.75, 1.5)]
    with pytest.raises(ValueError):
        readers.read_coverage(spark, put(tmp_path, "empty.tsv", "#rname\n"))
    put(tmp_path, "f/a_1.fastq.gz", "@h1 x\nACGT\n+\nIIII\n@h2\nAC\n+\nII\n")
    put(tmp_path, "f/b.fastq", "@h3\nGG\n+\n!!\n")
    put(tmp_path, "f/cut.fastq", "@h4\nGG\n+\n!!\n@h5\nGG\n+\n")
    reads, broken = readers.read_fastq(spark, str(tmp_path / "f"))
    assert sorted((r.read_idx, r.header, r.seq, r.qual) for r in reads.collect()) == [(0, "@h1 x", "ACGT", "IIII"), (0, "@h3", "GG", "!!"), (0, "@h4", "GG", "!!"), (1, "@h2", "AC", "II")]
    assert [(r.path.rsplit("/", 1)[1], r.read_idx, r.n_lines) for r in broken.collect()] == [("cut.fastq", 1, 3)]
    assert readers.read_fastq(spark, str(tmp_path / "f"), n=1)[0].count() == 3


def test_parallel_lists_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("r", "ftp://a;b", "1;2")], "run string, url string, md5 string")
    out = readers.explode_parallel(df, ["url", "md5"]).withColumn("url", readers.https_url(F.col("url")))
    assert [tuple(r) for r in out.collect()] == [("r", 0, "https://a", "1"), ("r", 1, "https://b", "2")]
    with pytest.raises(Exception, match="differ in length"):
        readers.explode_parallel(df.withColumn("md5", F.lit("1")), ["url", "md5"]).collect()
    put(tmp_path, "d/page.xlsx", "<!DOCTYPE html>")
    put(tmp_path, "d/t.csv", "a,b")
    got = {r.file_name: (r.size_bytes, r.is_challenge_page) for r in readers.file_manifest(spark, str(tmp_path / "d")).collect()}
    assert got == {"page.xlsx": (15, True), "t.csv": (3, False)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    writers.write_table(df, str(tmp_path / "out"), ["k"])
    text = next((tmp_path / "out").glob("*.csv")).read_bytes().decode("utf-8")
    assert text == "﻿k,n\na,1\nb,2\n"
    target = str(tmp_path / "log")
    assert writers.append_rows(df, target, ["k"]) == 2
    more = spark.createDataFrame([("b", 9), ("c", 3), ("c", 4)], "k string, n int")
    assert writers.append_rows(more, target, ["k"]) == 2 and writers.read_table(spark, target).count() == 4
    assert writers.append_rows(more, target, ["k"]) == 0 and writers.read_table(spark, target).count() == 4
    for n in (1, 2):
        assert writers.replace_table(df.where(F.col("n") <= n), str(tmp_path / "swap")) == n
        assert writers.read_table(spark, str(tmp_path / "swap")).count() == n
    with pytest.raises(FileNotFoundError):
        writers.read_table(spark, str(tmp_path / "nothing"))
    writers.split_outputs(df, "k", str(tmp_path / "parts"))
    assert sorted(p.name for p in (tmp_path / "parts").glob("k=*")) == ["k=a", "k=b"]


RECORDS = {
    "inches": ("id,note\n1,5\" pipe\n2,plain\n3,6\" pipe\n4,x\n", ["1,5\" pipe", "2,plain", "3,6\" pipe", "4,x"], []),
    "torn": ("id,note,n\n1,\"two\nand \"\" more\n\nlines\",5\n2,x,6\n", ["1,\"two\nand \"\" more\n\nlines\",5", "2,x,6"], []),
    "open at the end": ("id,note\n1,x\n2,\"open\n3,y\n", ["1,x", "3,y"], ["2,\"open"]),
    "open before quoted": ("id,note\n1,\"open\n2,x\n3,\"quoted, fine\"\n4,y\n", ["2,x", "3,\"quoted, fine\"", "4,y"], ["1,\"open"]),
    "open before a whole field": ("id,note\n1,\"open\n2,x\n3,\"quoted\"\n4,y\n", ["2,x", "3,\"quoted\"", "4,y"], ["1,\"open"]),
    "record after record": ("a,b\n\"x\ny\",\"p\nq\"\n\"u\nv\",\"r\ns\"\n1,2\n", ["\"x\ny\",\"p\nq\"", "\"u\nv\",\"r\ns\"", "1,2"], []),
    "torn header": ("c,\"a\nb\"\n1,\"x\ny\"\n2,3\n", ["1,\"x\ny\"", "2,3"], []),
    "all open": ("a,b\n1,\"x\n2,\"y\n3,\"z\n", [], ["1,\"x", "2,\"y", "3,\"z"]),
    "empty quotes": ("a,b\n\"\",1\n2,\"\"\n3,\"\n\"\n", ["\"\",1", "2,\"\"", "3,\"\n\""], []),
}


@pytest.mark.parametrize("size", [None, "16"])
def test_records_of_files_as_they_are(spark, tmp_path, size):
    for name, (text, _, _) in RECORDS.items():
        put(tmp_path, f"r/{name}.csv", text)
    rows = []
    for name, (text, _, _) in RECORDS.items():
        rows += [(name, i, line) for i, line in enumerate(text.split("\n")[:-1])]
    given = spark.createDataFrame(rows, "table_id string, line_idx long, line string").repartition(3)
    if size:
        spark.conf.set("spark.sql.shuffle.partitions", size)
    try:
        parsed = readers._parsed(readers._records(given)).collect()
        cells, bad, _ = readers.read_table_cells(spark, str(tmp_path / "r"), missing=None)
        files = {(r.table_id.rsplit("/", 1)[1][:-4].replace("%20", " "), r.line) for r in bad.collect()}
        n_rows = cells.select("table_id", "row_idx").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for name, (_, good, wrong) in RECORDS.items():
        mine = sorted((r for r in parsed if r.table_id == name), key=lambda r: r.line_idx)
        assert [r.line for r in mine if not r.odd] == good, name
        assert [r.line for r in mine if r.odd] == wrong, name
    assert files == {(name, line) for name, (_, _, wrong) in RECORDS.items() for line in wrong}
    assert n_rows == sum(len(good) for _, good, _ in RECORDS.values())


def sequential_records(lines, width):
    """The same rule, read line after line: (records, lines with a quote that never closes)."""
    def read(line, inside):
        state, n, bad, start = int(inside), 0, 0, not inside
        i = 0
        while i < len(line):
            c = line[i]
            if state == 1:
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = 0
                    rest = line[i + 1:].lstrip(" ")
                    bad += rest != "" and rest[0] != ","
                start = False
            elif c == ",":
                n, start = n + 1, True
            else:
                state, start = (1 if c == '"' and start else 0), False
            i += 1
        return state, n, bad

    out, odd, i = [], [], 0
    while i < len(lines):
        state, n, _ = read(lines[i], False)
        if state == 0:
            out.append(lines[i])
            i += 1
            continue
        j, broken = i + 1, 0
        while j < len(lines):
            end, m, bad = read(lines[j], True)
            n, broken = n + m, broken + bad
            if end == 0:
                break
            j += 1
        if j < len(lines) and not broken and n + 1 <= width:
            out.append("\n".join(lines[i:j + 1]))
            i = j + 1
        else:
            odd.append(lines[i])
            i += 1
    return out, odd


def test_records_agree_with_reading_line_after_line(spark):
    rng = random.Random(11)
    tables, rows = {}, []
    for t in range(150):
        body = ["".join(rng.choice(['"', '"', '""', ",", ",", "x", " ", ',"', '",']) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 14))]
        lines = ["a,b,c", *[x for x in body if x]]
        tables[str(t)] = lines
        rows += [(str(t), 7 * i, line) for i, line in enumerate(lines)]
    given = spark.createDataFrame(rows, "table_id string, line_idx long, line string").repartition(5)
    got = {}
    for r in readers._records(given).orderBy("table_id", "line_idx").collect():
        got.setdefault(r.table_id, ([], []))[r.odd].append(r.line)
    for t, lines in tables.items():
        assert got[t] == sequential_records(lines, 3), lines
    assert sum("\n" in line for good, _ in got.values() for line in good) > 30


def test_digests_of_large_files_are_streamed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "_CHUNK", 1000)
    data = bytes(range(256)) * 400
    put(tmp_path, "big file.bin", data)
    put(tmp_path, "one.bin", b"x")
    df = readers.file_manifest(spark, str(tmp_path))
    got = {r.file_name: (r.size_bytes, r.sha256) for r in df.collect()}
    assert got == {"big file.bin": (len(data), hashlib.sha256(data).hexdigest()), "one.bin": (1, hashlib.sha256(b"x").hexdigest())}
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()
    batch = pa.record_batch({"path": [(tmp_path / "big file.bin").as_uri()], "length": [len(data)]})
    assert next(readers._digests(iter([batch]))).column("head")[0].as_py() == data[:512]


@pytest.mark.parametrize("step", ["write", "rename", "create", "delete"])
@pytest.mark.parametrize("keep", [True, False])
def test_a_crash_between_any_two_steps_leaves_a_readable_table(spark, tmp_path, monkeypatch, step, keep):
    path = str(tmp_path / "t")
    old, new = spark.range(3), spark.range(3, 8)
    writers.replace_table(old, path)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if step == "create":  # the write of the rows themselves is lost
            bad = new.select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
        else:
            bad = new
            patch.setattr(writers._Files, step, crash)
        with pytest.raises(Exception, match="lost"):
            writers._commit(bad, path, keep)
            writers.recover(spark, path)
    now = sorted(r.id for r in writers.read_table(spark, path).collect())
    assert now == ([0, 1, 2] if step != "delete" else list(range(8)) if keep else [3, 4, 5, 6, 7])
    writers.recover(spark, path)
    assert sorted(r.id for r in writers.read_table(spark, path).collect()) == now
    assert len(list((tmp_path / "t").glob("data-*"))) == len(list((tmp_path / "t" / "_pointers").glob("[0-9]*"))) + (step == "delete" and keep)


def test_a_second_writer_does_not_replace_a_pointer(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(1), path)
    files = writers._Files(spark, path)
    files.write(f"{path}/_pointers/draft-x", "data-x")
    with pytest.raises(OSError, match="another writer"):
        files.rename(f"{path}/_pointers/draft-x", f"{path}/_pointers/{1:012d}")
    assert writers.read_table(spark, path).count() == 1


def test_text_of_records_is_not_written_between(spark, tmp_path, monkeypatch):
    met, keep = [], ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df: met.append(df.columns) or keep(df))
    (tmp_path / "a.csv").write_text('id,note\n1,"one\ntwo\n""three"""\n2,plain\n3,"torn\n4,"x\ny"\n')
    got = sorted((r.line_idx, r.line, r.odd) for r in readers._records(readers._lines(spark, str(tmp_path / "a.csv"))).collect())
    assert [x[1:] for x in got] == [("id,note", False), ('1,"one\ntwo\n""three"""', False), ("2,plain", False), ('3,"torn', True), ('4,"x\ny"', False)]
    assert met and not any("line" in columns for columns in met)
