"""Fill-in-the-middle against a plain version, texts with every awkward case."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import fill_middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def fields(row):
    return tuple(row["fim"])


def test_every_text(docs, corpus):
    out = fill_middle.transform(docs)
    assert out.columns == [*docs.columns, "fim"]
    got = {r["doc_id"]: r for r in out.collect()}
    texts = {i: t for i, t, _ in corpus}
    assert len(got) == len(texts)
    for i, row in got.items():
        assert fields(row) == expected(i, texts[i])
        assert row["text"] == texts[i] and row["_batch"] == "b" and row["cut"] == "c"
    assert {r["fim"]["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_restored_exactly(docs, corpus):
    rewritten = fill_middle.transform(docs).select("doc_id", "fim.*", F.lit(1).alias("restored"))
    back = fill_middle.restore(rewritten)
    assert back.columns == [*rewritten.columns, "_restored"]
    assert {r["doc_id"]: r["_restored"] for r in back.collect()} == {i: t or "" for i, t, _ in corpus}


@pytest.mark.parametrize("text", ["<P>", "a<S>b", "x <M>", "<P", "S>", "<", ">" * 9, "P>S>M", "<p>low</p>", "a\r\n\tb", "\x00a\x00", "́e\U0001f600z", "ß" * 30, "a" * 300_000, "a1" * 200_000])
def test_marks_borders_and_long_texts(spark, text):
    rows = [(k, text) for k in range(40)]
    out = fill_middle.transform(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    back = fill_middle.restore(out.select("doc_id", "fim.*")).collect()
    for row in back:
        assert (row["n"], row["form"], row["prefix_chars"], row["middle_chars"], row["output"]) == expected(row["doc_id"], text)
        assert row["restored"] == text


def test_nulls_repeated_rows_and_empty_tables(empty, twice):
    assert fill_middle.transform(empty).count() == 0 and fill_middle.restore(fill_middle.transform(empty).select("fim.*")).count() == 0
    got = fill_middle.transform(twice).collect()
    assert len(got) == 7
    for row in got:
        assert fields(row) == expected(row["doc_id"], row["text"])


def test_seed_and_shares_are_parameters(docs):
    plain = fill_middle.transform(docs, plain_from=0).select("fim.*")
    assert {r["form"] for r in plain.collect()} == {"plain"} and plain.where("middle_chars IS NOT NULL").count() == 0
    turned = fill_middle.transform(docs, plain_from=100, suffix_first_below=100).where("length(text) > 0").select("fim.form")
    assert {r["form"] for r in turned.collect()} == {"spm"}
    other = fill_middle.transform(docs, seed="2").select("doc_id", "fim.output")
    assert other.exceptAll(fill_middle.transform(docs).select("doc_id", "fim.output")).count() > 0
