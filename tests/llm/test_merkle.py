"""Merkle manifests against trees built in plain Python, with small fanouts so that every round of the exchange has ragged subtrees."""

import hashlib

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, fanout):
    """Root and, for every leaf, its proof: [(place in the run, siblings)]."""
    proofs, own, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, proof in enumerate(proofs):
            first = own[i] // fanout * fanout
            run = level[first:first + fanout]
            spot = own[i] - first
            proof.append((spot, "".join(run[:spot] + run[spot + 1:])))
            own[i] //= fanout
        level = [sha("".join(level[j:j + fanout])) for j in range(0, len(level), fanout)]
    return level[0], proofs


def expected(rows, fanout):
    """(key, leaf) -> [(subroot, root, proof)] of rows (key, group, leaf)."""
    groups = {}
    for key, group, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(group, []).append((key, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf in groups[g]], fanout) for g in order}
    root, tops = tree([trees[g][0] for g in order], fanout)
    out = []
    for g, top in zip(order, tops):
        for place, ((key, leaf), proof) in enumerate(zip(groups[g], trees[g][1])):
            out.append((key, g, leaf, place, trees[g][0], root, [*proof, *top]))
    return out


def given(r):
    m = r["merkle"]
    return r["doc_id"], r["lang"], r["leaf"], m["place"], m["subroot"], m["root"], [tuple(x) for x in m["proof"]]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("fanout,levels,sizes", [
    (2, 1, [(None, 1), ("a", 2), ("b", 3), ("c", 23)]),
    (2, 0, [("a", 13), ("B", 1)]),
    (3, 1, [("é", 100), ("z", 82), (None, 28), ("", 9), ("=", 10)]),
    (3, 2, [(f"g{i}", 1 + i) for i in range(14)]),
    (8, 1, [("en", 600), ("de", 65)]),
    (8, 4, [("en", 200), ("de", 1), ("es", 9)]),
])
def test_trees(spark, fanout, levels, sizes):
    rows = [(7 * i + j, g, sha(f"{g} {i} {j}")) for j, (g, n) in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(3)
    got = merkle.manifest(df, fanout=fanout, block_levels=levels)
    assert order(map(given, got.collect())) == order(expected(rows, fanout))
    opened = got.select("leaf", "merkle.*")
    assert opened.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    wrong = opened.where(merkle.fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root"))
    assert wrong.count() == 0


def test_a_row_hashes_as_its_fields(spark, docs, corpus):
    leaf = merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text"))
    got = {r["doc_id"]: r["leaf"] for r in docs.select("doc_id", leaf.alias("leaf")).collect()}
    for i, text, source in corpus:
        fields = [str(i), source, None if i % 7 == 0 else "en", None if text is None else str(len(text)), text]
        assert got[i] == sha("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def test_ties_nulls_repeated_rows_clashing_names(spark):
    data = [(None, "a", "x"), (None, "a", "y"), (1, "a", "x"), (1, "a", "x"), (1, "a", "w"), (1, None, "x"), (2, "b", "z")] + [(5, "a", "same")] * 40
    rows = [(k, g, sha(x), "p", "b", 1, "n") for k, g, x in data]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string, p string, b string, merkle int, t string").repartition(4)
    got = merkle.manifest(df, fanout=2, block_levels=1)
    assert got.columns == [*df.columns, "_merkle"]
    found = [given({**r.asDict(), "merkle": r["_merkle"]}) for r in got.collect()]
    assert order(found) == order(expected([r[:3] for r in rows], 2))
    assert {tuple(r) for r in got.select("p", "b", "merkle", "t").collect()} == {("p", "b", 1, "n")}
    again = merkle.manifest(df.repartition(2, "leaf"), fanout=2, block_levels=1)
    assert {r["_merkle"]["root"] for r in again.collect()} == {r[5] for r in found}


def test_empty_and_single(spark):
    schema = "doc_id long, lang string, leaf string"
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, sha("x"))], schema)).first()
    assert given(one) == (None, None, sha("x"), 0, sha("x"), sha("x"), [])


def test_each_block_acquires_its_upper_proof_by_exchange(spark):
    """A round puts at most ``fanout`` rows of blocks into a group, and blocks never read a level above them."""
    rows = [(i, "a", sha(str(i))) for i in range(50)]
    placed = spark.createDataFrame([("a", 50, i, i // 2, leaf) for i, _, leaf in rows], "t string, n long, p long, b long, leaf string")
    blocks = merkle._butterfly(placed, 2, 1).collect()
    assert len(blocks) == 25 and len({b["node"] for b in blocks}) == 1
    proofs = tree([leaf for _, _, leaf in rows], 2)[1]
    assert {b["b"]: [tuple(x) for x in b["proof"]] for b in blocks} == {i // 2: proofs[i][1:] for i in range(0, 50, 2)}
