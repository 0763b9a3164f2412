"""Operators on texts against brute force on small corpora with every awkward case."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import line_dedup, mixing, ngram_join, packing, quality, suffix_dedup, tokens, toxicity, wavelet

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# quality ---------------------------------------------------------------------------------------------------------------------

def measures(text):
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = collections.defaultdict(list)
    for j in range(len(w) - 7):
        seen[tuple(w[j:j + 8])].append(j)
    covered = {k for v in seen.values() if len(v) > 1 for j in v for k in range(j, j + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(docs, corpus):
    got = by_id(quality.judge(docs))
    assert len(got) == len(corpus)
    for i, text, _ in corpus:
        expected = measures(text)
        assert tuple(got[i][n] for n in quality.MEASURES) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_quality_order_does_not_change_the_verdict(spark):
    rng = random.Random(1)
    clean = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "more", "of", "the", "words", "run"]) + str(i % 31) for i in range(80))
    texts = [clean, clean.upper(), clean.replace(" ", "*** "), "\n".join(f"{clean[i * 9:i * 9 + 60]}" for i in range(3)), " ".join(["abc", "abc", "abc", "abd"] * 20)]
    flat = [t.encode() for t in texts]
    borders = np.concatenate([[0], np.cumsum([len(t) for t in flat])])
    verdicts = []
    for order in (quality.RULES, quality.RULES[::-1]):
        verdicts.append(quality._judge(quality.Texts(np.frombuffer(b"".join(flat), np.uint8), borders), order)[1].tolist())
    assert verdicts[0] == verdicts[1] and verdicts[0][:3] == [True, False, False]


def test_quality_edges(docs, empty, twice):
    assert quality.judge(empty).count() == 0 and quality.keep_clean(empty).count() == 0
    assert quality.judge(twice).count() == 7
    kept = quality.keep_clean(docs)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}


# n-gram join -----------------------------------------------------------------------------------------------------------------

def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_links(corpus):
    sets = {i: shingle_set(t) for i, t, _ in corpus}
    links, root = collections.Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


@pytest.mark.parametrize("paired,block", [(32, 256), (3, 8)])
def test_ngram_join(docs, corpus, paired, block):
    got = by_id(ngram_join.join(docs, paired=paired, block=block))
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == brute_links(corpus)


def test_ngram_join_edges(docs, empty, twice):
    assert ngram_join.join(empty).count() == 0
    rows = sorted(((r["doc_id"] or 0), r["class_id"] or 0, r["n_links"]) for r in ngram_join.join(twice).collect())
    assert rows == [(0, 0, 0), (0, 0, 0), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0), (3, 3, 0)]
    first = ngram_join.keep_first(docs)
    assert first.schema == docs.schema
    found = by_id(ngram_join.join(docs))
    assert {r["doc_id"] for r in first.collect()} == {i for i, r in found.items() if r["class_id"] == i}


def test_bands_reach_the_recall():
    for t in (0.5, 0.8, 0.9):
        bands, rows = ngram_join.choose_bands(t, 0.999)
        assert 1 - (1 - t ** rows) ** bands >= 0.999


# repeated byte strings -------------------------------------------------------------------------------------------------------

def brute_cut(corpus):
    seen, out = set(), {}
    for i, text, _ in sorted(corpus):
        raw = (text or "").encode()
        gone, new = bytearray(len(raw)), set()
        for j in range(len(raw) - 49):
            piece = raw[j:j + 50]
            if piece in seen:
                gone[j:j + 50] = b"\1" * 50
            new.add(piece)
        seen |= new
        out[i] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_suffix_dedup(docs, corpus, hot):
    found = suffix_dedup.dedup(docs, hot=hot)
    got = by_id(found.select("doc_id", F.col(found.columns[-1]).alias("r")).select("doc_id", "r.*"))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_cut(corpus)


def test_suffix_dedup_edges(docs, empty, twice, corpus):
    assert suffix_dedup.dedup(empty).count() == 0
    left = suffix_dedup.remove_repeats(twice)
    assert left.schema.simpleString() == twice.schema.simpleString()
    sizes = sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in left.collect())
    whole = len(twice.where("doc_id = 1").first()["text"])
    assert sizes == [(0, 0), (0, whole), (1, whole), (1, whole), (2, 0), (3, 0), (3, 0)]
    assert suffix_dedup.remove_repeats(docs).count() == len(corpus)


def test_run_index_steps_like_the_suffix_array():
    texts = [b"abracadabra", b"cadabra", b"abra"]
    grid = np.full((3, suffix_dedup.WIDE), suffix_dedup.END, np.uint8)
    for row, t in zip(grid, texts):
        row[:len(t)] = np.frombuffer(t, np.uint8)
    index = suffix_dedup.RunIndex(grid, np.arange(3))
    order = sorted((t[j:] + bytes([255, i]), i, j) for i, t in enumerate(texts) for j in range(len(t) + 1))
    rank = {(i, j): k for k, (_, i, j) in enumerate(order)}
    for i, t in enumerate(texts):
        row = np.array([index.mark_rows[i]])
        for j in range(len(t), -1, -1):
            assert row[0] == rank[i, j]
            if j:
                row = index.step(row)
    assert len(index.run) < index.n


def test_suffix_dedup_sends_few_rows_for_its_bytes():
    """Every batch sends a row to every bucket: at 6 GB (10 GB of text) that were 40 million rows, four times over."""
    for total in (10**6, 10**8, 10**9, 10 * 10**9):
        batches, bits = suffix_dedup._dealt(total)
        assert batches * 2**bits <= 1 + total / 4000
        assert total / batches <= 4 << 20 and total / 15 / 2**bits <= 1_000_000


def cut_in_one_process(corpus, batches, bits, hot):
    table = pa.table({"k": [i for i, _, _ in corpus], "t": [t for _, t, _ in corpus], "n": [i % batches for i, _, _ in corpus]})
    names = ("k", "t", "n")
    parts = {i: table.filter(pc.equal(table["n"], i)) for i in range(batches)}

    def dealt(tables, column):
        rows = pa.concat_tables(tables)
        return {i: rows.filter(pc.equal(rows[column], i)) for i in rows[column].unique().to_pylist()}

    shared = dealt([suffix_dedup._share_anchors(x, hot) for x in dealt([suffix_dedup._send_anchors(x, names, bits) for x in parts.values()], "bucket").values()], "batch")
    sent = dealt([suffix_dedup._send_contexts(x, shared[i], names, bits) for i, x in parts.items()], "bucket")
    answers = dealt([suffix_dedup._answer(x) for x in sent.values()], "batch")
    replies = {i: pa.concat_tables([shared[i], answers.get(i, suffix_dedup._table([]))]) for i in parts}
    wanted = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return pa.concat_tables([suffix_dedup._cut(x, replies[i], names, bits, wanted) for i, x in parts.items()]).to_pylist()


@pytest.mark.parametrize("batches,bits,hot,indexed,places", [(1, 0, 20_000, 1 << 11, 1 << 15), (7, 3, 20_000, 1, 64), (3, 2, 3, 50, 1000)])
def test_suffix_dedup_in_parts(corpus, monkeypatch, batches, bits, hot, indexed, places):
    """However the texts are dealt and however few contexts an index takes, the bytes that go are the same."""
    monkeypatch.setattr(suffix_dedup, "INDEXED", indexed)
    monkeypatch.setattr(suffix_dedup, "PLACES", places)
    got = cut_in_one_process(corpus, batches, bits, hot)
    assert {r["k"]: (r["n_n_bytes"], r["n_n_removed"], r["n_n_spans"], r["n_kept_sha256"]) for r in got} == brute_cut(corpus)
    assert all(sum(x["end"] - x["start"] for x in r["n_spans"]) == r["n_n_removed"] for r in got)


def test_orders_counts_and_marks_of_the_index():
    rng = np.random.default_rng(1)
    for top in (5, 2**63):
        values = rng.integers(0, top, 1000, dtype=np.uint64)
        order, ordered = suffix_dedup._in_order(values)
        assert (order == np.argsort(values, kind="stable")).all() and (ordered == np.sort(values)).all()
    begins = rng.random(300) < 0.2
    begins[0] = True
    assert (suffix_dedup.Marks(begins).of(np.arange(300)) == np.cumsum(begins) - 1).all()
    n = np.array([0, 1, 2, 127, 128, 500, 10**6])
    kept = suffix_dedup._long(suffix_dedup._short(n))
    assert (kept[:5] == n[:5]).all() and (kept <= n).all() and (kept >= n * 0.9).all()
    tags = np.array([[1, 2], [1, 3], [4, 2], [1, 2]], np.uint64)
    group = suffix_dedup._equal(tags)
    assert group[0] == group[3] and len(set(group)) == 3


# line dedup ------------------------------------------------------------------------------------------------------------------

def test_line_dedup(docs, corpus):
    got = by_id(line_dedup.dedup(docs.select("doc_id", "text", "source")).select("doc_id", "source", "cut.*"))
    seen = set()
    for i, text, _ in sorted(corpus):
        kept, at, spans = [], 0, []
        for line in (text or "").split("\n"):
            plain = re.sub(r"[ \t\n\v\f\r]+", " ", line).strip(" ").lower()
            if plain and plain in seen:
                spans.append(f"{at}-{at + len(line)}")
            else:
                kept.append(line)
                seen |= {plain} - {""}
            at += len(line) + 1
        assert (got[i]["spans"], got[i]["kept_text"], got[i]["n_removed"]) == (";".join(spans), "\n".join(kept), len(spans))


def plain_units(text, least):
    """Passages as lists of (start, end) of words, word by word."""
    found = [(m.start(), m.end()) for m in re.finditer(r"[^ \t\n\v\f\r]+", text)]
    lines = collections.defaultdict(list)
    for a, b in found:
        lines[text.count("\n", 0, a)].append((a, b))
    pieces, short = [], []

    def close():
        if short:
            pieces.append(list(short))
            short.clear()

    for _, here in sorted(lines.items()):
        if len(here) < least:
            short.extend(here)
            if len(short) >= least:
                close()
            continue
        close()
        piece = []
        for k, (a, b) in enumerate(here):
            piece.append((a, b))
            if len(piece) >= least and text[b - 1] in ".!?,;:" and k + 1 < len(here):
                pieces.append(piece)
                piece = []
        if piece:
            pieces.append(piece)
    close()
    units = []
    for piece in pieces:
        if units and len(piece) < least:
            units[-1] += piece
        else:
            units.append(piece)
    return [(u[0][0], u[-1][1]) for u in units]


def test_passages_are_met_inside_lines(spark, docs, corpus):
    rng = random.Random(5)
    made, shared = [], []
    for i in range(60):
        w = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5))) + rng.choice(["", "", "", "", ".", ",", ";", "!", "\n", "\n \n", "\t"]) for _ in range(rng.randint(0, 160))]
        if shared and i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(shared)
        elif len(w) > 80:
            shared.append(w[9:75])
        made.append(rng.choice(["", " ", "\n\n"]) + " ".join(w))
    rows = [(i, t) for i, t, _ in corpus] + [(1000 + i, t) for i, t in enumerate(made)]
    got = by_id(line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), unit="passage").select("doc_id", "cut.*"))
    seen, hit = set(), 0
    for i, text in sorted(rows):
        units = plain_units(text or "", line_dedup.LEAST)
        gone = []
        for a, b in units:
            plain = " ".join(re.split(r"[ \t\n\v\f\r]+", text[a:b])).lower()
            if plain in seen:
                gone.append((a, b))
            seen.add(plain)
        assert (got[i]["n_units"], got[i]["spans"], got[i]["removed_chars"]) == (len(units), ";".join(f"{a}-{b}" for a, b in gone), sum(b - a for a, b in gone)), i
        left = "".join(c for k, c in enumerate(text or "") if not any(a <= k < b for a, b in gone)) if len(text or "") < 5000 else None
        assert left is None or got[i]["kept_text"].split() == left.split()
        hit += i >= 1000 and bool(gone)
    assert hit >= 12


def test_line_dedup_edges(spark, empty, twice):
    assert line_dedup.dedup(empty).count() == 0
    found = line_dedup.dedup(twice)
    rows = sorted((r["doc_id"] or 0, r["n"]) for r in found.select("doc_id", F.col(found.columns[-1])["n_removed"].alias("n")).collect())
    assert rows == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 1), (3, 0), (3, 0)]
    two = spark.createDataFrame([(1, "a b c d e\nf\n\n\nx y z u v"), (2, "q\n\nA  b c d e\nf\n\nlast of all")], "doc_id long, text string")
    out = {r["doc_id"]: r["kept_text"] for r in line_dedup.dedup(two, unit="paragraph").select("doc_id", "cut.*").collect()}
    assert out == {1: "a b c d e\nf\n\n\nx y z u v", 2: "q\n\nlast of all"}


# mixing ----------------------------------------------------------------------------------------------------------------------

def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / max(1, sum(weight[s] for s in rest)) if rest else 0
        over = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in rest}
        full |= {s: 3 * sizes[s] for s in over}


def test_mix(docs, corpus):
    sizes = collections.Counter()
    for _, text, source in corpus:
        sizes[source] += len(words(text))
    draws = mixing.mix(docs, block_words=16, shard_blocks=40)
    rows, again = mixing.taken(draws).collect(), mixing.taken(mixing.mix(docs, block_words=16, shard_blocks=40)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(corpus)
    wanted, got = targets(sizes), collections.Counter()
    for r in rows:
        got[r["source"]] += r["taken"]
        assert r["size"] == len(words(dict((i, t) for i, t, _ in corpus)[r["key"]])) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(wanted[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(got[s] == round(wanted[s]) for s in sizes)
    used = draws.where("words > 0").select("source", "shard", "before", "epoch").collect()
    assert all(r["shard"] is not None for r in used) and len({r["shard"] for r in used}) > 4


def test_mix_edges(empty, twice, docs):
    assert mixing.mix(empty).count() == 0 and mixing.drawn_rows(empty).count() == 0
    rows = mixing.taken(mixing.mix(twice)).collect()
    # one source: its target is its size, and every row is taken once (equal rows are counted together)
    assert sum(r["taken"] for r in rows) == 60 * 4
    out = mixing.drawn_rows(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()


def test_mix_keeps_every_row(spark, twice):
    rows = mixing.taken(mixing.mix(twice)).collect()
    assert sorted((r["key"] or 0, r["size"], r["taken"]) for r in rows) == [(0, 0, 0), (0, 60, 60), (1, 60, 60), (1, 60, 60), (2, 60, 60), (3, 0, 0), (3, 0, 0)]
    blank = spark.createDataFrame([(None, t, s) for t in ("", None, " ") for s in ("a", None) for _ in range(9)], "doc_id long, text string, source string")
    assert mixing.taken(mixing.mix(blank)).count() == 54


def test_rows_drawn_are_the_words_taken(spark, docs, corpus):
    """Repeated keys, null keys and equal rows each meet their own draws, so the rows hold exactly the words that the mix takes."""
    twenty = " ".join(f"w{i}" for i in range(20))
    rows = [(1, twenty, "b"), (1, twenty, "b"), (None, twenty, "b"), (None, twenty, "b"), (None, twenty.upper(), "b")] + [(10 + i, twenty, "a") for i in range(9)]
    given = spark.createDataFrame([(k, t, s, len(t), "x", 0) for k, t, s in rows], "doc_id long, text string, source string, n_chars long, _mix_key string, copy int").repartition(3)
    for df, options in ((given, {}), (given, {"weights": (1, 9)}), (docs, {"block_words": 64})):
        got, want = collections.Counter(), collections.Counter()
        for r in mixing.drawn_rows(df, **options).collect():
            got[r["source"], r["doc_id"]] += len(words(r["text"]))
            assert r["n_chars"] == len(r["text"])
        for r in mixing.taken(mixing.mix(df, **options)).collect():
            want[r["source"], r["key"]] += r["taken"]
        assert got == +want


def test_draws_stand_where_the_tree_puts_them(docs):
    one = mixing.mix(docs, block_words=16, shard_blocks=10 ** 6).where("words > 0").collect()
    many = mixing.mix(docs, block_words=16, shard_blocks=160).where("words > 0").collect()
    assert {r["shard"] for r in one} == {0} and sorted(r["position"] for r in one) == list(range(len(one)))
    shards = collections.defaultdict(list)
    for r in many:
        shards[r["shard"]].append(r["position"])
    assert len(shards) > 8 and all(sorted(v) == list(range(len(v))) for v in shards.values())
    # a draw stands in the shard that the tree gave the block it begins in
    sources = mixing.source_targets(mixing.sized(docs, "doc_id", "text", "source"))
    names = {r["sid"]: r["source"] for r in sources.collect()}
    blocks = sum(-(-round(r["target"]) // 16) for r in sources.collect())
    owned = mixing.split_quotas(sources, (-(-blocks // 160) - 1).bit_length(), block_words=16).collect()
    for r in many:
        block = (r["source_size"] * r["epoch"] + r["before"]) // 16
        assert [o["shard"] for o in owned if names[o["sid"]] == r["source"] and o["first"] <= block < o["first"] + o["blocks"]] == [r["shard"]]
    assert {(r["key"], r["epoch"], r["shard"]) for r in one} != {(r["key"], r["epoch"], r["shard"]) for r in many}


def test_rows_are_written_shard_by_shard(docs):
    options = {"block_words": 16, "shard_blocks": 160}
    draws = {(r["key"], r["epoch"]): (r["shard"], r["position"]) for r in mixing.mix(docs, **options).where("words > 0").collect()}
    keys = [[r["doc_id"] for r in part] for part in mixing.drawn_rows(docs, **options).rdd.glom().collect()]
    once = {k: p for (k, _), p in draws.items() if sum(x == k for x, _ in draws) == 1}
    for part in keys:
        spots = [once[k] for k in part if k in once]
        assert spots == sorted(spots)
    assert sum(map(len, keys)) == len(draws)


def test_hypergeometric_draws(spark):
    rows = spark.range(4000).select(mixing.hypergeometric(F.lit(30), F.lit(70), F.lit(40), mixing._uniform(F.lit(3), F.col("id"))).alias("k")).collect()
    k = np.array([r["k"] for r in rows])
    assert abs(k.mean() - 12) < 0.2 and abs(k.var() - 40 * 0.3 * 0.7 * 60 / 99) < 0.6 and k.min() >= 0 and k.max() <= 30
    for good, bad, draws, value in ((0, 5, 3, 0), (5, 0, 3, 3), (4, 3, 7, 4), (4, 3, 0, 0), (0, 0, 0, 0)):
        assert spark.range(1).select(mixing.hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), F.lit(0.999)).alias("k")).first()["k"] == value


def test_split_keeps_quotas(spark):
    sources = spark.createDataFrame([(0, "a", 9, 5000, 5000.0), (1, "b", 9, 900, 900.0), (2, None, 1, 0, 0.0)], "sid int, source string, rows long, source_size long, target double")
    rows = mixing.split_quotas(sources, 3, block_words=1).collect()
    per_shard = collections.Counter()
    for sid in range(3):
        own = sorted((r["shard"], r["first"], r["blocks"]) for r in rows if r["sid"] == sid)
        assert [f for _, f, _ in own] == list(np.cumsum([0] + [b for *_, b in own])[:-1])
    for r in rows:
        per_shard[r["shard"]] += r["blocks"]
    assert sum(per_shard.values()) == 5900 and max(per_shard.values()) - min(per_shard.values()) <= 1


# tokens, packing, wavelet ----------------------------------------------------------------------------------------------------

AWKWARD = ["a", "B", "é", " ", "  ", "\n", "\t", " ", "　", "'s", "'ll", "1", "23", "!?", "́", "Σ", "中", "\x1c", "\x85", "ß", "<|endoftext|>", "\x0b", "😀", "​"]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_units_encode_like_whole_texts(name, spaced):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(3)
    texts = ["".join(rng.choice(AWKWARD) for _ in range(rng.randint(0, 40))) for _ in range(800)] + ["", None]
    path = tokens.public_path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    ids, borders = tokens.UnitEncoder(path, spaced).encode(pa.array(texts))
    for i, found in enumerate(plain.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[borders[i]:borders[i + 1]].tolist() == found.ids


def encoded(name, texts, end):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.public_path(name))
    plain.encode_special_tokens = True
    return [np.array(e.ids + [end], "<u4") for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pack(docs, corpus):
    expected = {}
    for (i, _, _), ids in zip(corpus, encoded("word_bpe_49k.json", [t for _, t, _ in corpus], 1)):
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            expected[i, k // 4096] = (k, len(part), zlib.crc32(part.tobytes()))
    rows = packing.pack(docs).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected and len(rows) == len(expected)
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(filled) <= 1.02 * sum(r["length"] for r in rows) / 4096 + 1


def test_pack_edges(empty, twice, spark):
    assert packing.pack(empty).count() == 0
    rows = packing.pack(twice, with_ids=True).collect()
    assert len(rows) == 7 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 7
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_best_fit_places_every_rank_once():
    rng = random.Random(5)
    for _ in range(30):
        histogram = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(1, 30))}
        places, ranks = collections.defaultdict(list), collections.Counter()
        for length, rank, count, first, each, offset in packing.best_fit(histogram, 64):
            for i in range(count):
                places[first + i // each].append((offset + i % each * length, length))
                ranks[length, rank + i] += 1
        assert set(ranks) == {(n, i) for n, c in histogram.items() for i in range(c)} and max(ranks.values()) == 1
        assert sorted(places) == list(range(len(places)))
        for found in places.values():
            at = 0
            for offset, length in sorted(found):
                assert offset == at
                at += length
            assert at <= 64


def test_wavelet_round_trip(spark, docs, corpus, tmp_path):
    folder = str(tmp_path / "shards")
    wavelet.write(docs, folder, shard_tokens=3000)
    at, expected = 0, []
    for (i, _, _), ids in zip(sorted(corpus), encoded("byte_bpe_50k.json", [t for _, t, _ in sorted(corpus)], 0)):
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in wavelet.read(spark, folder).collect()) == expected
    assert spark.read.parquet(folder).count() > 5


def test_wavelet_edges(spark, empty, twice, tmp_path):
    wavelet.write(empty, str(tmp_path / "none"))
    assert wavelet.read(spark, str(tmp_path / "none")).count() == 0
    wavelet.write(twice, str(tmp_path / "twice"))
    rows = wavelet.read(spark, str(tmp_path / "twice")).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 1, 2, 3, 3] and sum(r["n_tokens"] == 1 for r in rows) == 3


def test_units_are_encoded_without_offsets():
    coder = tokens.UnitEncoder(tokens.public_path(wavelet.VOCABULARY), True)
    texts = ["it's  one\n\ntwo", "", "\u00e9t\u00e9 na\u00efve \u4e2d\u6587 <|endoftext|> x\ny", None]
    want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]

    class Bare:
        """Only what costs no offsets."""

        encode_batch_fast = staticmethod(coder.tokenizer.encode_batch_fast)

    coder.tokenizer = Bare
    ids, borders = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == want


def test_new_units_are_encoded_as_lines_of_few_texts():
    coder = tokens.UnitEncoder(tokens.public_path(wavelet.VOCABULARY), True)
    plain, given = coder.tokenizer, []

    class Counted:
        @staticmethod
        def encode_batch_fast(texts, **kw):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **kw)

    coder.tokenizer = Counted
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(3)) for i in range(1000)]
    texts = [" ".join(w + end for w in words) for end in ("", ".", ",", "###", "'s")]
    ids, borders = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    # words, their five ends and the five texts' first words, which have no space before them
    assert len(given) <= 20 and sum(t.count("\n") for t in given) <= 1010


def test_units_of_any_characters_have_the_ids_of_the_whole_text():
    coder = tokens.UnitEncoder(tokens.public_path(wavelet.VOCABULARY), True)
    pieces = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u3000", "\u200b", "a", "Z", "the", "7", "42", ".", ",", "'", "'s", "'re", "'T", "###", "_", "-", "\x00", "\x7f",
              "\u00e9", "\u00df", "\u00d7", "\u00f7", "\u00aa", "\u00b5", "\u0301", "\u0436", "\u4e2d", "\u2019", "\U0001f600", "<|endoftext|>"]
    rng = np.random.default_rng(11)
    texts = ["".join(pieces[i] for i in rng.integers(0, len(pieces), n)) for n in rng.integers(0, 40, 3000)] + [a + b + c for a in pieces for b in pieces for c in ("", "x", " x", "\n")]
    ids, borders = coder.encode(pa.array(texts))
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == want


@pytest.mark.parametrize("depth", [16, 17])
def test_wavelet_longer_than_a_decoded_block(depth, monkeypatch):
    monkeypatch.setattr(wavelet, "DECODED", 700)
    for low, high in ((0, 1), ((1 << depth) - 1, 1 << depth), (0, 1 << depth)):
        ids = np.random.default_rng(8).integers(low, high, 5000, dtype=np.uint32)
        assert (wavelet.WaveletMatrix.build(ids, depth).decode() == ids).all()


@pytest.mark.parametrize("depth", [16, 17])
def test_wavelet_of_any_depth_decodes(depth):
    ids = np.random.default_rng(4).integers(0, 1 << depth, 5000, dtype=np.uint32)
    assert (wavelet.WaveletMatrix.build(ids, depth).decode() == ids).all()


def test_wavelet_queries():
    rng = np.random.default_rng(1)
    for n, kinds in ((1, 3), (513, 300), (5000, 50257)):
        ids = rng.integers(0, kinds, n).astype(np.uint32)
        matrix, keys, borders = wavelet.from_bytes(wavelet.to_bytes(wavelet.WaveletMatrix.build(ids, 16), np.arange(2), np.array([0, 1, n])))
        assert (matrix.decode() == ids).all() and keys.tolist() == [0, 1] and borders.tolist() == [0, 1, n]
        at = rng.integers(0, n, 40)
        assert (matrix.access(at) == ids[at]).all()
        for token in [*map(int, ids[:5]), 60000, 2]:
            places = np.flatnonzero(ids == token)
            assert matrix.count(token) == len(places) and matrix.rank(token, n // 2) == (places < n // 2).sum()
            assert [matrix.select(token, k) for k in range(min(3, len(places)))] == places[:3].tolist() and matrix.select(token, len(places)) == -1


# toxicity --------------------------------------------------------------------------------------------------------------------

def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(["wonder", "river", "stone", "garden", "winter", "letter", "paper", "idle", "sour", "morning"]) + rng.choice(["", "s", "ed"]) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for word in rng.sample(["grobnik", "snarfle", "blotzen"], 2):
                text[rng.randrange(40)] = rng.choice([word, word, word.upper(), word.replace("o", "0").replace("a", "4"), word[0] + word])
        rows.append((i, " ".join(text), "x", rng.choice("ab")))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None, None, None), (1001, "", "", ""), (None, "a river", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, marks).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    held = [(r["predicted"], int(r["doc_id"] % 5 == 0)) for r in out if r["held_out"] and r["doc_id"] < 900]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out if r["doc_id"] is not None)
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert toxicity.score(docs.limit(0), marks).count() == 0
    assert {r["predicted"] for r in toxicity.score(docs, marks.limit(0)).collect()} == {1}


def test_restoration():
    counts = np.full((28, 28, 28), 0.01)
    for word in "idiot moron loser pathetic trash the river is a good place worthless stupid".split() * 5:
        codes = [0, 0, *[ord(c) - 96 for c in word], 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
    restore = toxicity.Restorer(np.log(counts / counts.sum(axis=2, keepdims=True)))
    assert [restore.read(w) for w in ("1d10t", "m0r0n", "l.o.s.e.r", "i d i o t", "tra$h", "looooser", "worthle55")] == ["idiot", "moron", "loser", "idiot", "trash", "loser", "worthless"]
    assert restore("a 1d10t in 2024 or 0641917ea4e9feb9 l o s e r") == "a idiot in 2024 or 0641917ea4e9feb9 loser"


def test_restoration_of_any_length():
    counts = np.full((28, 28, 28), 0.01)
    for text in ["you are a pathetic worthless idiot and loser", "stupidity is a pathetic thing", "the river is a good place and you are worthless"] * 20:
        codes = [0, 0, *[ord(c) - 96 if c != " " else 0 for c in text], 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
    restore = toxicity.Restorer(np.log(counts / counts.sum(axis=2, keepdims=True)))
    phrase = "you are a pathetic worthless idiot and loser"
    assert restore(" ".join(phrase.replace(" ", ""))) == phrase
    assert [restore(w) for w in ("w0r7h1355", "57up1d17y", "1 d 1 0 t", "w o r t h l e s s", "1 2 3 4 5")] == ["worthless", "stupidity", "idiot", "worthless", "1 2 3 4 5"]
    assert restore("id" + "i" * 90 + "0t") == "idiot"
    for text in ("1 d 1 0 t", "l o s e r"):
        assert len(toxicity._suspects(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))) == 1
