"""Page text, vector search, components and the pipeline."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import components, page_diff, vp_search


def page(host, path, body, main=True):
    article = f"<article>{body}</article>" if main else f"<div>{body}</div>"
    return (f"https://{host}{path}", f"<!DOCTYPE html><html><head><title>t</title><script>var a='<p>';</script></head><body><nav><a>Home</a></nav>"
            f"<div>All rights of {host}</div><div class='ad'>Buy {path}</div>{article}<div>Made by {host}</div><footer>f</footer>")


def test_template_lines_go_and_articles_stay(spark):
    rows = []
    for h in ("a.example", "b.example"):
        for k in range(700):
            quote = "<p>Shared quote of many pages</p>" if k % 3 else ""
            rows.append(page(h, f"/en/{k}", f"<h1>Title {k} &amp; more</h1><p>Text  {h}\n{k} is<b> long</b> enough to differ<br>from others</p>{quote}", main=k % 2 == 0))
    rows += [page("a.example", "/en/copy1", "<p>one article in two places that is long enough</p>"), page("a.example", "/en/copy2", "<p>one article in two places that is long enough</p>")]
    rows += [(None, None), ("https://x.example/", ""), ("https://x.example/", "plain text"), ("https://x.example/a", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(i, u, h, "n") for i, (u, h) in enumerate(rows)] + [(None, rows[0][0], rows[0][1], "n")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in page_diff.extract(df).collect()}
    assert len(got) == len(rows) + 1 and got[None] == got[0]
    for k in range(700):
        main = [f"Title {k} & more", f"Text a.example {k} is long enough to differ from others"]
        quote = ["Shared quote of many pages"] if k % 3 else []
        lines = got[k].split("\n")
        assert lines[:2] == main or lines[0] == "All rights of a.example"
        assert lines == main + quote or k % 2
    inside = sum("All rights" in got[k] for k in range(700))
    assert inside <= 14          # only pages whose neighbours are copies keep template lines
    assert [got[i] for i in range(1400, 1402)] == ["one article in two places that is long enough"] * 2
    assert [got[i] for i in range(1402, 1406)] == ["", "", "plain text", "deep"]
    assert page_diff.extract(df.limit(0)).count() == 0


def test_template_behind_many_copies_and_on_thin_pages(spark):
    def plain(host, path, *own):
        return f"https://{host}{path}", "<div>Template of the site, top</div>" + "".join(f"<div>{t}</div>" for t in own) + "<div>Template of the site, bottom</div>"

    body = "one article in many places, long enough to be most of each page"
    rows = [plain("copies.example", f"/m/{k:03}", body) for k in range(40)]
    rows += [plain("near.example", f"/m/{k:04}", body, f"print {k}") for k in range(1300)]
    rows += [plain("near.example", f"/{x}", f"{x} is another article, and it is as long as is needed to differ") for x in ("a", "z")]
    rows += [plain("copies.example", f"/{x}", f"{x} is another article, and it is as long as is needed to differ") for x in ("a", "z")]
    rows += [plain("thin.example", f"/{k:04}", f"thin {k}") for k in range(700)]
    rows += [plain("two.example", f"/{k}", body, f"print {k}") for k in range(2)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r["url"]: r["text"] for r in page_diff.extract(df).collect()}
    assert {t for u, t in got.items() if "copies.example/m" in u} == {body}
    assert all(got[f"https://near.example/m/{k:04}"] == f"{body}\nprint {k}" for k in range(1300))
    assert all(got[f"https://thin.example/{k:04}"] == f"thin {k}" for k in range(700))
    assert all(body in got[f"https://two.example/{k}"] for k in range(2))          # nothing tells template from article


def test_places():
    found = page_diff.lines("<body><header>Site</header><div class='cookie-notice'>c</div><main><header><h1>T&amp;X</h1></header><p>a<b>b</b>  c<br>d<p>e</p>"
                            "<div id=ad-1><p>buy</p></div><section id='comments'><article><p>nice</p></article></section><form>f</form></main><aside>s</aside>")
    assert [t for t, p in found if not p.other] == ["T&X", "ab c d", "e"]
    framed = page_diff.lines("<div class='page has-sidebar'><div class=\"content\">text</div><div class='sidebar left'>s</div></div>")
    assert [t for t, p in framed if not p.other] == ["text"]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = page_diff.common_lines(a, b)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 12)).astype(np.float32)
    x[100:300] = x[100]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (920, [0.0] * 12), (940, [float("nan")] * 12), (941, [1.0, None] + [0.0] * 10), (942, [float("inf")] * 12), (960, [1.0, 2.0]), (961, [2.0, 1.0]), (None, rows[0][1]), (5, rows[5][1])]
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, label int, score double"), x


@pytest.mark.parametrize("slack,recall", [(1.0, 1.0), (1.5, 0.9)])
def test_search(spark, slack, recall):
    df, x = vectors(spark)
    got = collections.defaultdict(list)
    for r in vp_search.search(df, F.col("vec_id") % 20 == 0, slack=slack, shard_rows=200, query_rows=16, leaf=16).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert got.pop(960) == [(1, 961, 4.0)]
    assert set(got) == set(range(0, 700, 20))
    same = whole = 0
    y = x.astype(np.float64)
    for q in got:
        s = (y * y[q]).sum(axis=1)
        order = [j for j in np.lexsort((np.arange(len(y)), -np.round(s, 9))) if j != q][:20]
        found = sorted(got[q])
        assert [k for k, _, _ in found] == list(range(1, 21)) and all(abs(s[j] - v) < 1e-9 for _, j, v in found)
        same, whole = same + len(set(order) & {j for _, j, _ in found}), whole + 20
        if slack == 1.0:
            assert [j for _, j, _ in found] == order
    assert same / whole >= recall


def test_search_edges(spark):
    df, _ = vectors(spark)
    assert vp_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vp_search.search(df, F.col("vec_id") == -1).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(306).select(((F.col("id") * 7) % 307).alias("a"), (((F.col("id") + 1) * 7) % 307).alias("b")).union(spark.createDataFrame([(1000, 1001)], "a long, b long"))
    got = {r["node"]: r["root"] for r in components.components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(307)}, 1000: 1000, 1001: 1000}
    assert components.components(links.limit(0), "a", "b").count() == 0


def test_pipeline(spark, docs, empty, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "source_mix", "best_fit_packing"]
    now, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.common.stored(stage(spark, now, folder))
        assert now.columns == before.columns
        assert {r["doc_id"] for r in now.collect()} <= {r["doc_id"] for r in before.collect()}
    assert now.count() > 0
    packed = corpus_pipeline.run(spark, folder)
    assert packed.where("piece = 0").count() == now.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty.select(*plain.columns), folder).count() == 0
