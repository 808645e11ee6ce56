import numpy as np
import pytest
from pyspark.sql import functions as F

from glint.llm import embed_dedup, html_extract, topk
from glint.llm.common import components, skew_lookup

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def odd_vectors():
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((6, 16))
    near = [(100 + i, (centre[i % 6] + 0.02 * rng.standard_normal(16)).tolist(), i % 2) for i in range(120)]
    free = [(300 + i, rng.standard_normal(16).tolist(), i % 3 if i % 7 else None) for i in range(80)]
    copies = [(500 + i, near[0][1], 0) for i in range(5)] + [(600, [2 * x for x in near[0][1]], 0)]
    odd = [(1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [float("nan")] + [1.0] * 15, 0), (5, [None] + [1.0] * 15, 0),
           (6, [float("inf")] + [1.0] * 15, 0), (7, [1.0, 2.0], 0), (8, [1.0, 2.0], 0), (9, near[0][1], None), (500, near[0][1], 0)]
    return near + free + copies + odd


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


# --- embedding dedup ------------------------------------------------------

def brute_links(rows, least):
    n, ok = len(rows), [r[2] is not None and usable(r[1]) and any(r[1]) for r in rows]
    unit = [np.array(np.float32(r[1]), float) / np.linalg.norm(np.float32(r[1]).astype(float)) if k else None for r, k in zip(rows, ok)]
    count, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                count[i] += 1
                count[j] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    name = {k: min(rows[i][0] for i in range(n) if root[i] == k) for k in set(root)}
    return sorted((r[0], c, name[k], r[0] == name[k]) for r, c, k in zip(rows, count, root))


def test_links_equal_brute_force(spark, odd_vectors, monkeypatch):
    table = spark.createDataFrame(odd_vectors, VECTORS).withColumn("n", F.lit(1)).withColumn("key", F.lit("x"))
    want = brute_links(odd_vectors, 0.98)
    assert sorted(map(tuple, embed_dedup.embedding_dedup(table).collect())) == want
    # several shards and blocks of queries per group
    monkeypatch.setattr(embed_dedup, "SHARD", 20)
    monkeypatch.setattr(embed_dedup, "QUERIES", 30)
    assert sorted(map(tuple, embed_dedup.embedding_dedup(table).collect())) == want


def test_no_vectors(spark):
    assert embed_dedup.embedding_dedup(spark.createDataFrame([], VECTORS)).count() == 0
    assert topk.topk_search(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((300, 24)), 8, axis=0) + 0.05 * rng.standard_normal((2400, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = embed_dedup.Graph(x)
    found = hits = 0
    truth = x @ x.T >= 0.95
    for at in range(0, 2400, 300):
        for i, f in enumerate(g.links(x[at: at + 300], 0.95, 64)):
            assert truth[at + i, f].all()
            found += len(set(f.tolist()))
            hits += truth[at + i].sum()
    assert found / hits >= 0.99


# --- top-k ----------------------------------------------------------------

def test_topk_equals_brute_force(spark, odd_vectors, monkeypatch):
    table = spark.createDataFrame(odd_vectors, VECTORS).withColumn("part", F.lit("x")).withColumn("score", F.lit("x"))
    rows = [(r[0], np.floor(256 * np.float32(r[1]).astype(float)).astype(int)) for r in odd_vectors if usable(r[1])]
    want = []
    for q, v in {r[0]: r for r in rows if r[0] % 10 == 0}.values():
        scored = sorted((-int(v @ w), i) for i, w in rows if i != q and len(w) == len(v))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    ask = F.col("vec_id") % 10 == 0
    assert sorted(map(tuple, topk.topk_search(table, ask).collect())) == sorted(want)
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "TILE", 4)
    assert sorted(map(tuple, topk.topk_search(table, ask).collect())) == sorted(want)


def test_large_components_stay_exact(spark):
    big = [(0, [1e12, 1.0, 3.0], 0), (1, [1e12, 1.0, 1.0], 0), (2, [1e12, 1.0, 2.0], 0)]
    table = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    got = topk.topk_search(table, F.col("vec_id") == 0, scale=1.0).collect()
    top = 2**63 - 1
    assert [(r.vec_id, r.score) for r in got] == [(1, top), (2, top)]  # saturated: ties by id
    small = spark.createDataFrame([(i, [2.0**30, 2.0**28 + i], 0) for i in range(3)], table.schema)
    got = topk.topk_search(small, F.col("vec_id") == 0, scale=1.0).collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 2**60 + 2**28 * (2**28 + i)) for i in (2, 1)]


# --- shared helpers -------------------------------------------------------

def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(200, 260)] + [(300 + i, 300 + (i + 7) % 20) for i in range(20)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {k: v for k, v in root.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_skew_lookup_splits_heavy_keys(spark, monkeypatch):
    from glint.llm import common

    monkeypatch.setattr(common, "HEAVY_ROWS", 50)
    rows = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("k"), "id")
    table = spark.createDataFrame([(0, "hot", 200), (250, "x", 1), (999, "y", 1)], "k long, v string, w long")
    left = skew_lookup(rows, table, "k", "w", 300).collect()
    assert len(left) == 300 and sum(r.v == "hot" for r in left) == 200 and sum(r.v == "x" for r in left) == 1
    assert skew_lookup(rows, table, "k", "w", 300, "inner").count() == 201


# --- HTML -----------------------------------------------------------------

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul>'
    '<li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad --><div class="ad">Buy now.</div><article><h1>Head {0}</h1>'
    "<p><b>First {0} &amp; more\n text.<br><p>Second  paragraph {0}, with words.</p></article><footer>&copy; site &middot; words.</footer></body></html>")


@pytest.fixture(scope="module")
def labeller():
    return html_extract.fit([PAGE.format(f"{i} " + "alpha beta gamma delta. " * (i % 7 + 1)) for i in range(150)])


def text_of(model, html):
    page = html_extract.blocks(html)
    keep = html_extract.label_pages(model, [page])[0]
    return [t for (_, t, _), k in zip(page, keep) if k]


def test_articles_are_exact(labeller):
    for i in (3, 50):
        assert text_of(labeller, PAGE.format(i)) == [f"Head {i}", f"First {i} & more text.", f"Second paragraph {i}, with words."]
    cut = PAGE.format(9)
    assert text_of(labeller, cut[: cut.index("</article>")] + "</arti")[-1] == "Second paragraph 9, with words."


def test_other_boilerplate_goes(labeller):
    html = (
        "<html><body><header><div class='menu'>Start here</div></header><div class='cookie notice'>We use cookies.</div><main><article><h1>Title of it</h1>"
        "<p>The body of the article is here, it has several words. And sentences.</p><p>Another paragraph of the article with words.</p></article>"
        "<section class='comments'><p>Nice article, I liked the body of it.</p><p>Me too.</p></section></main><aside class='sidebar'><ul><li>Popular</li>"
        "<li>Recent</li></ul></aside><form class='newsletter'><p>Subscribe to our letter</p></form><footer>Imprint</footer></body></html>")
    assert text_of(labeller, html) == [
        "Title of it", "The body of the article is here, it has several words. And sentences.", "Another paragraph of the article with words."]


def test_blocks_of_odd_markup():
    texts = lambda h: [t for _, t, _ in html_extract.blocks(h)]
    assert texts("") == [] and texts("plain") == ["plain"]
    assert texts("a < b and c<d>e</d> &am &amp x") == ["a < b and c", "e", "&am & x"]
    assert texts("<p>one<script>if (a<b) '<p>no</p>'</script>two<p>three<style>x") == ["one two", "three"]
    assert texts("<p title='a>b'>x</p><!-- <p>y</p> --><p>z<br>w") == ["x", "z w"]
    assert texts("<p>cut <b") == ["cut"]


def test_pages_odd_rows(spark):
    rows = [(i, f"u{i}", PAGE.format(i)) for i in range(40)] + [(90, None, None), (91, "u", ""), (None, "u", "<p>"), (1, "u1", PAGE.format(1))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html_extract.extract_main(table).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (90, 91, None)} == {""}
    assert len({r.text for r in got if r.page_id == 1}) == 1
    assert html_extract.extract_main(spark.createDataFrame([], table.schema)).count() == 0


def test_gradients_match_differences():
    rng, model = np.random.default_rng(1), html_extract.Labeller(hidden=3)
    x, mask = html_extract.padded([rng.random((4, html_extract.DIM)).astype(np.float32), rng.random((2, html_extract.DIM)).astype(np.float32)])
    y = np.array([[1, 0, 1, 0], [0, 1, -1, -1]], np.float32)
    known = (y >= 0) * mask
    loss = lambda: float((-(y * np.log(p := model.score(x, mask)) + (1 - y) * np.log(1 - p)) * known).sum() / known.sum())
    grad = model.gradients(x, mask, y, known)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    for k in model.p:
        at = tuple(rng.integers(0, s) for s in model.p[k].shape)
        old = model.p[k][at]
        model.p[k][at] = old + 1e-3
        up = loss()
        model.p[k][at] = old - 1e-3
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / 2e-3 - grad[k][at]) < 1e-3 + 0.02 * abs(grad[k][at]), k


def test_elements_that_are_not_raw_lose_no_text():
    texts = lambda h: [t for _, t, _ in html_extract.blocks(f"<article><p>one</p>{h}<p>two</p></article>")]
    for h in ("<svg width=1/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<video-js></video-js>", "<template-x>", "<script-x>", "<object data=x>", "<video>", "<select>",
              "<p title=it's>", '<p title=5">', "<script>var t = '<p>no</p>'</script>", '<script src="a>b">no</script>', "<style/>p{}</style>"):
        assert texts(h) == ["one", "two"], h
    assert texts("<math><mi>x</mi></math>") == ["one", "x", "two"]
    assert texts("<p title='a > b' class=c>in</p>") == ["one", "in", "two"]
    assert texts("<script>open") == ["one"]
    path = html_extract.blocks("<article><svg class=icon /><p>two")[0][0]
    assert [w[0] for w in path] == ["article", "p"]


PROSE = "The river town has kept its old mill running for more than a century, and people still come to see it."
MENU = '<div class="zeta"><ul><li><a href=1>Start</a></li><li><a href=2>World</a></li><li><a href=3>Sports</a></li></ul></div>'
FOOT = '<div class="omega"><p>All rights kept 2024</p></div>'
# body attributes and html of pages whose wrappers no lexicon knows, and their main blocks
PAGES = {
    "list": ("", f"{MENU}<article><h1>Head</h1><p>{PROSE}</p><ul><li>Flour</li><li>Water and salt</li><li>A pinch of yeast</li></ul><p>{PROSE}</p></article>{FOOT}",
             ["Head", PROSE, "Flour", "Water and salt", "A pinch of yeast", PROSE]),
    "table": ("", f"{MENU}<article><h1>Head</h1><p>{PROSE}</p><table><tr><th>Year</th><th>Tons</th></tr><tr><td>1999</td><td>12</td></tr></table></article>{FOOT}",
              ["Head", PROSE, "Year", "Tons", "1999", "12"]),
    "quote and code": ("", f"{MENU}<article><h1>Head</h1><p>{PROSE}</p><blockquote>We never stopped.</blockquote><pre>x = 1</pre><p>{PROSE}</p></article>{FOOT}",
                       ["Head", PROSE, "We never stopped.", "x = 1", PROSE]),
    "definitions": ("", f"{MENU}<article><h1>Head</h1><dl><dt>Mill</dt><dd>{PROSE}</dd></dl><figure><img src=x><figcaption>The mill in May</figcaption></figure><p>{PROSE}</p></article>{FOOT}",
                    ["Head", "Mill", PROSE, "The mill in May", PROSE]),
    "sections": ("", f"{MENU}<article><h1>Head</h1><section><h2>Then</h2><p>{PROSE}</p></section><section><h2>Now</h2><p>{PROSE}</p></section></article>{FOOT}",
                 ["Head", "Then", PROSE, "Now", PROSE]),
    "heading group": ("", f"<article><header><h1>Head</h1></header><p>{PROSE}</p><h2>Sub</h2><p>{PROSE}</p></article><aside><p>Other news</p></aside>",
                      ["Head", PROSE, "Sub", PROSE]),
    "body classes": (' class="home no-sidebar"', f"<article><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></article><footer>Imprint</footer>", ["Head", PROSE, PROSE]),
    "page in a form": ("", f"<form id=f1 action=x>{MENU}<article><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></article>{FOOT}</form>", ["Head", PROSE, PROSE]),
    "no article in a form": ("", f'<form action=q><div class="rho">{MENU}</div><div class="nu"><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>{FOOT}</form>',
                             ["Head", PROSE, PROSE, PROSE]),
    "banner and comments": ("", f'<div class="kappa"><p>We value your choice. Accept all?</p></div><article><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></article>'
                            f'<div class="lambda"><p>Great read, thank you so much for it!</p><p>I do not agree with this at all.</p></div>{FOOT}', ["Head", PROSE, PROSE]),
    "teaser": ("", f'<article><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></article><div class="mu"><h3>More for you</h3><p>Ten mills to see this year</p></div>', ["Head", PROSE, PROSE]),
    "main": ("", f"<div id=top>Site name</div><main><h1>Head</h1><p>{PROSE}</p><ol><li>One step</li><li>Two steps</li></ol><p>{PROSE}</p></main>{FOOT}",
             ["Head", PROSE, "One step", "Two steps", PROSE]),
    "advert and form inside": ("", f'<article><h1>Head</h1><p>{PROSE}</p><div class="ad">Buy a mill.</div><p>{PROSE}</p><form><p>Your mail</p></form></article>',
                               ["Head", PROSE, PROSE]),
}


@pytest.fixture(scope="module")
def given_labeller():
    import pyarrow.parquet as pq

    return html_extract.fit(pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist())


@pytest.mark.parametrize("name", PAGES)
def test_articles_of_other_shapes(given_labeller, name):
    attrs, body, want = PAGES[name]
    assert text_of(given_labeller, f"<html><head><title>t</title></head><body{attrs}>{body}</body></html>") == want


def test_innermost_known_element_decides():
    path = lambda h: html_extract.blocks(h)[0][0]
    label = lambda h: html_extract.teacher(path(h))
    assert label("<body class='nav'><article><p>x") == 1 and label("<body class='article'><p>x") == -1
    assert label("<div class='sidebar'><article>x") == 1 and label("<article><div class='site-footer'>x") == 0
    assert label("<div class='no-sidebar'><p>x") == -1 and label("<div class=articleBody>x") == 1
    assert label("<article><header><h1>x") == 1 and label("<header><h1>x") == 0
    assert label("<body><form><p>x") == -1 and label("<body><main><form><p>x") == 0


def test_training_takes_distinct_pages(spark):
    rows = [(i, "u", PAGE.format("copy")) for i in range(400)] + [(1000 + i, "u", PAGE.format(i)) for i in range(60)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = html_extract.extract_main(table, sample_pages=50)
    assert got.where(~F.col("text").startswith("Head ")).count() == 0 and got.count() == 460


def shard_rows(build, asked):
    import pyarrow as pa

    rows = [("g", 0, i, 1, v) for i, v in enumerate(build)] + [("g", 2, 100_000 + i, 1, v) for i, v in enumerate(asked)]
    names = ["grp", "own", "cid", "n", "vec"]
    return iter([pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names)])


@pytest.mark.parametrize("weak", [False, True])
def test_rare_pairs_beside_a_crowd(monkeypatch, weak):
    """Links of rare pairs, in the shard and asked from another, are found;
    also by a search that misses much until its beam is widened."""
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    crowd = unit(rng.standard_normal((1, 24)) + 0.3 * rng.standard_normal((1200, 24)))
    rare = unit(rng.standard_normal((100, 24)))
    near = lambda v: unit(v + 0.005 * rng.standard_normal(v.shape))
    build, asked = np.concatenate((crowd, rare, near(rare))), np.concatenate((near(rare), unit(rng.standard_normal((50, 24)))))
    widths = []
    real = embed_dedup.Graph.links

    def links(self, q, least, width):
        widths.append(width)
        got = real(self, q, least, width)
        # a weak search finds only the vector itself below a beam of 128
        return [f[self.x[f] @ v > 1 - 1e-12] for f, v in zip(got, q)] if weak and width < 128 else got

    monkeypatch.setattr(embed_dedup.Graph, "links", links)
    got = {}
    for b in embed_dedup._shard_links(0.98)(shard_rows(build, asked)):
        got |= dict(zip(b.column("cid").to_pylist(), b.column("links").to_pylist()))
    for v, ids, own in ((build, range(len(build)), 1), (asked, range(100_000, 100_000 + len(asked)), 0)):
        truth = (v @ build.T >= 0.98).sum(1) - own
        assert truth.sum() >= 200 and [got[i] for i in ids] == truth.tolist()
    assert max(widths) == (128 if weak else 32)
