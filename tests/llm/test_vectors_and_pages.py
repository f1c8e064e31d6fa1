"""The operators over embeddings and pages."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from capsight.llm import ann, embedding_dedup, html_text, rp_forest, url_filter
from capsight.llm.common import connected_components, local_forest

EDGES = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, float("nan")] + [0.0] * 6), (904, [1.0, float("inf")] + [0.0] * 6), (905, [1.0, None] + [0.0] * 6),
         (906, [1.0, 2.0]), (None, [1.0] + [0.0] * 7)]


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cid": F.lit(1), "v": F.lit(2), "leaf": F.lit(3), "path": F.lit(4), "score": F.lit(5)})


def _clustered(n, seed=1, width=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(max(2, n // 12), width))
    rows = centre[rng.integers(0, len(centre), n)] + rng.normal(size=(n, width)) * 0.08
    return [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(rows)]


def test_ann_recall_and_exact_scores(spark):
    rows = _clustered(800)
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # copies of a query
    got = {}
    for r in ann.nearest(_vectors(spark, rows + EDGES), F.col("vec_id") % 100 == 0, share=0.6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    hit = total = 0
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        assert all(abs(dict(zip(ids.tolist(), d))[v] - s) < 1e-12 for _, v, s in found)
        hit += len({ids[k] for k in order} & {f[1] for f in found})
        total += 10
    assert hit >= 0.9 * total
    assert [f[1] for f in got[0]] == list(range(2000, 2010))  # ties go to the smaller ids


def test_ann_few_and_none(spark):
    got = ann.nearest(_vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.5]), (2, None)]), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 0.5)]
    assert ann.nearest(_vectors(spark, EDGES[:3]), F.col("vec_id") >= 0).count() == 0
    assert ann.nearest(_vectors(spark, []), F.col("vec_id") >= 0).count() == 0


def test_ann_far_from_the_origin_and_at_extreme_scales(spark):
    rng = np.random.default_rng(7)
    for offset, scale in ((1e8, 1.0), (0.0, 1e-170), (0.0, 1e160)):
        rows = [(i, [float(x) for x in offset + scale * v]) for i, v in enumerate(rng.normal(size=(120, 6)))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {}
        for r in ann.nearest(df, F.col("vec_id") % 40 == 0, share=100.0).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        x = np.array([v for _, v in rows]) - offset
        for q, found in got.items():
            d = (((x - x[q]) / scale) ** 2).sum(1)
            assert [v for _, v in sorted(found)] == [int(k) for k in np.argsort(d, kind="stable") if k != q][:10]


def test_embedding_links_at_extreme_lengths(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1.01e-200]), (3, [1.0, 1.0]), (4, [-1e300, 1e300])]
    out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out.collect()} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def _brute(rows, cosine):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows])
    s = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None] >= cosine - 1e-12
    np.fill_diagonal(s, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[k], *label[s[k]]]) for k in range(len(ids))])
        if (new == label).all():
            return dict(zip(ids, zip(s.sum(1).tolist(), label.tolist())))
        label = new


def test_embedding_dedup_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PAIR_ROWS", 20)
    rows = _clustered(500, 3)
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    out = embedding_dedup.near_duplicates(_vectors(spark, rows + EDGES), leaf_rows=64)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out.collect()}
    want = _brute(rows, 0.95)
    exact = sum(got[i][0] == n for i, (n, _) in want.items())
    assert exact >= 0.97 * len(want) and all(got[i][0] <= n for i, (n, _) in want.items())
    assert sum(got[i][1] == c for i, (_, c) in want.items()) >= 0.97 * len(want)
    assert all(got[i] == (0, i, True) for i, _ in EDGES if i is not None) and got[None] == (0, None, None)


def test_embedding_dedup_one_hot_group(spark):
    """Near copies that no split separates stay one leaf and are compared in blocks."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in np.eye(6)[0] + rng.normal(size=6) * 1e-3]) for i in range(300)]
    out = embedding_dedup.near_duplicates(_vectors(spark, rows), leaf_rows=50, trees=2).collect()
    assert {(r["n_links"], r["component_id"]) for r in out} == {(299, 0)}
    assert embedding_dedup.near_duplicates(_vectors(spark, [])).count() == 0


def test_embedding_dedup_of_groups_larger_than_leaves(spark):
    """Distinct near copies, many times a leaf, among rows without links: a link is lost at no split."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(2, 64))
    centre /= np.linalg.norm(centre, axis=1)[:, None]
    other = rng.normal(size=(1600, 64))
    rows = np.concatenate([centre[0] + rng.normal(size=(900, 64)) * 0.17 / 8, centre[1] + rng.normal(size=(300, 64)) * 0.17 / 8, other / 8])
    rows = [(i, x.tolist()) for i, x in enumerate(rows[rng.permutation(len(rows))])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(_vectors(spark, rows), leaf_rows=64, trees=3).collect()}
    assert got == _brute(rows, 0.95)


def test_embedding_dedup_of_scaled_copies(spark):
    """The length of a vector does not matter."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 32)) + 1
    rows = [(i, x.tolist()) for i, x in enumerate(base)] + [(5000 + i, (x * rng.uniform(1.2, 10)).tolist()) for i, x in enumerate(base)]
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(_vectors(spark, rows), leaf_rows=64).collect()}
    want = _brute(rows, 0.95)
    assert sum(got.values()) >= 0.97 * sum(n for n, _ in want.values()) and all(got[i] <= n for i, (n, _) in want.items())


def test_forest_routing_with_spill():
    rows = np.random.default_rng(2).normal(size=(400, 5))
    tree = rp_forest.build(rows, 20, [1], 0.2)
    row, leaf = rp_forest.route(tree, rows)
    assert set(row) == set(range(400)) and len(row) > 400 and leaf.max() < tree.leaves
    same = rp_forest.build(np.ones((50, 3)), 10, [1])
    assert same.leaves == 1 and rp_forest.route(same, np.ones((4, 3)))[1].tolist() == [0] * 4


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2001, 2000), (2000, 2000), (5, 1150)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {i: 0 for i in [*range(301), *range(1000, 1200)]} | {2000: 2000, 2001: 2000}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    node, root = local_forest(np.array([5, 3, 9]), np.array([3, 1, 9]))
    assert dict(zip(node.tolist(), root.tolist())) == {3: 1, 5: 1}


# --- urls ---------------------------------------------------------------------

def test_url_verdicts(spark):
    rows = [(1, "https://WWW.Example.NET/en/a?x#y", "example.net/en/", "allow"), (2, "http://a.net/x", "net/", "block"), (3, "http://b.example.com/de/1", "example.com/de/", "block"),
            (4, "https://c.org/fr/", "org/fr/", "allow"), (5, "https://my-casino.example.com/x", None, "block"), (6, "https://free-win.com/", None, "block"),
            (7, "https://free.com/", None, "allow"), (8, "https://free.com/free/FREE", None, "allow"), (9, "https://casinoville.com/", None, "allow"), (10, None, None, "allow"),
            (11, "no scheme/casino", None, "allow"), (12, "", None, "allow"), (13, "http://notexample.net", None, "allow"), (14, "x://h?casino", None, "allow"),
            (15, "https://ok.com/" + "a/" * 40_000 + "porn", None, "block"), (15, "https://free.com/", None, "allow")]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").withColumns({c: F.lit(1) for c in ("rule", "host", "_hits", "soft_hits")})
    got = sorted((r["page_id"], r["rule"] or "", r["verdict"]) for r in url_filter.judge(pages).collect())
    assert got == sorted((i, rule or "", v) for i, _, rule, v in rows)
    first = url_filter.judge(pages).filter("page_id = 1").first()
    assert (first["host"], first["path"]) == ("www.example.net", "/en/a")
    assert url_filter.judge(pages.limit(0)).count() == 0 and url_filter.judge(pages, vocabulary={}).filter("page_id = 5").first()["verdict"] == "allow"


# --- html ---------------------------------------------------------------------

LONG = "This is a long paragraph of prose with many words in it, so that it stands out from the rest of the page."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>one<p>two<b>three</b>four", "one twothreefour"),
    ("<nav><a>x</a><article><p>Hello world</p></article>", "Hello world"), ("<![foo]><p>a&nbsp; b</p>", "a b"),
    ("<title>T</title><script>var a='<p>'</script><style>p{}</style><noscript>n</noscript><body>Hi <i>t</i>here", "Hi there"),
    (f"<body><header>Site</header><nav><ul><li>Home</ul></nav><div class=ad>Buy</div><article><h1>Head</h1><p>{LONG}<p>Short.<p>{LONG}<form>Name <input></form>"
     f"<section class=comments><p>{LONG}</section></article><aside>{LONG}</aside><footer>&copy; x", f"Head {LONG} Short. {LONG}"),
    (f"<div id=top-menu><a>Home</a></div><div class=content><h2>Head</h2><div>{LONG}</div><div>Tiny.</div><div>{LONG}</div></div><div id=cookie-notice>{LONG}</div>", f"Head {LONG} Tiny. {LONG}"),
    (f"<main><p>{LONG}</p><div class='comment-list'><p>{LONG}</p></div></main>", LONG), ("<p hidden>no</p><p>yes</p>", "yes"),
])
def test_html_regions(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize("name", ["layout has-sidebar", "content no-sidebar", "site fixed-header", "post-content comments-open"])
def test_html_hints_mask_no_wrapper(name):
    inner = f"<h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    around = f"<div class=sidebar><p>{LONG}</p></div><div class=comment-list><p>{LONG}</p></div>"
    for wrapped in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div>{inner}</div>"):
        assert html_text.main_text(f"<body><nav><a>x</a></nav><div class='{name}'>{wrapped}</div>{around}</body>".replace(around, "" if "<div>" in wrapped else around)) == f"Head {LONG} Short. {LONG}"
    assert html_text.main_text(f"<body><div class='{name}'><article>{inner}</article>{around}</div></body>") == f"Head {LONG} Short. {LONG}"
    assert html_text.main_text(f"<body><article class='{name}'>{inner}</article></body>") == f"Head {LONG} Short. {LONG}"


def test_html_regions_lose_no_chosen_block():
    parts = [f"{LONG} Part {i}." for i in range(4)]
    one, rest = parts[0], "".join(f"<p>{x}</p>" for x in parts[1:])
    for page in (f"<div><p>{one}</p></div><div>{rest}</div>", f"<article><p>{one}</p></article><article>{rest}</article>", f"<div><p>{one}</p></div><article>{rest}</article>",
                 f"{one}<div><article>{rest}</article></div>", f"<div><div>{one}</div><div><div>{rest}</div></div></div>"):
        assert html_text.main_text(f"<body><nav><a>x</a></nav>{page}<footer>f</footer></body>") == " ".join(parts), page


def test_html_clusters_choose_the_region(monkeypatch):
    """Blocks without any telling name: with one ratio for all lines, the site's own lines would come along, in pages with articles too."""
    site = "<div><div><i>Home</i></div><div><i>About</i> <i>us</i></div><div><i>Contact</i></div></div>"
    tail = "<div><div><i>More</i> <i>of</i> <i>this</i></div><div><i>Back</i> <i>up</i></div><div><i>Top</i></div></div>"
    pages = {f"<body>{site}<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>End.</p></article>{tail}</body>": f"Head {LONG} {LONG} End.",
             f"<body>{site}<div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>{tail}</body>": f"{LONG} Short. {LONG}"}
    for html, text in pages.items():
        assert html_text.main_text(html) == text
    monkeypatch.setattr(html_text, "smooth", lambda values, sigma=1.0: [1.0] * len(values))
    for html, text in pages.items():
        got = html_text.main_text(html)
        assert got != text and got.startswith("Home") and got.endswith("Top")


@pytest.mark.parametrize("html, text", [
    (f"<p>{LONG}</p><table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>", f"{LONG} a 1 b 2"),
    (f"<div id=x><p>{LONG}</p><table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table><p>End</p><p>of</p><p>it</p></div>", f"{LONG} a 1 b 2 End of it"),
    (f"<article><p>{LONG}</p><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><p>x</p><p>y</p><p>z</p></article>", f"{LONG} one two x y z"),
    (f"<body><p>{LONG}</p><p>a</p><p>b</p><p>c</p><p>d</p><div><div><a href=x>Home</a></div></div></body>", f"{LONG} a b c d"),
    (f"<body><div><div><p>{LONG}</p><p>{LONG}</p></div></div><div><div><p>{LONG}</p></div></div></body>", f"{LONG} {LONG} {LONG}"),
])
def test_html_content_is_whole(html, text):
    assert html_text.main_text(html) == text


def test_html_clusters_equal_a_plain_computation():
    """Ratios, Gaussian weights and threshold of every test page written out with numpy."""
    import pyarrow.parquet as pq
    for html in pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist():
        lines = html_text.read(html).lines
        ratio = np.array([(len(t) - linked) / max(1, tags) for t, tags, linked, *_ in lines]).clip(0)
        far = np.abs(np.arange(len(lines))[:, None] - np.arange(len(lines))[None, :])
        weights = np.where(far <= 3, np.exp(-far ** 2 / 2), 0)
        level = (weights * ratio[None, :]).sum(1) / weights.sum(1)
        assert html_text.chosen_lines(lines) == ((level >= 0.5 * level.std()) & (ratio >= 0.5 * level.std())).tolist()


def test_html_second_reading_only_where_needed(monkeypatch):
    """An advert causes none beside a page's worth of text; the result is that of a reading that always asks."""
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    asked, wrappers = [], html_text._wrappers
    monkeypatch.setattr(html_text, "_wrappers", lambda html: asked.append(1) or wrappers(html))
    first = [html_text.main_text(p) for p in pages]
    assert len(asked) < len(pages) / 10
    asked.clear()
    monkeypatch.setattr(html_text, "LEFT", 10.0)
    assert [html_text.main_text(p) for p in pages] == first and len(asked) == len(pages)


def test_html_over_pages(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (3, "v", "<p>" + "w " * 200_000 + "</p>"), (None, "x", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(2), "_html": F.lit(3)})
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 4), (1, 1), (1, 1), (2, 0), (3, 399_999)]
    assert all(len(r["text"]) == r["n_chars"] for r in got) and html_text.extract(pages.limit(0)).count() == 0
