"""Whitening, prefix trie and main text beside brute force, on odd rows and on hot groups."""

from __future__ import annotations

import hashlib
import math
import zlib
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from salesflow.llm import lookups, main_text, prefix_trie, whitening
from salesflow.llm.queries import op11_whitening, op12_prefix_trie, op13_main_text

# whitening


def _expected(vectors, weights, most=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors], dtype=object)
    n = sum(weights)
    sums = [sum(w * row[d] for w, row in zip(weights, x)) for d in range(x.shape[1])]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    z = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh((z.T * np.array(weights, dtype=float)) @ z / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return n, deviation, (z @ axes) / np.sqrt(values), values


def _compare(rows, vectors, ids, weights_of_fit, fit):
    n, _, _, values = _expected(fit, weights_of_fit)
    for (key, vector), _ in zip(zip(ids, vectors), ids):
        mine = sorted((r for r in rows if r.vec_id == key), key=lambda r: r.component)
        at = fit.index(vector)
        _, deviation, whitened, _ = _expected(fit, weights_of_fit)
        assert [r.component for r in mine] == list(range(1, len(values) + 1))
        assert {r.n for r in mine} == {n} and {int(r.deviation) for r in mine} == {deviation[at]}
        assert np.allclose(np.abs([r.whitened for r in mine]), np.abs(whitened[at]), atol=1e-9)
        assert all(r.identity_error <= 1e-8 for r in mine)


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(5)
    return [[float(np.float32(c)) for c in row] for row in draw.normal(0, 2, (30, 4))]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_of_repeated_and_odd_rows(spark, vectors, weights):
    rows = [(i, v, "x", 1, 0.0) for i, v in enumerate(vectors)] + [(100 + i, vectors[0], "y", 2, 0.0) for i in range(60)]
    odd = [None, [], [1.0, None, 0.0, 0.0], [math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [1e30, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows += [(200 + i, v, "z", 3, None) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, weight int, whitened double").repartition(5)
    got = whitening.whiten(df, weights=weights).collect()
    assert {r.vec_id for r in got} == set(range(30)) | set(range(100, 160))
    _compare([r for r in got if r.vec_id < 100], vectors, range(30), [61] + [1] * 29 if weights == "counts" else [1] * 30, vectors)
    assert all(r.whitened == next(g.whitened for g in got if g.vec_id == 0 and g.component == r.component) for r in got if r.vec_id >= 100)
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9


def test_whitening_without_variance_or_rows(spark, vectors):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(df).count() == 0 == whitening.whiten(df.limit(0)).count()
    flat = spark.createDataFrame([(i, [float(i), 5.0, 2.0 * i]) for i in range(5)] + [(None, [0.0, 5.0, 0.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 6 and sum(r.vec_id is None for r in got) == 1


def test_products_are_exact_beyond_53_bits():
    x = np.array([[1 << 40, 3], [-(1 << 41), 7]], dtype=np.int64)
    got = whitening._product(x, np.array([5, 1 << 30]), x)
    assert got[0, 0] == 5 * (1 << 80) + (1 << 30) * (1 << 82) and got[0, 1] == 15 * (1 << 40) - 7 * (1 << 71)


def test_whitening_of_large_entries_is_exact(spark):
    vectors = [[2.0**45, 1.0], [0.0, 3.0], [-(2.0**44), 5.0]]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    _, deviation, _, _ = _expected(vectors, [1, 1, 1])
    assert {r.vec_id: r.deviation for r in got} == {i: Decimal(d) for i, d in enumerate(deviation)}


def test_whitening_of_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = op11_whitening(spark, sf).toPandas()
    vectors = [list(map(float, r.embedding)) for r in table]
    n, deviation, whitened, values = _expected(vectors, [1] * len(vectors))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in table]].to_numpy()
    assert np.allclose(np.abs(wide), np.abs(whitened), atol=1e-8) and set(got.n) == {n}
    assert got.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[[r.vec_id for r in table]].tolist() == deviation
    assert got.identity_error.max() < 1e-8 and wide.shape[1] == 32


def test_heavy_keys_are_looked_up_by_broadcast(spark):
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
    table = rows.groupBy("k").count().withColumnRenamed("count", "w").withColumnRenamed("k", "k")
    got = lookups.lookup(rows, table, ["k"], "w", 6000)
    assert got.count() == 6000 and got.where("k = -1").agg({"w": "max"}).first()[0] == 2000
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()


# prefix trie


def _brute(rows, lent=6):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [turn[2:] for turn in sorted(v)] for c, v in own.items()}
    new = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % lent
        new[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, v in new.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
        if path:
            kids.setdefault(path[:-1], []).append(path)
    found = []
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(new[c]) == len(path))))
        above = min(members[path[:-1]]) if path else None
        found.append((min(who), len(path), above, len(who), len(kids.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def _trie(spark, rows, lent=6):
    df = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, body string, n int, depth int")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df.repartition(5), lent=lent).collect()), key=repr)


def test_trie_of_odd_rows(spark):
    rows = [(c, t, "user" if t % 2 else None, f"turn {t} {'é😀' if c % 3 else ''}") for c in (-101, -100, -3, 0, 1, 2, 100, 101, 5000) for t in range(c % 7)]
    rows += [(7, None, "user", "first"), (7, None, None, None), (7, 0, "", ""), (7, 0, "", ""), (8, 3, "user", "x" * 200_000), (None, 0, "user", "nobody's")]
    rows += [(c, 0, "system", "same") for c in range(10, 30)] + [(9000, t, "user", "again") for t in range(3)] + [(9001, 1, None, None)]
    assert _trie(spark, rows) == _brute(rows)
    assert _trie(spark, []) == []


def test_trie_of_copies_across_bands(spark):
    """Long conversations that part at the ends of bands, in them, and never; many end at one node."""
    rows = []
    for c, (common, size) in enumerate([(0, 40), (8, 40), (9, 9), (16, 40), (40, 40), (40, 40), (20, 33), (33, 33), (17, 17), (39, 40)]):
        rows += [(c, t, "user", "shared" if t < common else f"{c}") for t in range(size)]
    rows += [(c, t, "user", "hot") for c in range(100, 400) for t in range(2)]
    assert _trie(spark, rows, lent=1) == _brute(rows, lent=1)
    assert _trie(spark, rows) == _brute(rows)


def test_bands_cover_all_depths(spark):
    depths = spark.range(1, 3000).select("id", prefix_trie._start(prefix_trie.F.col("id")).alias("start")).collect()
    starts = sorted({r.start for r in depths})
    assert starts == prefix_trie.STARTS + [1024, 1536, 2048, 2560]
    assert all(r.start < r.id <= next((s for s in starts if s > r.start), 1 << 60) and r.id - r.start <= prefix_trie.WIDEST for r in depths)


def test_trie_of_the_table(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert sorted((tuple(r) for r in op12_prefix_trie(spark, sf).collect()), key=repr) == _brute(rows)


# main text

ARTICLE = "".join(f"<p>Paragraph {i}, with some words, and a few more of them so that it counts.</p>" for i in range(4))
LINES = "\n".join(f"Paragraph {i}, with some words, and a few more of them so that it counts." for i in range(4))
LONG = "This is what readers wrote, at length, with commas, again and again, longer than the article itself. " * 20


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>  </p>", ""),
        ("only words &amp; signs &#8212; here", "only words & signs — here"),
        ("<nav><a href=/>Home</a></nav>", ""),
        (f"<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article>{ARTICLE}</article><footer>Imprint</footer>", LINES),
        # containers without a name, a heading beside the best one
        (f"<div class=menu><a href=a>A</a></div><div id=page><h1>Title</h1><div class=text>{ARTICLE}</div><div class='right sidebar'><p>{LONG}</p></div></div>", f"Title\n{LINES}"),
        # the comments are longer than the article
        (f"<article>{ARTICLE}</article><section id=comments><p>{LONG}</p></section>", LINES),
        (f"<article>{ARTICLE}<div class='comment-list'><article class=comment><p>{LONG}</p></article></div></article>", LINES),
        # adverts, notices, forms and headers inside
        (f"<article><header class=top><h1>T</h1><p>By A</p></header><div class='adSlot'><p>{LONG}</p></div>{ARTICLE}<form><p>{LONG}</p></form></article>", f"T\n{LINES}"),
        (f"<main><div class=cookie-notice><p>{LONG}</p></div>{ARTICLE}<span class=ad>Buy</span></main>", LINES),
        (f"<div role=dialog><p>{LONG}</p></div><div class=has-sidebar>{ARTICLE}</div>", LINES),
        (f"<aside>{LONG}</aside><div hidden>{LONG}</div><div style='display: none'>{LONG}</div><div>{ARTICLE}</div>", LINES),
        # a menu inside the article, and a list that is text
        (f"<article>{ARTICLE}<ul><li><a href=a>More of this</a><li><a href=b>More of that</a></ul></article>", LINES),
        (f"<article>{ARTICLE}<ul><li>One thing<li>Another <a href=a>thing</a></ul></article>", f"{LINES}\nOne thing\nAnother thing"),
        # sections of one article: the best and its siblings
        (f"<div><div>{ARTICLE}</div><div>{ARTICLE}<p>More, and more, of it.</p></div></div>", f"{LINES}\n{LINES}\nMore, and more, of it."),
        # markup as found: open elements, comments, scripts with tags, cut ends, text in a table
        ("<article><p><b>One, two, three.<br><p>Four<br>five</p><i>six</article>", "One, two, three.\nFour five\nsix"),
        ("<article><!-- <p>no</p> --><script>var t='</p><p>no'</script><p>yes, yes<!--", "yes, yes"),
        ("<article><p>cut off he&am", "cut off he&am"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<article><p title='a > b'>quoted, well</p><style>p{}", "quoted, well"),
        ("<article><table><tr><td>a, b<td>c<tr><td>d</table></article>", "a, b\nc\nd"),
        ("<ARTICLE><P>Upper case,\t\n words</P></ARTICLE>", "Upper case, words"),
    ],
)
def test_main_text_of_pages(page, text):
    assert main_text.main_text(page) == text


def test_main_text_keeps_rows_and_columns(spark):
    long = f"<article>{ARTICLE * 20_000}</article>"
    rows = [(1, "u", None, 0), (1, "u", None, 0), (None, None, "<p>a, b</p>", 1), (2, "v", long, 2), (3, "w", "<div>" * 50_000 + "deep, deep", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = main_text.with_main_text(df).collect()
    assert [(r.page_id, r.url, r.html, r.n_chars) for r in got] == rows
    assert [r.text for r in got[:3]] == ["", "", "a, b"] and got[3].text == "\n".join([LINES] * 20_000) and got[4].text == "deep, deep"
    assert main_text.with_main_text(df.limit(0)).count() == 0


def test_main_text_of_the_table(spark, sf):
    """The pages of the table have one layout: the article element holds the text and nothing else."""
    import html
    import re

    def article(page):
        inner = page.split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", inner))
        return "\n".join(b for b in blocks if b)

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op13_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    assert all(r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)
