"""Leaf blocks of pages, and the network that labels them."""

import html
import re
from html.parser import HTMLParser

import numpy as np
import pytest

from guichet.llm import blocks
from guichet.llm.blocks import BlockLabeller, Reader, labelled, leaves, main_text, train, training_pages
from guichet.llm.catalog import QUERIES
from guichet.llm.layouts import varied_page
from tests_llm_paths import SF


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), (" \n ", []), ("plain < text & more", ["plain < text & more"]),
    ("<p>a&amp;b &#233;&nbsp;c<br>d\n\te</p>", ["a&b é c d e"]),
    ("<p><b>one.<br><p>two<div>three</div>four", ["one.", "two", "three", "four"]),
    ("<script>var t=\"</p>\";</script><style>p{}</style><p>x<!-- y --></p><noscript>z</noscript>", ["x"]),
    ("<title>t</title><select><option>o</select><p title='a>b' hidden>c", ["c"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<p>a <i>b</i><a href=x>c</a></p></div></section><p>d<foo", ["a bc", "d"]),
    ("<p>a</p><p class=\"x>b</p>", ["a", "b"]), ("<script>never ends <p>x", []), ("a<!-- never ends", ["a"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
])
def test_leaves(page, want):
    assert [leaf.text for leaf in leaves(page)] == want


class Text(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.parts, self.title = [], False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.title |= tag == "title"

    def handle_endtag(self, tag):
        self.title &= tag != "title"

    def handle_data(self, data):
        if not self.title:
            self.parts.append(data)


def test_leaves_hold_all_text():
    for k in range(150):
        page = varied_page([f"Main & text {i} of <page> {k}." for i in range(1 + k % 7)], ["Menu", "Legal notes"], np.random.default_rng(k))
        assert "".join("".join(leaf.text for leaf in leaves(page)).split()) == "".join("".join(Text(page).parts).split())


def test_paths_and_links():
    found = leaves('<div class="side-bar menuTop" id=x1><a href=y>link</a> and</div><article>b</article>')
    assert {"<div>", "side", "bar", "menu", "top", "x", "/div"} <= found[0].path and 0.4 < found[0].linked < 0.6
    assert found[1].path == {"<article>", "/article"} and found[1].linked == 0
    assert labelled(found).tolist() == [0, 1] and labelled(found[:1]) is None


def test_a_long_broken_page_ends_soon():
    assert len(leaves('<a href="' * 20_000)) <= 1
    assert len(leaves("<div>x" * 20_000)) == 20_000
    assert len(leaves("<p>x<b>" * 50_000)) == 50_000


def test_gradients_equal_differences():
    made = [p for k in range(3) for p in training_pages("<body><nav><a href=/>Home</a></nav><article><h1>One two</h1><p>Three four five.</p></article><footer>End</footer></body>", k)]
    net = BlockLabeller.fresh()
    net.weights = {k: v.astype(np.float64) + (0.1 if k == "direct" else 0) for k, v in net.weights.items()}
    _, g = net.gradients(made)
    for name, w in net.weights.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        old, losses = w[at], []
        for step in (1e-2, -1e-2):
            w[at] = old + step
            losses.append(net.gradients(made)[0])
        w[at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - g[name][at]) < 1e-4 + 0.02 * abs(g[name][at]), name


@pytest.fixture(scope="module")
def fitted(spark):
    return train(spark.read.parquet(f"{SF}/../sf0.01/pages.parquet").filter("page_id % 2 = 0"))


def test_held_out_pages(fitted, duck):
    pages = duck.execute(f"SELECT page_id, html FROM '{SF}/../sf0.01/pages.parquet' WHERE page_id % 2 = 1").fetchall()
    own, copies = [], []
    for k, page in pages:
        made = training_pages(page, 10_000 + k)
        right = [(p >= 0.5) == (m.labels > 0) for p, m in zip(fitted.probabilities(made), made, strict=True)]
        own.append(right[0])
        copies += right[2:]
    assert np.concatenate(own).mean() > 0.99 and np.mean([x.all() for x in own]) > 0.95
    assert np.concatenate(copies).mean() > 0.98


def test_probabilities_do_not_depend_on_the_group(fitted, monkeypatch):
    read = Reader()
    pages = [read.page(leaves(varied_page([f"Text {i}." for i in range(1 + 5 * k)], ["Menu"], np.random.default_rng(k)))) for k in range(12)] + [read.page([])]
    together = fitted.probabilities(pages)
    monkeypatch.setattr(blocks, "PLACES", 1)
    for a, b in zip(together, fitted.probabilities(pages), strict=True):
        assert np.allclose(a, b, atol=1e-5)


def test_main_text_on_awkward_rows(spark, fitted):
    page = "<html><body><nav><a href=/>Home</a></nav><div class=ad>Buy now</div><article><h1>A title of some words</h1><p>The first &amp; only paragraph,<br>with a break.</p></article><footer>&copy; site</footer></body></html>"
    rows = [(1, page, "u"), (1, page, "u"), (2, None, None), (3, "", "u"), (None, page, "u"), (4, "<script>x", "u"), (5, "word " * 300_000, "u"), (6, "<article>" + "<p>Many words in this one.</p>" * 30_000, "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, url string").selectExpr("*", "'x' AS text", "'y' AS id", "1 AS n_blocks")
    got = main_text(df, fitted, "page_id").collect()
    want = "A title of some words\nThe first & only paragraph, with a break."
    assert sorted((r.id or 0, r.text) for r in got if r.text == want) == [(0, want), (1, want), (1, want)]
    assert {r.id: r.text for r in got if r.id in (2, 3, 4)} == {2: "", 3: "", 4: ""}
    assert {r.id: r.n_blocks for r in got}[6] == 30_000 and len(got) == len(rows)
    assert main_text(df.limit(0), fitted, "page_id").count() == 0


def test_without_labelled_pages_usual_layouts_are_known(spark):
    net = train(spark.createDataFrame([(1, None), (2, "<p>no marks</p>")], "page_id long, html string"))
    page = leaves("<nav><a href=/>Home</a></nav><article><p>word1 word2 word3 word4 word5 word6 word7 word8 word9.</p></article><footer>Imprint</footer>")
    assert (net.probabilities([Reader().page(page)])[0] >= 0.5).tolist() == [False, True, False]


def test_query_keeps_the_article(spark, duck):
    got = {r.page_id: r for r in QUERIES["op11_block_labeller"](spark, SF).collect()}
    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    assert len(got) == len(pages)
    right = 0
    for k, url, page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", page, re.S)[1].replace("<br>", " ")
        want = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", article)]
        want = "\n".join(x for x in want if x)
        assert got[k].url == url and got[k].n_chars == len(got[k].text)
        right += got[k].text == want
    assert right >= 0.97 * len(pages)
