import html as entities
import itertools
import os
import random
import re
import time
import tracemalloc

import numpy as np
from helpers import saved

from txnlake.llm import html_text as H

PRIOR = np.array(list(H.PRIOR.values()))

PAGE = """<!DOCTYPE html><html><head><title>Title</title><style>p{}</style>
<script>if (a < b) document.write("<p>no</p>");</script></head><body>
<header><a href="/">Home</a> Site name</header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this site work as you expect it to.</div>
<div class="sidebar"><p>Popular stories that others read today on our site.</p></div>
<article><h1>The   headline &amp; more</h1><!-- note -->
<p>First paragraph with <b>bold</b>, <a href="x">a link</a> and&nbsp;caf&eacute; &#8212; done.
<p>Second one,<br>over two lines, is here &lt;now&gt; and goes on for some more words.</p>
<div class="ad">Buy now! Only today.</div>
<blockquote>A quotation that belongs to the article as such.</blockquote>
<form><label>Mail</label><input name=m><button>Subscribe</button></form>
<section id="comments"><p>Reader one says that all of this is wrong, and so on.</p></section>
</article>
<aside><p>Related pieces from the archive that you may like.</p></aside>
<footer>&copy; 2024 The site. All rights reserved.</footer></body></html>"""


def test_a_page_with_all_kinds_of_boilerplate():
    assert H.main_text(PAGE, PRIOR).split("\n") == [
        "The headline & more",
        "First paragraph with bold, a link and café — done.",
        "Second one, over two lines, is here <now> and goes on for some more words.",
        "A quotation that belongs to the article as such.",
    ]


def test_a_page_without_semantic_elements():
    page = re.sub(r"</?(article|section|header|nav|aside)[^>]*>", "", PAGE)
    text = H.main_text(page, PRIOR)
    assert "First paragraph" in text and "Second one" in text
    for other in ("Home", "cookies", "Popular", "Buy now", "Subscribe", "rights reserved"):
        assert other not in text


def test_odd_pages():
    for page in ("", "   ", "<", "<p", "<!--", "<script>x", "</p></b>", "&amp", "<a><b><i>", "<p>" * 3000):
        assert isinstance(H.main_text(page, PRIOR), str)
    assert H.main_text("<article><p>" + "word " * 50_000, PRIOR).count(" ") == 49_999
    deep = "<article>" + "<div>" * 500 + "<p>Deep down there is a paragraph of some words.</p>"
    assert H.main_text(deep, PRIOR) == "Deep down there is a paragraph of some words."


LONG = "This is a paragraph of the article that has more than ten words in it."


def test_end_tags_may_be_missing():
    for page in (
        f"<html><head><title>T</title><body><article><p>{LONG}</article>",
        f"<html><head><meta charset=utf-8><title>T</title><script>x</script><p>{LONG}",
        f"<body><ul><li class=ad>Buy now<li class=nav>Home</ul><article><p>{LONG}",
        f"<article><script>a()</script><p>{LONG}<script>b()",
    ):
        assert H.main_text(page, PRIOR) == LONG
    items = f"<article><ul><li class=ad>Buy now<li>{LONG}<li class=share>Tell all<li>{LONG}</ul>"
    assert H.main_text(items, PRIOR) == f"{LONG}\n{LONG}"
    cells = "<article><table><tr><td>One<td>two<tr><th>Three</table><dl><dt>Four<dd>five</dl>"
    assert H.main_text(f"{cells}<p>{LONG}", PRIOR).split("\n") == [
        "One", "two", "Three", "Four", "five", LONG
    ]


def test_what_is_unseen_does_not_cut_a_block():
    page = "<article><p>These words <script>a()</script>and these <style>b{}</style>are one block.</p>"
    assert H.main_text(page, PRIOR) == "These words and these are one block."


def test_names_of_articles_and_pages():
    title = "A headline of some words"
    for page in (
        f"<article><header class='entry-header'><h1>{title}</h1></header><p>{LONG}</article>",
        f"<div class='article-header'><h1>{title}</h1></div><div class=article-body><p>{LONG}</div>",
        f"<div class='page has-sidebar'><article><h1>{title}</h1><p>{LONG}</article></div>",
        f"<div id='menu-wrap'><main><article><h1>{title}</h1><p>{LONG}</article></main></div>",
    ):
        assert H.main_text(page, PRIOR) == f"{title}\n{LONG}"
    for name in ("site-header", "article-footer", "post-comments", "content sidebar", "main-menu"):
        page = f"<div class='{name}'><p>{LONG}</p></div><article><p>{title}</p></article>"
        assert H.main_text(page, PRIOR) == title


def test_the_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randrange(1, 9)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, i + 1, rng.uniform(0, 2)) for i in range(n - 1)]
        edges += [(*sorted(rng.sample(range(n), 2)), rng.uniform(0, 1)) for _ in range(n // 3) if n > 1]

        def cost(labels, odds=odds, edges=edges):
            wrong = sum(max(0, -x) if y else max(0, x) for x, y in zip(odds, labels, strict=True))
            return wrong + sum(w for a, b, w in edges if labels[a] != labels[b])

        least = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(H.content_side(odds, edges)) - least) < 1e-6


def test_smoothness_moves_a_doubtful_block():
    parent = H._Place(H._Place(H._Place()))
    blocks = [(f"b{i}", 0, H._Place(parent)) for i in range(3)]
    assert H.content_side([4.0, -0.2, 4.0], H.smoothness(blocks)) == [True, True, True]
    assert H.content_side([4.0, -5.0, 4.0], H.smoothness(blocks)) == [True, False, True]


def test_distance_against_paths():
    """Steps between two elements by the numbers of all elements around each."""
    rng = random.Random(5)
    places, paths = [H._Place()], [()]
    for i in range(200):
        k = rng.randrange(max(0, i - 5), i + 1)
        places.append(H._Place(places[k]))
        paths.append((*paths[k], i))
    for _ in range(500):
        i, j = rng.randrange(201), rng.randrange(201)
        shared = len(os.path.commonprefix([paths[i], paths[j]]))
        assert H.distance(places[i], places[j]) == len(paths[i]) + len(paths[j]) - 2 * shared


def test_30000_open_elements():
    few = "Some more words of this article, in a block of their own."
    page = "<article>" + f"<div>{few}" * 30_000 + "</em>" * 30_000 + "<td>" * 30_000
    tracemalloc.start()
    began = time.monotonic()
    text = H.main_text(page, PRIOR)
    seconds, (_, peak) = time.monotonic() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert text == "\n".join([few] * 30_000)
    assert peak < 100e6 and seconds < 60
    mixed = "<nav><a href=x>Home</a></nav>" + f"<div><p>{few}<p><a href=x>Link</a>" * 10_000
    assert H.main_text(mixed, PRIOR)


SCHEMA = "page_id long, url string, html string, text string, place string"


def test_cases(spark, tmp_path):
    rows = [(1, "u", PAGE, "t", "p"), (1, "u", PAGE, "t", "p"), (2, None, None, "t", "p"),
            (None, "v", "", "t", "p"), (3, "w", "<nav><a>only menu</a></nav>", "t", "p")]
    found = H.extract(saved(spark, tmp_path, rows, SCHEMA)).collect()
    assert len(found) == 5
    texts = {(r.page_id, r.url): r.text for r in found}
    assert texts[1, "u"].startswith("The headline & more\nFirst")
    assert [texts[k] for k in ((2, None), (None, "v"), (3, "w"))] == ["", "", ""]
    assert H.extract(saved(spark, tmp_path, [], SCHEMA)).count() == 0


def test_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)[^>]*>", article)
        plain = (" ".join(entities.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts)
        assert found[r.page_id] == "\n".join(p for p in plain if p)
