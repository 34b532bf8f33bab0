"""Main-text extraction: unseen labelled layouts, exact inference, odd pages."""

import itertools
import math

import numpy as np
import pytest

from hiremart.llm import html_text as H
from hiremart.llm.dom import Page


@pytest.fixture(scope="module")
def model():
    return H.fit(*H._examples(H.labelled_layouts(300)))


def test_unseen_layouts(model):
    pages = H.labelled_layouts(120, seed=77)
    right = [page.blocks(model.marginals(page) > 0.5) == page.blocks(label) for page, label in pages]
    assert np.mean(right) >= 0.85


def test_marginals_equal_enumeration(model):
    page = Page("<body><nav><a href=x>a b</a></nav><div class=story><p>Some words here, and more.</p><p>x</p></div></body>")
    n = len(page.nodes)
    unary = [model.weights[f].sum() for f in H.features(page)]
    total = np.zeros(n)
    z = 0.0
    for y in itertools.product((0, 1), repeat=n):
        score = sum(u for u, v in zip(unary, y) if v) + sum(model.pair[y[k.parent], y[k.number]] for k in page.nodes[1:])
        p = math.exp(score)
        z += p
        total += p * np.array(y)
    assert np.allclose(model.marginals(page), total / z)


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>a</a></li><li><a href='/b'>b</a></li></ul></nav>"
     "<!-- ad --><div class='ad'>Buy it.</div><article><h1>Head &amp; tail</h1><p><b>One\n  two<br>three.<br><p>Four &lt;five&gt;</p></article><footer>&copy; x</footer>",
     "Head & tail\nOne two three.\nFour <five>"),
    ("<body><article><p>Long enough text of the story, really.</p><aside>Related</aside><section class='comments'><p>I disagree!</p></section>"
     "<form><label>Mail</label><input><button>Go</button></form><p>The end of it all, with words.</p></article><div class='cookie-banner'><p>We use cookies here.</p></div></body>",
     "Long enough text of the story, really.\nThe end of it all, with words."),
])
def test_known_pages(model, html, text):
    assert model.extract(html) == text


def test_odd_pages(model):
    assert model.extract(None) == model.extract("") == ""
    assert model.extract("<article><p>a<p>b") == "a\nb"
    for odd in ("<" * 3000, "<a " * 3000, '<a "' * 3001, "<div>" * 5000 + "x", "</p>" * 1000, "<p" + " x" * 5000, "<script>never closed"):
        model.extract(odd)
    long = "<article>" + "<p>word word word</p>" * 20_000 + "</article>"
    assert model.extract(long).count("\n") == 19_999


def test_query_on_a_small_table(spark):
    page = "<body><nav><ul><li><a href=a>a</a></li></ul></nav><article><p>Text {} of it.</p></article></body>"
    rows = [(k, f"u{k}", page.format(k), "x", 3) for k in range(8)] + [(9, None, None, "x", 3), (9, None, None, "x", 3), (None, "u", "", "x", 3)]
    got = H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in got.collect()), key=str)
    assert found == sorted([(k, f"Text {k} of it.", len(f"Text {k} of it.")) for k in range(8)] + [(9, "", 0), (9, "", 0), (None, "", 0)], key=str)
    assert H.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
