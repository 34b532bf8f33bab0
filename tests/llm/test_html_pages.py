"""Hand-written pages with known text; the names of wrappers are not among those the layouts are made of."""

import time

import numpy as np
import pytest

from hiremart.llm import html_text as H
from hiremart.llm.dom import Page

NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/sport'>Sport</a></li></ul></nav>"
MENU = "<ul class='menu'><li><a href='/1'>Prices</a></li><li><a href='/2'>Teams</a></li><li><a href='/3'>Contact us</a></li></ul>"
FOOT = "<footer><p>Copyright 2020 The River Gazette</p><a href='/imprint'>Imprint</a></footer>"
SIDE = "<aside><h3>Most read</h3><ul><li><a href='/a'>Storm ahead</a></li><li><a href='/b'>Cup final</a></li></ul></aside>"
FORM = "<form action='/s'><label>Search</label><input name=q><button>Find</button></form>"
COOKIE = "<div class='cookie-notice'><p>We use cookies to make this site work for you.</p><button>Fine</button></div>"
AD = "<div class='ad'>Buy two lamps and pay for one only this week.</div>"
A = "The council met on Tuesday and spoke for three hours about the old bridge over the river."
B = "Nobody could say how long the repair would take, since the pillars had not been looked at for years."
C = "A second meeting is planned for the spring, when the engineers have written their report."
SHORT = "It rained."
P = lambda *t: "".join(f"<p>{x}</p>" for x in t)

#: (page, text): blocks in page order.
PAGES = [
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A, B, C)}</article>{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body>{NAV}<main><h1>Old bridge</h1>{P(A, SHORT, C)}</main>{SIDE}{FOOT}</body>", ["Old bridge", A, SHORT, C]),
    (f"<body>{NAV}<div class='wrap'><h1>Old bridge</h1>{P(A, B, C)}</div>{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body>{MENU}<div id='zone7'><h2>Old bridge</h2>{P(A, B, C)}</div>{AD}{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body><div class='outer'>{NAV}<div class='middle'><h1>Old bridge</h1>{P(A, B)}{AD}{P(C)}</div></div>{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body>{NAV}<article><h1>T</h1>{P(A)}<aside>Related</aside>{P(B)}</article>{FOOT}</body>", ["T", A, B]),
    (f"<body><article>{P(A)}<section class='comments'><p>I disagree!</p></section>{P(B, C)}</article>{COOKIE}</body>", [A, B, C]),
    (f"<body><article>{P(A, B)}<div class='user-feedback'><p>I disagree!</p><p>So do I, and strongly.</p></div></article>{FOOT}</body>", [A, B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A)}<p>See <a href='/x'>this link text that is long</a>.</p>{P(B)}</article></body>", ["Old bridge", A, "See this link text that is long.", B]),
    (f"<body>{NAV}<article><h1>Sources</h1>{P(A)}<ul><li><a href='/r1'>Report of the engineers</a></li><li><a href='/r2'>Minutes of the meeting</a></li></ul>{P(B)}</article>{FOOT}</body>",
     ["Sources", A, "Report of the engineers", "Minutes of the meeting", B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A)}{FORM}{P(B)}</article>{FOOT}</body>", ["Old bridge", A, B]),
    (f"<body>{COOKIE}{NAV}<section class='story'><h1>Old bridge</h1>{P(A, B)}</section>{SIDE}{FOOT}</body>", ["Old bridge", A, B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1><blockquote><p>{B}</p></blockquote>{P(C)}</article></body>", ["Old bridge", B, C]),
    (f"<body>{NAV}<article><h1>Steps</h1>{P(A)}<ol><li>Close the road to lorries.</li><li>Look at the pillars from a boat.</li></ol>{P(C)}</article>{FOOT}</body>",
     ["Steps", A, "Close the road to lorries.", "Look at the pillars from a boat.", C]),
    (f"<body>{NAV}<article><h1>Table</h1>{P(A)}<table><tr><th>Year</th><th>Cars</th></tr><tr><td>1990</td><td>4100</td></tr></table>{P(B)}</article></body>",
     ["Table", A, "Year", "Cars", "1990", "4100", B]),
    (f"<body>{NAV}<article><h1>One &amp; two</h1><p><b>{A}\n  {B}<br>{C}</b></p></article>{FOOT}</body>", ["One & two", f"{A} {B} {C}"]),
    (f"<body>{MENU}<main><article><h1>Old bridge</h1>{P(A, B)}</article></main>{FOOT}</body>", ["Old bridge", A, B]),
    (f"<body>{NAV}<div class='article-body'>{P(A, B, C)}</div><div id='comments'><h3>3 comments</h3><p>I live there and have not seen anyone.</p></div></body>", [A, B, C]),
    (f"<body><header><a href='/'>The River Gazette</a><p>News since 1890</p></header><article><h1>Old bridge</h1>{P(A, B)}</article></body>", ["Old bridge", A, B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(SHORT)}</article>{FOOT}</body>", ["Old bridge", SHORT]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A)}<h2>What next</h2>{P(C)}</article>{SIDE}</body>", ["Old bridge", A, "What next", C]),
    (f"<body><div class='topbar'>Call us on 555 0101</div>{NAV}<article>{P(A, B)}</article>{FOOT}</body>", [A, B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A)}<div class='share'><a href='/t'>Tweet</a> <a href='/f'>Like</a></div>{P(B)}</article></body>", ["Old bridge", A, B]),
    (f"<body>{NAV}<article><h1>Old bridge</h1>{P(A, B)}<div class='newsletter'><p>Get our letter every Friday.</p><input><button>Join</button></div></article>{FOOT}</body>", ["Old bridge", A, B]),
    (f"<body>{NAV}<article><h1>Code</h1>{P(A)}<pre>bridge = open(river)\nbridge.close()</pre></article>{FOOT}</body>", ["Code", A, "bridge = open(river) bridge.close()"]),
    (f"<body><h1>Old bridge</h1>{P(A, B, C)}{FOOT}</body>", ["Old bridge", A, B, C]),
    (P(A, B, C), [A, B, C]),
    (f"<body>{NAV}<article><h1>Old bridge</h1><figure><img src=b.png><figcaption>The bridge in 1950</figcaption></figure>{P(A, B)}</article></body>", ["Old bridge", "The bridge in 1950", A, B]),
    (f"<body>{NAV}<div class='shell'><div class='pane'><div class='inner2'><h1>Old bridge</h1>{P(A, B, C)}</div></div>{SIDE}</div>{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body>{NAV}<article><p>{A}<p>{B}<p>{C}</article>{AD}{FOOT}</body>", [A, B, C]),
    (f"<body>{NAV}<section><h1>Old bridge</h1>{P(A, B, C)}</section>{SIDE}{COOKIE}{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body>{MENU}<article><h1>Old bridge</h1>{P(A)}<p class='ad'>Lamps, two for one, this week only.</p>{P(B, C)}</article>{FOOT}</body>", ["Old bridge", A, B, C]),
    (f"<body><nav class='breadcrumb'><a href='/'>Home</a> <a href='/n'>News</a></nav><article><h1>Old bridge</h1>{P(A, B)}<footer><p>Written by a reporter</p></footer></article></body>", ["Old bridge", A, B]),
]


@pytest.fixture(scope="module", params=["layouts", "table"])
def model(request, spark):
    """Trained on the layouts alone, and as the query trains on a table."""
    if request.param == "layouts":
        return H.fit(*H._examples(H.labelled_layouts()))
    return H.train(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_page(model, number):
    source, blocks = PAGES[number]
    assert model.extract(source) == "\n".join(blocks)


@pytest.mark.parametrize("tag", ["svg", "textarea", "math", "object", "template"])
def test_unclosed_tags_cost_linear_time(tag):
    took = []
    for n in (4_000, 32_000):
        t = time.time()
        page = Page(f"<p>x</p><{tag}> y " * n)
        took.append(time.time() - t)
        assert len(page.nodes) == n + 1
    assert took[1] < 30 * max(took[0], 0.02)


def test_table_pages_equal_what_their_article_marks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = H.train(pages)
    same = []
    for r in pages.select("html").limit(200).collect():
        found = H.self_labelled(r.html)
        if found is not None:
            page, label = found
            same.append(model.extract(r.html) == page.blocks(label))
    assert len(same) > 50 and np.mean(same) > 0.99
