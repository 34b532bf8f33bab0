"""Main-text extraction with a tree-structured graphical model over the DOM.

Every block element is a variable, content or not.  Its unary potential is
log-linear in features of the element (tag, names in class, id and role, text
and link shares); each parent-child pair has a potential of its own.  One
upward and one downward sum-product pass give the exact marginals, and the text
of elements with a marginal above one half is the main text.

Training.  The labelled pages are of two kinds: layouts whose parts are known
(``labelled_layouts``: articles in several wrappers amid menus, headers,
footers, sidebars, notices, adverts, forms and comments), and at most
``MAX_PAGES`` pages of the table itself that mark their text by one article or
main element, taken by a hash of the html; parts inside it that their tag, class or
id names as boilerplate are not its text.  Unary weights are fitted by
logistic regression, pair potentials from counted pairs.

Scale: the pages are only mapped, the driver sees the features of a bounded
sample, the broadcast is one weight vector of ``BINS`` numbers and a 2 x 2 table.

Defined results: null and empty html give empty text; text outside any tag is
a block of the root; unclosed and crossing tags are closed where a block ends;
very deep or long pages are handled without recursion or cuts; repeated rows get
equal texts.  Other columns are not read.
"""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch
from hiremart.llm.dom import Page

BINS = 1 << 12
MAX_PAGES = 200
LAYOUTS = 1200
SEED = 20

HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PROSE = frozenset(("p", "blockquote", "pre", "dd", "figcaption"))


def _level(n: int) -> int:
    return min(12, int(n).bit_length())


def features(page: Page) -> list[list[int]]:
    """Feature numbers of every node: the element, its names, its text and links, and where it stands in the page."""
    nodes = page.nodes
    text, link, parts = [n.text for n in nodes], [n.link for n in nodes], [int(n.tag == "p") for n in nodes]
    controls = [n.controls for n in nodes]
    prose = [n.text - n.link if n.tag in PROSE else 0 for n in nodes]  # text of paragraphs and the like, links aside
    for n in reversed(nodes[1:]):
        text[n.parent] += text[n.number]
        link[n.parent] += link[n.number]
        parts[n.parent] += parts[n.number]
        controls[n.parent] += controls[n.number]
        prose[n.parent] += prose[n.number]
    out = []
    depth = [0] * len(nodes)
    part = [False] * len(nodes)  # in an element whose tag or names say that it stands beside the text
    titled = [False] * len(nodes)  # in one that says it is the text
    share = [0] * len(nodes)  # of the page's prose, in the nearest container
    for n in nodes:
        k = n.number
        parent = nodes[n.parent] if n.parent >= 0 else None
        own = names_a_part(n.names)
        part[k] = n.tag in PAGE_PARTS or own
        titled[k] = n.tag in ("article", "main") or not TITLE_WORDS.isdisjoint(n.names)
        share[k] = int(4 * prose[k] / prose[0]) if prose[0] else 0
        if parent is not None:
            depth[k] = depth[n.parent] + 1
            part[k] = part[k] or part[n.parent]
            titled[k] = titled[k] or titled[n.parent]
            if n.tag in PROSE or n.tag in HEADINGS or n.tag in ("li", "ul", "ol", "tr", "td", "th"):
                share[k] = share[n.parent]
        links = link[k] / text[k] if text[k] else 0
        place = f"{int(part[k])}{int(titled[k])}"
        found = [f"t={n.tag}", f"l={_level(text[k])}", f"a={int(links * 5)}", f"p={min(4, parts[k])}", f"c={min(2, controls[k])}", f"d={min(6, depth[k])}", "bias",
                 f"in={place}", f"t,in={n.tag},{place}", f"share={share[k]}", f"in,share={place},{share[k]}", f"in,a={place},{int(links * 5)}", f"t,a,in={n.tag},{int(links * 5)},{place}", f"own={int(own)}"]
        found += [f"n={x}" for x in n.names]
        if parent is not None:
            found += [f"u={parent.tag}", *(f"m={x}" for x in parent.names)]
        out.append([zlib.crc32(x.encode()) % BINS for x in found])
    return out


class Model:
    """Unary weights and pair potentials (log, [parent][child])."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def marginals(self, page: Page) -> np.ndarray:
        """Probability of content of every node: sum-product, upward then downward."""
        nodes = page.nodes
        n = len(nodes)
        w = self.weights
        unary = np.zeros((n, 2))
        for k, found in enumerate(features(page)):
            unary[k, 1] = w[found].sum()
        table = np.exp(self.pair).tolist()
        parent = [x.parent for x in nodes]
        inside = unary.tolist()  # log potential of the subtree
        message = [(0.0, 0.0)] * n
        (a, b), (c, d) = table
        log, exp = math.log, math.exp
        for k in range(n - 1, 0, -1):
            x, y = inside[k]
            top = x if x > y else y
            x, y = exp(x - top), exp(y - top)
            message[k] = (log(a * x + b * y) + top, log(c * x + d * y) + top)
            up = inside[parent[k]]
            up[0] += message[k][0]
            up[1] += message[k][1]
        belief = inside
        for k in range(1, n):
            up, own = belief[parent[k]], message[k]
            x, y = up[0] - own[0], up[1] - own[1]
            top = x if x > y else y
            x, y = exp(x - top), exp(y - top)
            inside[k][0] += log(a * x + c * y)
            inside[k][1] += log(b * x + d * y)
        delta = np.array([v[1] - v[0] for v in belief])
        return 1 / (1 + np.exp(-np.clip(delta, -50, 50)))

    def extract(self, html: str | None) -> str:
        page = Page(html)
        if not page.runs:
            return ""
        return page.blocks(self.marginals(page) > 0.5)


# ---------------------------------------------------------------------------
# Labelled pages
# ---------------------------------------------------------------------------

#: Words for names of wrappers and of the parts around an article (fixed values).
ARTICLE_NAMES = "article content post story entry main text body post-content article-body entry-content main-content".split()
SIDE_PARTS = {
    "menu": ["nav", "div.menu", "div.navigation", "ul.menu", "div#nav", "div.navbar", "nav.breadcrumb", "div.breadcrumbs", "nav.pagination", "div.pager"],
    "header": ["header", "div.header", "div#header", "div.masthead", "div.banner", "header.site-header", "div.topbar"],
    "footer": ["footer", "div.footer", "div#footer", "div.copyright", "footer.site-footer", "div.legal"],
    "side": ["aside", "div.sidebar", "div#sidebar", "aside.related", "div.widget", "div.related", "section.recommended", "div.trending", "div.side", "aside", "aside.more", "div.popular", "section.teaser"],
    "notice": ["div.notice", "div.cookie-banner", "div.cookies", "div.consent", "div.gdpr", "div.alert", "section.notice", "div.popup", "div.modal", "div.newsletter", "div.subscribe", "p.notice", "div.disclaimer", "div.paywall", "div.message", "div.announcement", "div.privacy", "div.signup", "aside.notification"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "aside.promo", "div.promo", "section.ad", "div#ad-top", "p.ad", "div.ad-slot", "div.commercial", "div.partner", "div.adsense", "div.banner-ad", "aside.ad"],
    "form": ["form", "form.search", "div.search", "form.login", "form.newsletter", "div.form"],
    "comments": ["section.comments", "div.comments", "div#comments", "ol.comment-list", "section.responses", "div.discussion", "div.reader-comments", "div.replies", "div.feedback", "section.responses", "div.thread", "div.reactions", "ul.opinions", "div.user-reviews", "div#respond"],
    "share": ["div.share", "ul.social", "div.tags", "div.author-bio", "div.byline-links"],
}
SYLLABLES = "an er the st on re ti in or le ka mo ra li ne so da vi pa lu".split()


class _Layouts:
    """Random pages with known parts; boilerplate elements carry a mark in ``data-x``."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        found = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
        return " ".join(found).capitalize() + r.choice([".", ".", "!", "?"])

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.words(1, 3)}</a></li>' for k in range(n))

    def paragraphs(self, low: int, high: int) -> str:
        r = self.random
        out = []
        for _ in range(r.randint(low, high)):
            size = r.choice([(1, 4), (5, 30), (20, 120)])
            body = self.words(*size)
            linked = r.random()
            if linked < 0.15:
                body += f' <a href="/x">{self.words(1, 3)}</a> {self.words(3, 9)}'
            elif linked < 0.25:  # prose that is mostly a link
                body = r.choice([f'{self.words(1, 2)[:-1]} <a href="/x">{self.words(3, 9)[:-1]}</a>.', f'<a href="/x">{self.words(3, 12)}</a>', f'{self.words(2, 5)} <a href="/y">{self.words(4, 9)}</a>'])
            kind = r.random()
            if 0.12 <= kind < 0.17:  # a list of links, or a table, that belongs to the text
                out.append(r.choice([
                    f"<ul>{self.links(r.randint(2, 6))}</ul>", "<ol>" + "".join(f'<li><a href="/{k}">{self.words(2, 6)}</a> {self.words(2, 9)}</li>' for k in range(3)) + "</ol>",
                    f"<table><tr><th>{self.words(1, 2)}</th><th>{self.words(1, 2)}</th></tr><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>",
                    f"<pre>{self.words(4, 20)}</pre>", f"<figure><img src=x><figcaption>{self.words(2, 9)}</figcaption></figure>", f"<dl><dt>{self.words(1, 2)}</dt><dd>{self.words(3, 12)}</dd></dl>",
                ]))
                continue
            kind = kind if kind < 0.12 else kind - 0.05
            out.append(
                f"<h2>{self.words(2, 6)}</h2>" if kind < 0.08 else f"<ul><li>{self.words(3, 9)}</li><li>{self.words(3, 9)}</li></ul>" if kind < 0.12
                else f"<blockquote><p>{body}</p></blockquote>" if kind < 0.15 else f"<p><b>{body}<br>" if kind < 0.25 else f"<p>{body}</p>"
            )
        return "".join(out)

    def part(self, kind: str) -> str:
        r = self.random
        tag, mark, name = r.choice(SIDE_PARTS[kind]).replace("#", ".#").partition(".")
        name = name.lstrip(".")
        attribute = "" if not mark else f' id="{name[1:]}"' if name.startswith("#") else f' class="{name}"'
        if kind == "menu":
            inner = self.links(r.randint(2, 8)) if tag in ("ul", "ol") else f"<ul>{self.links(r.randint(2, 8))}</ul>"
        elif kind == "header":
            inner = f'<a href="/">{self.words(1, 3)}</a><p>{self.words(2, 6)}</p>' + (f"<nav><ul>{self.links(4)}</ul></nav>" if r.random() < 0.5 else "")
        elif kind == "footer":
            inner = r.choice([f"&copy; {self.words(2, 9)}", f"<p>&copy; {self.words(2, 9)}</p><ul>{self.links(3)}</ul>"])
        elif kind == "side":
            inner = f"<h3>{self.words(1, 3)}</h3>" + r.choice([f"<ul>{self.links(5)}</ul>", f"<p>{self.words(8, 25)}</p>"])
        elif kind in ("notice", "advert"):
            inner = self.words(4, 25) if tag == "p" or r.random() < 0.6 else f"<p>{self.words(4, 25)}</p>" + ("<button>Ok</button>" if r.random() < 0.4 else "")
        elif kind == "form":
            inner = f'<label>{self.words(1, 4)}</label><input name="q"><p>{self.words(2, 9)}</p><button>{self.words(1, 2)}</button>'
        elif kind == "comments":
            one = "li" if tag == "ol" else "div"
            inner = "".join(f'<{one} class="comment"><p>{self.words(5, 50)}</p></{one}>' for _ in range(r.randint(1, 5)))
            inner = f"<h3>{self.words(1, 3)}</h3>{inner}" if tag != "ol" and r.random() < 0.6 else inner
        else:
            inner = f"<ul>{self.links(4)}</ul>" if tag == "div" else self.links(4)
        return f'<{tag}{attribute} role="boilerplatemark">{inner}</{tag}>'

    def page(self) -> tuple[str, bool]:
        """A page, and whether its root is the content (text without any wrapper)."""
        r = self.random
        if r.random() < 0.15:
            kinds = r.sample(list(SIDE_PARTS), r.randint(0, 3))
            whole = "".join([*(self.part(k) for k in kinds[:1]), f"<h1>{self.words(2, 9)}</h1>" if r.random() < 0.5 else "",
                             self.words(3, 30) if r.random() < 0.3 else "", self.paragraphs(0 if not kinds else 2, 12), *(self.part(k) for k in kinds[1:])])
            return (whole, True) if r.random() < 0.5 else (f'<html><body itemprop="contentmark">{whole}</body></html>', False)
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section"])
        name = r.choice(ARTICLE_NAMES) if r.random() < 0.6 else r.choice(["wrap", "col", "inner", "box", "left", "center", "".join(r.choices(SYLLABLES, k=3))])
        attribute = f' {r.choice(["class", "id"])}="{name}"' if tag in ("div", "section") or r.random() < 0.3 else ""
        inner = f"<h1>{self.words(2, 9)}</h1>" + self.paragraphs(1, 12)
        for kind in ("advert", "side", "share", "notice", "form", "comments", "footer", "header"):
            if r.random() < 0.15:
                inner += self.part(kind) + self.paragraphs(0, 3)
        body = f'<{tag}{attribute} itemprop="contentmark">{inner}</{tag}>'
        if r.random() < 0.25:
            body = f"<main>{body}</main>" if tag == "article" else f"<div>{body}</div>"
        kinds = list(SIDE_PARTS)
        before = [self.part(k) for k in r.sample(kinds, r.randint(0, 4))]
        after = [self.part(k) for k in r.sample(kinds, r.randint(0, 4))]
        whole = "".join([*before, body, *after])
        if r.random() < 0.4:
            whole = f'<div class="{r.choice(["page", "wrapper", "container"])}">{whole}</div>'
        return f"<html><body>{whole}</body></html>", False


def labelled_layouts(n: int = LAYOUTS, seed: int = SEED) -> list[tuple[Page, np.ndarray]]:
    """Pages with the label of every node; the marks are taken out of the names."""
    make = _Layouts(seed)
    out = []
    for _ in range(n):
        source, bare = make.page()
        page = Page(source)
        label = np.zeros(len(page.nodes), bool)
        for node in page.nodes:
            inherited = bool(label[node.parent]) if node.parent >= 0 else bare
            label[node.number] = (inherited or "contentmark" in node.names) and "boilerplatemark" not in node.names
            node.names = tuple(x for x in node.names if x not in ("contentmark", "boilerplatemark"))
        out.append((page, label))
    return out


PAGE_PARTS = frozenset("nav aside footer header form menu dialog".split())
#: Words of the names in ``SIDE_PARTS``, by kind, and of one comment.
PART_WORDS = {
    kind: {tuple(name.split("-")) for x in listed if (name := x.replace("#", ".").partition(".")[2])} for kind, listed in SIDE_PARTS.items()
}
PART_WORDS["comments"].add(("comment",))
TITLE_WORDS = frozenset(w for x in ARTICLE_NAMES for w in x.split("-"))


#: First word of a part's name -> (kind, all its words).
PART_NAMES: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
for _kind, _listed in PART_WORDS.items():
    for _words in _listed:
        PART_NAMES.setdefault(_words[0], []).append((_kind, _words))


def names_a_part(names: tuple[str, ...]) -> bool:
    """Whether class, id or role name a part around the text; a header that is named for the article holds its title."""
    for k, first in enumerate(names):
        for kind, words in PART_NAMES.get(first, ()):
            if names[k : k + len(words)] == words and (kind != "header" or TITLE_WORDS.isdisjoint(names)):
                return True
    return False


def self_labelled(html: str | None) -> tuple[Page, np.ndarray] | None:
    """A page that marks its text by exactly one article, or else one main element; None for others."""
    page = Page(html)
    for wanted in ("article", "main"):
        found = [n.number for n in page.nodes if n.tag == wanted]
        if len(found) == 1:
            break
    else:
        return None
    label = np.zeros(len(page.nodes), bool)
    label[found[0]] = True
    for node in page.nodes[found[0] + 1 :]:
        label[node.number] = bool(label[node.parent]) and node.tag not in PAGE_PARTS and not names_a_part(node.names)
    return page, label


def _examples(pages: list[tuple[Page, np.ndarray]]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Features and labels of all nodes, and counts of (parent, child) labels."""
    rows: list[list[int]] = []
    labels, pairs = [], np.zeros((2, 2))
    for page, label in pages:
        rows += features(page)
        labels.append(label)
        for node in page.nodes[1:]:
            pairs[int(label[node.parent]), int(label[node.number])] += 1
    return rows, np.concatenate(labels) if labels else np.zeros(0, bool), pairs


def fit(rows: list[list[int]], labels: np.ndarray, pairs: np.ndarray, *, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Logistic regression for the unary weights (Adam), smoothed counts for the pair potentials.

    The pair table is P(child | parent) over P(child), so that it adds to
    the unary evidence only what the parent's label tells."""
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    column = np.concatenate([np.array(x) for x in rows])
    y = labels.astype(float)
    w, m, v = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[column], len(rows))
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        g = np.bincount(column, slope[row], BINS) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    joint = pairs + 1.0
    given = joint / joint.sum(1, keepdims=True)
    return Model(w, np.log(given / (joint.sum(0) / joint.sum())))


def train(pages: DataFrame, *, html: str = "html", max_pages: int = MAX_PAGES, layouts: int = LAYOUTS) -> Model:
    """Model from labelled layouts and a bounded sample of pages that mark their own text."""
    source = pages.select(F.col(html).cast("string").alias("html")).where(F.col("html").isNotNull())
    total = source.count()
    share = 4 * max_pages / max(1, total)
    drawn = source.where(F.pmod(F.xxhash64("html"), F.lit(1_000_003)) < int(min(1.0, share) * 1_000_003) + 1)
    schema = "rows array<array<int>>, labels array<boolean>, pairs array<double>"

    def examples(batches):
        for batch in batches:
            marked = [x for t in batch.column(0).to_pylist() if (x := self_labelled(t)) is not None]
            found = [_examples([x]) for x in marked]
            yield record_batch({
                "rows": ([f[0] for f in found], pa.list_(pa.list_(pa.int32()))), "labels": ([f[1].tolist() for f in found], pa.list_(pa.bool_())),
                "pairs": ([f[2].ravel().tolist() for f in found], pa.list_(pa.float64())),
            })

    rows, labels, pairs = _examples(labelled_layouts(layouts))
    for r in drawn.mapInArrow(examples, schema).limit(max_pages).collect():
        rows += r["rows"]
        labels = np.concatenate((labels, np.array(r["labels"], bool)))
        pairs = pairs + np.array(r["pairs"]).reshape(2, 2)
    return fit(rows, labels, pairs)


def extract(pages: DataFrame, model: Model, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = [shared.value.extract(t) for t in batch.column(2).to_pylist()]
            yield record_batch({
                "page_id": (batch.column(0), None), "url": (batch.column(1), None),
                "text": (texts, pa.string()), "n_chars": ([len(t) for t in texts], pa.int64()),
            })

    source = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return source.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")


def main_text(pages: DataFrame) -> DataFrame:
    """The contract's columns, one row per page."""
    return extract(pages, train(pages))
