"""Main-text extraction with a tree-structured graphical model over the DOM.

Every block element of a page is a variable with two states, boilerplate and
content.  Node potentials are log-linear in features of the element (tag, class
and role words, text and link lengths); edge potentials tie parent and child.
The graph is a tree, so sum-product is exact: one pass of messages upward, one
downward, and each node has its marginal.  Text of nodes whose marginal of
content is at least one half is the main text.

Weights are learnt by conditional likelihood (the gradient is observed minus
expected features, and the expectations come from the same sum-product) from
labelled pages: layouts in ``LAYOUTS``, and ones put together from parts, whose
elements are marked, filled with text of random lengths.  Texts themselves are no features, so the model is
the same for every language and corpus.

Blocks: inline elements and ``br`` belong to the block around them.  White space
inside a block becomes one space, empty blocks go, blocks are joined by two
newlines.  Scripts, styles, form controls and embedded objects are never text; an
unclosed control or head ends with its parent or where the next paragraph, heading,
list, table or section starts.  Formulas are inline text, ``noscript`` is a block
like others that leans to being a notice.

Defined results: null or empty html gives the empty string; text outside of any
element belongs to the body; equal rows get equal results; rows with a null
page_id or url are extracted like others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require_columns

# Element names of HTML and words that sites use in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head template svg canvas object audio video iframe button select textarea "
                   "datalist option optgroup label legend title map annotation annotation-xml".split())
#: Silent elements without end tag that the start of a paragraph, heading, list, table or section ends.
UNCLOSED = frozenset("head svg button select datalist option optgroup label legend map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr output q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup "
                   "msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
CLOSED_BY_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                     "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
BREAKS = CLOSES_P - frozenset("div details dialog dir center".split()) | {"body", "noscript"}
SCOPES = frozenset("table ul ol dl body html".split())
TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 ul ol li nav header footer aside table tr td th blockquote pre figure "
        "figcaption dl dt dd form body address details").split()
WORD_GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pager pagination toc tabs skip",
    "head": "header masthead banner topbar logo branding head",
    "foot": "footer foot copyright legal contentinfo colophon imprint",
    "side": "sidebar side aside rail widget widgets complementary related recommended recommendations trending popular more teaser",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner-ad dfp",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe subscription signup paywall "
              "toast privacy message warning",
    "reader": "comment comments reply replies respond response discussion disqus feedback reviews",
    "share": "share sharing social tags tagged meta byline author-box rating",
    "form": "form search login searchbox search-form",
    "main": "article post entry content story main body text page-content maincontent articlebody prose",
}
GROUP_OF = {w: g for g, words in WORD_GROUPS.items() for w in words.split()}
TAG_AT = {t: i for i, t in enumerate(TAGS)}
GROUP_AT = {g: len(TAGS) + i for i, g in enumerate(WORD_GROUPS)}
N_SHAPE = 11
SHAPE_AT = len(TAGS) + len(WORD_GROUPS)
N_FEATURES = SHAPE_AT + N_SHAPE
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol blockquote pre td th tr table dt dd dl figure figcaption details".split())
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    runs: list[tuple[int, list[str]]] = field(default_factory=list)  # (position on the page, pieces of text)
    links: int = 0  # characters inside of links
    label: int | None = None


class TreeBuilder(HTMLParser):
    """Block elements of a page in page order; inline elements melt into them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("body", -1)]
        self.open: list[tuple[str, int]] = [("html", 0)]  # element, the block it is in
        self.where: dict[str, list[int]] = {}  # by name, places in ``open`` (the first left out)
        self.silent = 0
        self.link = 0
        self.clock = 0

    def at(self) -> int:
        return self.open[-1][1]

    def push(self, tag: str, block: int) -> None:
        self.where.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, block))

    def cut(self, place: int) -> None:
        """Close all open elements from a place on."""
        for gone, _ in reversed(self.open[place:]):
            self.where[gone].pop()
            self.link -= gone == "a"
            self.silent -= gone in SILENT and self.silent > 0
            self.clock += gone not in INLINE and gone not in SILENT
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self.add(" ")
            if tag == "hr":
                self.clock += 1
            return
        if self.silent and tag in BREAKS:
            silent = [(places[0], name) for name, places in self.where.items() if places and name in SILENT]
            if all(name in UNCLOSED for _, name in silent):
                self.cut(min(silent)[0])
        if self.silent:
            if tag in SILENT:
                self.push(tag, self.at())
                self.silent += 1
            return
        if tag in SILENT:
            self.push(tag, self.at())
            self.silent = 1
            return
        if tag in ("html", "body"):
            if tag == "body":
                self.describe(self.nodes[0], attrs)
            return
        if tag in CLOSES_P:
            self.close("p", SCOPES | {"div", "article", "section", "li", "td", "th", "blockquote"})
        for sibling in CLOSED_BY_SIBLING.get(tag, ()):
            self.close(sibling, SCOPES)
        if tag in INLINE:
            self.push(tag, self.at())
            self.link += tag == "a"
            return
        self.clock += 1
        node = Node(tag, self.at())
        self.describe(node, attrs)
        if tag == "noscript":  # shown to readers without scripts: a notice as a rule, if not always
            node.hints = tuple(sorted({*node.hints, "notice"}))
        self.nodes.append(node)
        self.push(tag, len(self.nodes) - 1)

    @staticmethod
    def describe(node: Node, attrs: list[tuple[str, str | None]]) -> None:
        groups = set()
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                low = value.lower()
                groups.update(GROUP_OF[w] for w in (*low.split(), *WORDS.findall(low)) if w in GROUP_OF)
            elif name == "data-y" and value:
                node.label = int(value)
        node.hints = tuple(sorted(groups))

    def close(self, tag: str, stop: frozenset[str]) -> None:
        """Close the innermost open ``tag``, unless an element of ``stop`` is in between."""
        places = self.where.get(tag)
        if places and not any(self.where.get(s) and self.where[s][-1] > places[-1] for s in stop if s != tag):
            self.cut(places[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.add(" ")
        if tag not in VOID and tag not in ("html", "body"):
            self.close(tag, frozenset() if tag not in INLINE else frozenset(TAGS))

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.add(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA[") and not self.silent:
            self.add(unescape(data[6:]))

    def add(self, text: str) -> None:
        if self.silent:
            return
        node = self.nodes[self.at()]
        if not node.runs or node.runs[-1][0] != self.clock:
            node.runs.append((self.clock, []))
        node.runs[-1][1].append(text)
        if self.link:
            node.links += len(text)


def parse(html: str | None) -> list[Node]:
    builder = TreeBuilder()
    builder.feed(html or "")
    HTMLParser.close(builder)
    return builder.nodes


def run_text(pieces: list[str]) -> str:
    return SPACE.sub(" ", "".join(pieces)).strip()


@dataclass
class Page:
    nodes: list[Node]
    texts: list[list[tuple[int, str]]]
    active: list[list[tuple[int, float]]]  # sparse features


def featurize(nodes: list[Node]) -> Page:
    texts = [[(at, t) for at, pieces in n.runs if (t := run_text(pieces))] for n in nodes]
    own = [sum(len(t) for _, t in ts) for ts in texts]
    below, linked, paragraphs = own[:], [min(n.links, o) for n, o in zip(nodes, own)], [float(n.tag == "p" and o > 60) for n, o in zip(nodes, own)]
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        below[up] += below[i]
        linked[up] += linked[i]
        paragraphs[up] += paragraphs[i]
    whole = max(1, below[0])
    active = []
    for i, n in enumerate(nodes):
        f = [(TAG_AT[n.tag], 1.0)] if n.tag in TAG_AT else []
        f += [(GROUP_AT[g], 1.0) for g in n.hints]
        dense = linked[i] / below[i] if below[i] else 0.0
        shape = (1.0, min(1.0, math.log1p(own[i]) / 7), float(own[i] > 120), float(0 < own[i] <= 25),
                 min(1.0, n.links / own[i]) if own[i] else 0.0, dense, below[i] / whole, float(paragraphs[i] >= 1),
                 float(paragraphs[i] >= 2), float(below[i] == 0), float(len(nodes) == 1))
        f += [(SHAPE_AT + k, v) for k, v in enumerate(shape) if v]
        active.append(f)
    return Page(nodes, texts, active)


@dataclass
class TreeModel:
    """``node``: score of content by feature.  ``edge``: score by (textual child, parent state, child state)."""

    node: np.ndarray
    edge: np.ndarray

    def marginals(self, page: Page) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """P(content) of each node, and each node's joint with its parent as P(parent, child) for 00, 01, 10, 11."""
        nodes, w = page.nodes, self.node.tolist()
        factors = [[math.exp(x) for x in row] for row in self.edge.reshape(2, 4).tolist()]
        n = len(nodes)
        # potentials as probabilities, normalised at every step, so that long pages neither over- nor underflow
        b0, b1 = [0.0] * n, [0.0] * n
        for i, f in enumerate(page.active):
            s = max(-30.0, min(30.0, sum(w[k] * v for k, v in f)))
            b1[i] = 1 / (1 + math.exp(-s))
            b0[i] = 1 - b1[i] if s < 20 else math.exp(-s)
        up = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):  # children come after their parents
            e = factors[nodes[i].tag in TEXTUAL]
            m0, m1 = e[0] * b0[i] + e[1] * b1[i], e[2] * b0[i] + e[3] * b1[i]
            t = m0 + m1
            up[i] = m0, m1 = m0 / t, m1 / t
            p = nodes[i].parent
            x0, x1 = b0[p] * m0, b1[p] * m1
            t = x0 + x1
            b0[p], b1[p] = max(x0 / t, 1e-300), max(x1 / t, 1e-300)
        out = [0.0] * n
        joint = [(0.0, 0.0, 0.0, 0.0)] * n
        out[0] = b1[0] / (b0[0] + b1[0])
        for i in range(1, n):
            p, e = nodes[i].parent, factors[nodes[i].tag in TEXTUAL]
            m0, m1 = up[i]
            d0, d1 = (1 - out[p]) / max(m0, 1e-300), out[p] / max(m1, 1e-300)  # the parent without this child
            j = (d0 * e[0] * b0[i], d0 * e[1] * b1[i], d1 * e[2] * b0[i], d1 * e[3] * b1[i])
            t = sum(j) or 1.0
            joint[i] = tuple(x / t for x in j)
            out[i] = joint[i][1] + joint[i][3]
        return out, joint


def train(pages: list[Page], epochs: int = 120, rate: float = 0.15, decay: float = 2e-3) -> TreeModel:
    """Conditional likelihood by Adam over all pages; every node carries a label."""
    model = TreeModel(np.zeros(N_FEATURES), np.zeros((2, 2, 2)))
    params = [model.node, model.edge]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1):
        g_node, g_edge = -decay * model.node * len(pages), -decay * model.edge * len(pages)
        for page in pages:
            p, joint = model.marginals(page)
            for i, n in enumerate(page.nodes):
                for k, v in page.active[i]:
                    g_node[k] += v * (n.label - p[i])
                if i:
                    e = g_edge[int(n.tag in TEXTUAL)]
                    e -= np.reshape(joint[i], (2, 2))
                    e[page.nodes[n.parent].label, n.label] += 1
        for x, g, m, v in zip(params, (g_node, g_edge), first, second):
            g = g / len(pages)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


# Labelled layouts: an element's mark holds for what it contains, up to the next mark.  T is a text of a paragraph's
# length, S of a few words, L a link; P stands for several paragraphs, M for a list of links.
LAYOUTS = (
    '<body data-y=0><nav><ul>M</ul></nav><div class="ad">S</div><article data-y=1><h1>S</h1>P<p>S</p></article><footer>S</footer>',
    '<body data-y=0><header><h1>S</h1><nav>M</nav></header><main data-y=1><article><h1>S</h1>P<h2>S</h2>P<ul><li>T</li><li>S</li></ul></article></main>'
    '<aside><h3>S</h3><ul>M</ul><p>T</p></aside><footer><p>S</p><p>T</p></footer>',
    '<body data-y=0><div id="header"><div class="logo">S</div><ul class="menu">M</ul></div><div data-y=1 id="content"><h1>S</h1>P<blockquote><p>T</p></blockquote>P</div>'
    '<div id="sidebar"><h3>S</h3><p>T</p><ul>M</ul></div><div id="footer"><p>S</p></div>',
    '<body data-y=0><div class="cookie-notice"><p>T</p><p>S</p></div><div class="wrapper" data-y=1><div class="post"><h1>S</h1><div class="entry">P<p>S</p><p>T</p></div></div>'
    '<div class="comments" data-y=0><h3>S</h3><div class="comment"><p>T</p></div><div class="comment"><p>S</p><p>T</p></div></div></div>',
    '<body data-y=0><div class="banner">S</div><div class="nav">M</div><section data-y=1 class="story"><h2>S</h2>P<figure><figcaption>S</figcaption></figure>P</section>'
    '<section class="related"><h3>S</h3><ul>M</ul></section><section id="comments"><p>T</p><p>T</p></section><footer>T</footer>',
    '<body data-y=1><h1>S</h1>P<p>S</p>',
    '<body data-y=1>T<p>S</p>P',
    '<body data-y=1>T',
    '<body data-y=1>S',
    '<body data-y=1><p>S</p>',
    '<body data-y=1><p>S</p><p>T</p>',
    '<body data-y=0><div class="topbar"><p>S</p></div><div class="page" data-y=1><div class="main"><h1>S</h1><table><tr><td>T</td><td>S</td></tr><tr><td>S</td><td>T</td></tr></table>P</div>'
    '<div class="widget" data-y=0><p>T</p><p>S</p></div></div><div class="legal"><p>T</p></div>',
    '<body data-y=0><header><p>S</p></header><form><p>S</p><p>S</p></form><article data-y=1><header><h1>S</h1></header>P<div class="ad" data-y=0><p>S</p></div>P'
    '<aside data-y=0><p>T</p></aside><div class="share" data-y=0><ul>M</ul></div>P<footer data-y=0><p>S</p></footer></article><div class="newsletter"><p>T</p></div>',
    '<body data-y=0><div role="navigation"><ul>M</ul></div><div role="main" data-y=1>P<ol><li>T</li><li>T</li></ol><pre>T</pre>P</div><div role="complementary"><p>T</p></div>'
    '<div role="contentinfo"><p>T</p></div>',
    '<body data-y=0><nav class="breadcrumb">M</nav><article data-y=1><h1>S</h1><p>T</p></article><section class="comments"><article class="comment"><p>T</p></article>'
    '<article class="comment"><p>T</p><p>S</p></article></section><div class="alert"><p>T</p></div><footer>S</footer>',
    '<body data-y=0><div class="sponsored"><p>T</p></div><div data-y=1><h1>S</h1>P</div><div class="footer">M</div>',
    '<body data-y=0><ul class="nav">M</ul><article data-y=1><p>S</p><p>S</p><p>S</p><p>S</p></article><footer>S</footer>',
    '<body data-y=0><nav>M</nav><article data-y=1><p>T</p><div><p>T</p><p>S</p></div><section><h2>S</h2>P</section></article><aside class="sidebar"><div><h4>S</h4><ul>M</ul></div></aside>'
    '<div class="consent"><div><p>T</p></div></div><footer><div><ul>M</ul></div><div>T</div></footer>',
)

# Parts that pages are put together from: what is not content, what is, and what is around the content.
AROUND = (
    '<nav><ul>M</ul></nav>', '<div class="menu">M</div>', '<ul class="breadcrumbs">M</ul>', '<header><div class="logo">S</div><p>S</p></header>',
    '<div id="header">S</div>', '<div class="masthead"><p>S</p></div>', '<footer><p>T</p><p>S</p></footer>', '<div class="footer"><p>T</p></div>',
    '<div class="copyright">S</div>', '<aside><h3>S</h3><p>T</p></aside>', '<div class="sidebar"><h4>S</h4><p>T</p><ul>M</ul></div>',
    '<div class="related"><h3>S</h3><ul>M</ul></div>', '<div class="cookie-banner"><p>T</p></div>', '<div class="notice"><p>S</p></div>',
    '<div class="alert">T</div>', '<div class="ad">S</div>', '<div class="advert"><p>T</p></div>', '<div class="sponsored">T</div>',
    '<form><p>S</p></form>', '<form>S</form>', '<div class="newsletter"><p>S</p><form>S</form></div>',
    '<div id="comments"><h3>S</h3><div class="comment"><p>T</p></div><div class="comment"><p>S</p></div></div>',
    '<section class="comments"><h3>S</h3><article class="comment"><p>T</p></article></section>', '<ol class="comment-list"><li>T</li><li>S</li></ol>')
INSIDE = ('P', 'P', 'P', '<p>S</p>', '<h2>S</h2>', '<h3>S</h3>', '<ul><li>T</li><li>S</li></ul>', '<ol><li>S</li><li>S</li></ol>',
          '<blockquote><p>T</p></blockquote>', '<blockquote>S</blockquote>', '<table><tr><td>S</td><td>T</td></tr></table>', '<pre>T</pre>',
          '<figure><figcaption>S</figcaption></figure>', '<div><p>T</p></div>', '<div>T</div>', '<section><h2>S</h2>P</section>')
HOLDERS = ('<article data-y=1>{}</article>', '<main data-y=1>{}</main>', '<main data-y=1><article>{}</article></main>', '<div id="content" data-y=1>{}</div>',
           '<div class="post" data-y=1><div class="entry-content">{}</div></div>', '<div data-y=1>{}</div>', '<section class="story" data-y=1>{}</section>',
           '<div class="wrapper" data-y=1><article class="post">{}</article></div>', '<div role="main" data-y=1>{}</div>')


def composed_layout(rng: random.Random) -> str:
    """A body of random parts: some before the content, some after it, and at times some within."""
    inside = ["<h1>S</h1>"] if rng.random() < 0.9 else ["P"]
    within = rng.choice((0.0, 0.0, 0.2))
    for _ in range(rng.randint(1, 8)):
        inside.append(rng.choice(INSIDE))
        if rng.random() < within:
            inside.append(marked_out(rng.choice(AROUND)))
    before = "".join(rng.choice(AROUND) for _ in range(rng.randint(0, 4)))
    after = "".join(rng.choice(AROUND) for _ in range(rng.randint(0, 4)))
    return f"<body data-y=0>{before}{rng.choice(HOLDERS).format(''.join(inside))}{after}"


def marked_out(part: str) -> str:
    """The part with the mark of what is not content on its outermost element."""
    return re.sub(r"^<(\w+)", r"<\1 data-y=0", part)


def labelled_pages(seed: int = 11, copies: int = 4, composed: int = 160) -> list[Page]:
    """Pages of every layout and of random parts, with texts of random lengths."""
    rng = random.Random(seed)

    def words(lo: int, hi: int) -> str:
        return " ".join("x" * rng.randint(2, 9) for _ in range(rng.randint(lo, hi))) + "."

    def links() -> str:
        return "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(rng.randint(2, 8)))

    def fill(layout: str) -> str:
        parts = re.split(r"(?<![A-Za-z\-\"])([PTSM])(?![A-Za-z\-\"])", layout)
        made = {"T": lambda: words(12, 120), "S": lambda: words(1, 9), "M": links,
                "P": lambda: "".join(f"<p>{words(*rng.choice([(12, 150), (12, 150), (2, 10)]))}</p>" for _ in range(rng.randint(1, 9)))}
        return "".join(made[p]() if p in made else p for p in parts)

    pages = []
    for layout in [x for x in LAYOUTS for _ in range(copies)] + [composed_layout(rng) for _ in range(composed)]:
        nodes = parse(fill(layout))
        for n in nodes:
            if n.label is None:
                n.label = nodes[n.parent].label
        pages.append(featurize(nodes))
    return pages


@lru_cache(maxsize=1)
def trained_model() -> TreeModel:
    return train(labelled_pages())


def main_text(html: str | None, model: TreeModel) -> str:
    page = featurize(parse(html))
    p, _ = model.marginals(page)
    blocks = sorted((at, t) for i, ts in enumerate(page.texts) if p[i] >= 0.5 for at, t in ts)
    return "\n\n".join(t for _, t in blocks)


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    require_columns(pages, ["page_id", "url", "html"])
    model = model or trained_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), model) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
