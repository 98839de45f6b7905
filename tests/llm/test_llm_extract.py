import html
import re

from .llm_helpers import SF

from settleline.llm import extract as X

MODEL = X.trained_model()


def text(page):
    return X.main_text(page, MODEL)


def test_held_out_layout_fillings():
    wrong = total = 0
    for page in X.labelled_pages(seed=77, copies=6):
        p, _ = MODEL.marginals(page)
        for i, n in enumerate(page.nodes):
            if page.texts[i]:
                total += 1
                wrong += (p[i] >= 0.5) != n.label
    assert total > 1000 and wrong <= 0.01 * total


def test_sum_product_against_enumeration():
    import itertools
    import math

    import numpy as np
    rng = np.random.default_rng(3)
    page = X.featurize(X.parse("<div><p>one two</p><ul><li>three</li></ul></div><p>four"))
    model = X.TreeModel(rng.normal(size=X.N_FEATURES), rng.normal(size=(2, 2, 2)))
    n = len(page.nodes)
    weight = {}
    for y in itertools.product((0, 1), repeat=n):
        s = sum(model.node[k] * v for i in range(n) if y[i] for k, v in page.active[i])
        s += sum(model.edge[int(page.nodes[i].tag in X.TEXTUAL), y[page.nodes[i].parent], y[i]] for i in range(1, n))
        weight[y] = math.exp(s)
    z = sum(weight.values())
    p, joint = model.marginals(page)
    for i in range(n):
        assert abs(p[i] - sum(w for y, w in weight.items() if y[i]) / z) < 1e-9
        if i:
            up = page.nodes[i].parent
            for a in (0, 1):
                for b in (0, 1):
                    assert abs(joint[i][2 * a + b] - sum(w for y, w in weight.items() if (y[up], y[i]) == (a, b)) / z) < 1e-9


def test_the_table(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    for r in X.extract(df).join(df.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [re.sub(r"\s+", " ", b).strip() for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


LONG = "This is a sentence of the article that has a good many words in it, as paragraphs do. " * 3


def test_other_layouts():
    page = f"""<!doctype html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
    <header class="site-header"><a href="/">Site</a><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav></header>
    <div class="cookie-banner">We use cookies to make this site work better for you. <button>Accept</button></div>
    <main><article><h1>The &amp; headline</h1><p>{LONG}<p>Short one.<div class="ad">Buy this now</div><ul><li>first point of the list</li><li>second &eacute;</li></ul>
    <blockquote>A quotation that somebody said.</blockquote><p>Last <b>bold</b> and <a href="x">linked</a> words<br>here.</p></article>
    <section id="comments"><h2>Comments</h2><div class="comment"><p>I disagree with all of that, and I will say why at some length here.</p></div></section></main>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></aside>
    <form action="/s"><label>Search</label><input name=q><p>Type a word</p></form>
    <footer><p>Copyright somebody, all rights reserved, do not copy.</p></footer></body></html>"""
    got = text(page)
    for want in ("The & headline", LONG.strip(), "Short one.", "first point of the list", "second é", "A quotation that somebody said.",
                 "Last bold and linked words here."):
        assert want in got.split("\n\n"), want
    for no in ("cookies", "Buy this", "disagree", "Related", "Search", "Copyright", "Site", "document.write", "Accept"):
        assert no not in got, no


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text of some length, to be read by all who can" + "</div>" * 3000
    rows = [(1, "u", None), (2, "u", ""), (3, None, "just plain text, no markup at all, but a few words"), (None, "u", "<p>paragraph"), (5, "u", "<<<>>&&amp;<p <b"),
            (6, "u", "<article>" + "<p>word word word word word word word word word word word word word word word word</p>" * 20000 + "</article>"), (7, "u", deep),
            (8, "u", "<script>never closed"), (8, "u", "<script>never closed")]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()}
    assert got[1] == got[2] == got[8] == "" and got[3].startswith("just plain text") and got[None] == "paragraph"
    assert got[6].count("\n\n") == 19999 and "deep text" in got[7]
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_training_is_repeatable():
    again = X.train(X.labelled_pages())
    assert (again.node == MODEL.node).all() and (again.edge == MODEL.edge).all()


def test_unclosed_controls_and_heads_end():
    for tag in ("button", "label", "select", "svg"):
        got = text(f"<article><p>{LONG}</p><p>First {LONG}<{tag}>Share</p><p>After {LONG}</p><h2>A heading of the rest</h2><p>Last {LONG}</p></article>")
        assert "After" in got and "Last" in got and "A heading of the rest" in got and "Share" not in got, tag
        got = text(f"<article><p>{LONG}</p><{tag}>Share<p>After {LONG}</p><p>Last {LONG}</p></article>")
        assert "After" in got and "Last" in got and "Share" not in got, tag
    got = text(f"<html><head><title>T</title><meta charset=utf-8><body><article><p>{LONG}</p><p>Last {LONG}</p></article></body></html>")
    assert got == f"{LONG.strip()}\n\nLast {LONG.strip()}"
    got = text(f"<article><p>{LONG}</p><button><div>Click</div><span>me</span></button><p>Last {LONG}</p></article>")
    assert "Click" not in got and "me" not in got.split() and "Last" in got
    assert "no" not in text(f"<article><p>{LONG}</p><script>'<p>no</p>'</script></article>").split()


def test_formulas_and_noscript():
    got = text(f"<article><p>{LONG}</p><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>\\a=2</annotation></math> holds. {LONG}</p></article>")
    assert "So a=2 holds." in got
    got = text(f"<article><p>{LONG}</p><noscript><p>Kept {LONG}</p></noscript><p>Last {LONG}</p></article><noscript>Please enable scripts.</noscript>")
    assert "Last" in got and "Please enable" not in got


def test_parsing_takes_linear_time():
    import time

    def seconds(n):
        page = "<article>" + "<p><i>" * n + "</b>" * n + "<p>" * n + "</i>" * n
        t = time.process_time()
        X.parse(page)
        return time.process_time() - t

    seconds(1000)
    assert seconds(16_000) < 10 * max(0.02, seconds(4_000))


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{LONG}</p></article>", "x", 3, 4)], "page_id long, url string, html string, text string, n_chars int, nodes int")
    assert X.extract(df).collect() == X.extract(df.select("page_id", "url", "html")).collect()
