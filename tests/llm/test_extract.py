import html
import re
import time
from collections import Counter

import numpy as np
import pytest

from sitesift.llm import extract, gbt
from sitesift.llm.dom import Page, features
from sitesift.llm.layouts import LABEL, labelled_page


@pytest.fixture(scope="module")
def extractor():
    return extract.train()


def test_held_out_layouts(extractor):
    right = extra = missed = 0
    for i in range(200):
        page = labelled_page(9_000_000 + i)
        tree = Page(page, LABEL)
        for n in range(len(tree.tags)):
            if tree.labels[n] < 0:
                tree.labels[n] = max(tree.labels[tree.parent[n]], 0) if n else 0
        want = Counter(w for node, text in tree.blocks if tree.labels[node] == 1 for w in text.split())
        got = Counter(extractor.texts([re.sub(rf' {LABEL}="\d"', "", page)])[0].split())
        right, extra, missed = right + (want & got).total(), extra + (got - want).total(), missed + (want - got).total()
    assert right / (right + extra) > 0.95 and right / (right + missed) > 0.95


def test_given_pages(spark, extractor):
    wrong = 0
    rows = extract.extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), extractor).collect()
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
        wrong += "\n".join(b for b in blocks if b) != r["text"]
    assert wrong <= 0.02 * len(rows)


def test_parts_left_out(extractor):
    s = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. Sed do eiusmod tempor incididunt ut labore. "
    page = f"""<html><head><title>T</title><script>var a = "<p>x</p>"</script></head><body><header class="site-header"><nav class="menu"><a href=/>Home</a>
    <a href=/b>Blog</a></nav></header><div class="cookie-banner"><p>We use cookies. Accept.</p><button>OK</button></div>
    <main><div class="post-content"><h1>Title &amp;&nbsp;here</h1><p>{s}<br>{s}<p>&lt;b&gt; {s}<div class="advert"><p>Buy now! {s}</p></div><ul><li>One item</ul></div>
    <section id="comments"><h3>2 Comments</h3><div class="comment"><b>Bob</b><p>{s}</p></div></section></main>
    <form class="newsletter"><label>Email</label><input><p>Sign up.</p></form><footer>Copyright. {s}</footer></body></html>"""
    assert extractor.texts([page]) == [f"Title & here\n{s}{s}".strip() + f"\n<b> {s}".rstrip() + "\nOne item"]


def test_decoding_is_consistent_and_best():
    page = Page("<div><p>a<p>b</div><div><p>c</div>")
    r = np.random.default_rng(1)
    n = len(page.tags)
    for _ in range(50):
        odds = r.normal(size=n) * 3
        kept = extract.decode(page, odds)
        assert all(not kept[i] or kept[page.parent[i]] for i in range(1, n))
        best = max(sum(o for i, o in enumerate(odds) if m >> i & 1) for m in range(1 << n)
                   if all(not m >> i & 1 or m >> page.parent[i] & 1 for i in range(1, n)))
        assert abs(sum(o for o, k in zip(odds, kept) if k) - best) < 1e-9


def test_trees_learn():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = gbt.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((model.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


@pytest.mark.parametrize("page", ["", "text", "<", "<p", "</div></p>", "<div>" * 3000 + "deep", "<p>a<script>b", "<p>&am", "<select><option>x<p>y", "\x00<p>z"])
def test_broken_pages(extractor, page):
    assert isinstance(extractor.texts([page])[0], str)
    tree = Page(page)
    assert len(features(tree, {})) == len(tree.tags)


def test_odd_rows(spark, extractor):
    df = spark.createDataFrame([(1, None, "u"), (None, "", None), (2, "<p>Some words here.</p>", "t"), (2, "<p>Some words here.</p>", "t")], "page_id long, html string, text string")
    rows = extract.extract_text(df, extractor).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in rows) == [("1", ""), ("2", "Some words here."), ("2", "Some words here."), ("None", "")]
    assert extract.extract_text(df.limit(0), extractor).count() == 0


@pytest.mark.parametrize("tag", ["svg", "math", "canvas", "audio", "video", "object", "button", "select", "template"])
def test_text_after_skipped_elements(tag):
    texts = lambda page: [t for _, t in Page(page).blocks]
    assert texts(f"<article><p>a</p><{tag}/><p>b</p><p>c</p></article>") == ["a", "b", "c"]
    assert texts(f"<article><p>a<{tag}/>b</p><{tag}><{tag} />no</{tag}><p>c</p></article>") == ["ab", "c"]
    assert texts(f"<article><p>a</p><{tag}>no<p>b</p><p>c</p></article><p>d</p>") == ["a", "b", "c", "d"]
    assert texts(f"<article><p>a</p><{tag}>no<p>b</p><{tag}><div>no</div></{tag}><p>c</p></article>") == ["a", "b", "c"]
    assert texts(f"<div><{tag}><div>no</div><p>no</p></{tag}>a</div><{tag}>no") == ["a"]
    assert texts(f"<div><{tag}><div>no<{tag}></div>no</{tag}><p>a</p></div><p>b</p>") == ["a", "b"]


def test_stray_end_tags_take_linear_time():
    for stray in ("<b>" * 100_000 + "</i>" * 100_000, "<b>" * 50_000 + "<svg><g>" + "</i>" * 50_000, "<div>" * 20_000 + "</p>" * 20_000):
        began = time.process_time()
        Page(f"<article><p>a</p>{stray}")
        assert time.process_time() - began < 5
