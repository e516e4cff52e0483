import html
import random
import re

import numpy as np
import pytest

from screenmeld.llm import extraction as X
from screenmeld.llm.queries import QUERIES

WEIGHTS = np.zeros(X.N_FEATURES)


def energy(cost, edges, label):
    return sum(max(c, 0) if not side else max(-c, 0) for c, side in zip(cost, label)) + sum(
        w for a, b, w in edges if label[a] != label[b])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    cost = [rng.uniform(-2, 2) for _ in range(n)]
    edges = [(a, b, rng.random()) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
    best = min(energy(cost, edges, [bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
    assert energy(cost, edges, X.minimum_cut(cost, edges)) == pytest.approx(best)


def test_a_layout_with_every_kind_of_boilerplate():
    page = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="sidebar"><p>Side, thing.</p></div>
    <div class="cookie-notice">We use cookies.</div><main><article><header><h1>Title</h1></header>
    <p>First&nbsp;para, with <a href=x>link</a> and
    <b>bold</b>.</p><div class="ad"><p>Buy</p></div><script>var t="</p><p>no</p>";</script><!-- <p>no</p> -->
    <p>Second &lt;tag&gt; para &amp;amp; more<br>line two.<ul><li>One<li>Two</ul>
    <table><tr><td>a<td>b</table><form><p>Mail</p><input><button>Go</button></form>
    <section id="comments"><p>Nice post</p></section></article></main><footer>&copy; f</footer></body></html>"""
    assert X.main_text(page, WEIGHTS) == "\n".join(
        ["Title", "First para, with link and bold.", "Second <tag> para &amp; more line two.", "One", "Two", "a", "b"])


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<article>", ""), ("<article><p>a &am", "a &am"), ("<article><p>a<p>b<div", "a\nb"),
    ("<article><p>x < y &#65;&#x42;&hellip;</article>", "x < y AB…"), ("<article><p a='>'>q</p>", "q"),
    ("<ARTICLE><P>up</P></ARTICLE><FOOTER>no</FOOTER>", "up"), ("<article><p hidden>h</p><p>v</p>", "v"),
    ("<article><p>a</p><style>no", "a"), ("<article><p>" + "w " * 50_000 + "</p>", ("w " * 50_000).strip()),
])
def test_odd_pages(page, text):
    assert X.main_text(page, WEIGHTS) == text


@pytest.mark.parametrize("page,text", [
    ('<article><p title="hidden gems of Rome">a</p></article>', "a"), ("<article><p data-hidden='false'>a</p>", "a"),
    ('<article><p>a <b title="so hidden">b</b></p>', "a b"), ('<article><p data-id="comments">a</p>', "a"),
    ('<article><a href="/x?id=search&p=1"><h2>a</h2></a>', "a"), ("<article><a href=/x?id=search&p=1><h2>a</h2></a>", "a"),
    ('<article><p alt="class=comment" data-style="display:none">a</p>', "a"), ("<article><p 'hidden'>a</p>", "a"),
    ('<article><p class=x class="comment">a</p>', "a"), ('<article><p x="1"hidden>no</p><p>a</p>', "a"),
    ('<article><p ID = comments>no</p><p>a</p>', "a"), ('<article><p HIDDEN/>no</p><p>a</p>', "a"),
    ('<article><p class="a\ncomment">no</p><p style="color:red; DISPLAY : none">no</p><p aria-hidden=true>no</p><p>a</p>', "a"),
])
def test_attributes_count_by_whole_name(page, text):
    assert X.main_text(page, WEIGHTS) == text


LEARNED = np.array([-6.3, 0.6, -6.4, 2.6, -13.2, 2.4, 11.3, 0.8])  # fitted on 1000 pages of sf0.1, rounded
LONG = ["A first sentence of this text, which goes on for a while. It has a second one, too, as texts have.",
        "Here is another part, with commas, and with words enough. It says what the first left out, and more."]


@pytest.mark.parametrize("page,text", [
    ('<div class="layout has-sidebar"><main><p>a</p></main><div class="sidebar"><p>no</p></div></div>', "a"),
    ('<div class="layout has-sidebar"><div><article class="post"><h1>t</h1><p>a</p></article></div></div>', "t\na"),
    ('<div id="comments"><article class="comment"><p>no</p></article></div>', ""),
    ('<main><div class="ad"><p>no</p></div><p>a</p></main>', "a"), ("<nav><div class=text>no</div></nav>", ""),
])
def test_elements_outweigh_outer_class_words(page, text):
    assert X.main_text(page, WEIGHTS) == text


def test_page_without_stated_elements():
    links = "".join(f"<div><a href=/{k}>Link {k}</a></div>" for k in range(6))
    page = f"<body>{links}<section>{''.join(f'<p>{t}</p>' for t in LONG)}<p>So it is.</p><p>{LONG[0]}</p></section>{links}"
    assert not any(b.stated for b in X.blocks_of(page))
    assert X.main_text(page, LEARNED).split("\n") == [*LONG, "So it is.", LONG[0]]


def test_cut_outweighs_a_statement():
    page = f"<article><p>{LONG[0]}</p></article><div class=share>{LONG[1]}</div><article><p>{LONG[0]}</p></article>"
    assert X.main_text(page, LEARNED).split("\n") == [LONG[0], LONG[1], LONG[0]]
    assert X.main_text(page, WEIGHTS).split("\n") == [LONG[0], LONG[0]]
    links = "".join(f"<p><a href=/{k}>Link {k}</a></p>" for k in range(6))
    assert X.main_text(f"<div class=content>{links}</div>", LEARNED) == ""


def test_many_undecided_blocks():
    rng = random.Random(3)
    cost = [rng.uniform(-1, 1) for _ in range(5000)]
    edges = [(k, k + 1, X.NEIGHBOUR + X.SIBLING) for k in range(4999)]
    label = X.minimum_cut(cost, edges)
    low = [max(-cost[0], 0), max(cost[0], 0)]  # kept, dropped: least energy along the chain, by label of its last block
    for c in cost[1:]:
        low = [min(low[s], low[1 - s] + 1.2) + max(c if s else -c, 0) for s in (0, 1)]
    assert energy(cost, edges, label) == pytest.approx(min(low))


def test_many_blocks():
    page = "<article>" + "".join(f"<p>para {k}.</p>" for k in range(5000)) + "</article><footer>f</footer>"
    assert X.main_text(page, WEIGHTS).count("\n") == 4999


def article(page):
    m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    inner = m[1] if m[2] else re.sub(r"<[^<>]*\Z", "", m[1])
    parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op9_extract_main_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_text_features_alone_separate_most_blocks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = X.fit_weights(pages)
    right = []
    for r in pages.collect():
        blocks = X.blocks_of(r.html)
        right += [(s > 0) == (b.stated > 0) for s, b in zip(X.features(blocks) @ weights, blocks) if b.stated]
    assert np.mean(right) > 0.95


def test_empty_table_and_nulls(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<article><p>a</p>", 2), (1, "u", "<article><p>a</p>", 2)],
                               "page_id long, url string, html string, text int")
    assert sorted(r.text for r in X.extract(df).collect()) == ["", "a", "a"]
    assert X.extract(df.limit(0)).count() == 0
