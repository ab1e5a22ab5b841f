"""Main text against plain readings of the pages, and the suffix array against all substrings."""

import html
import random
import re

import numpy as np
import pytest

from llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <p>comment</p> -->
<div class="ad top-ad">Buy <div>now</div></div><article class="post"><header><h1>Title &amp;&nbsp;more</h1></header>
<p>One <b>bo</b>ld &lt;tag&gt; &#233;&#x41; a<br>b<p title="a > b">Two
 lines</p><script>x()</script><form><p>mail</p><input></form><aside>side</aside>
<div class='comments'><p>first!</p></div><ul><li>item 1<li>item 2</ul>tail 3 < 4</article>
<section id="comments"><article class="comment">reader</article></section><footer>end</footer></body></html>"""


def test_one_page():
    assert html_text.blocks(PAGE) == (
        ["Title & more", "One bold <tag> éA a b", "Two lines", "item 1", "item 2", "tail 3 < 4"], [True] * 6)
    assert html_text.blocks("<main><p>a<nav>n</nav></main><p>out") == (["a"], [True])
    assert html_text.blocks("<p>a<div role=navigation>n</div>b") == (["a", "b"], [False, False])
    for empty in (None, "", "   ", "<script>", "<!-- never ends <p>x", "<nav>x", "<"):
        found, _ = html_text.blocks(empty)
        assert found in ([], ["<"])


@pytest.mark.parametrize("page", [
    "<div class='page has-sidebar'><article><p>text</p></article></div>", "<div class='no-sidebar'><p>text</p></div>",
    "<article class='post comments-open'><p>text</p></article>", "<div id='content' class='with-ads'><main>text</main></div>",
    "<div class='page sidebar'><div class='ad'>Buy</div><article>text<p class=share>Share</article></div><p>end</p>",
    "<article class='widget'>text</article>", "<div class='comments'><article>text</article></div>", "<div class=sidebar>text</div>",
    "<div class='main header'><main><h1>text</h1></main></div><nav>menu</nav>"])
def test_classes_do_not_take_the_article(page):
    assert html_text.blocks(page)[0] == ["text"]


def test_classes_take_what_is_not_the_article():
    teasers = "<div class='sidebar'><article>teaser</article></div><section id=comments><article class=comment>" + "reader " * 50
    assert html_text.blocks(f"<div>the post itself</div>{teasers}") == (["the post itself"], [False])
    assert html_text.blocks(f"<article>post</article>{teasers}") == (["post"], [True])
    assert html_text.blocks("<p>a <span class='ad'>Buy</span>b <i class='cookie-banner'>ok</i></p>")[0] == ["a b"]


def test_long_and_broken_pages():
    text = "word " * 200_000
    assert html_text.blocks(f"<article><p>{text}</article>")[0] == [text.strip()]
    assert html_text.blocks("<b>" * 5000 + "x")[0] == ["x"]
    assert html_text.blocks("<article><p>a</p></b></div>c</article>d")[0] == ["a", "c"]


@pytest.mark.parametrize("least", [1, 2, 3, 5, 8, 16])
def test_repeats_equal_all_substrings(least):
    rng = random.Random(least)
    for _ in range(20):
        shared = [rng.choice("abcdef") for _ in range(rng.randint(0, 30))]
        pages = []
        for _ in range(rng.randint(1, 6)):
            own = [rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 30))]
            cut = rng.randint(0, len(own))
            pages.append(own[:cut] + shared[rng.randint(0, 3):] + own[cut:] if rng.random() < 0.7 else own)
        where = {}
        for k, p in enumerate(pages):
            for i in range(len(p) - least + 1):
                where.setdefault(tuple(p[i:i + least]), set()).add(k)
        got = html_text.repeated(pages, least, 2)
        for k, p in enumerate(pages):
            want = np.zeros(len(p), bool)
            for i in range(len(p) - least + 1):
                if len(where[tuple(p[i:i + least])]) >= 2:
                    want[i:i + least] = True
            assert got[k].tolist() == want.tolist()


SCHEMA = "page_id long, url string, html string, text int, host string, blocks string"


def test_repeated_runs_go_from_pages_without_an_article(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(1000)]
    menu = " ".join(rng.choice(words) for _ in range(30))
    own = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(60)]
    rows = [(k, f"https://a.example/{k}", f"<body><div>{menu} {own[k]}</div><p>{menu}</p>", 1, "h", "b") for k in range(40)]
    rows += [(k, "https://b.example/", f"<article><p>{menu}</p><p>{own[k]}</p></article>", 1, "h", "b") for k in range(40, 60)]
    for unit in (512, 20):
        got = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA), unit_pages=unit).collect()}
        assert [got[k].text for k in range(40)] == own[:40]
        assert [got[k].text for k in range(40, 60)] == [f"{menu}\n{own[k]}" for k in range(40, 60)]
        assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize("unit", [{}, {"unit_pages": 4}, {"unit_tokens": 50}])
def test_repeats_on_few_pages_of_a_large_host_go(spark, unit):
    rng = random.Random(2)

    def text(n):
        return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))

    notes = [text(25) for _ in range(12)]
    own = [text(40) for _ in range(72)]
    # notes 0 to 5 are on three pages each, 6 to 11 on two; another host has them too
    pages = [(k, f"<div>{notes[k // 3]} {own[k]}</div>") for k in range(18)] + [
        (k, f"<div>{notes[6 + (k - 18) // 2]} {own[k]}</div>") for k in range(18, 30)] + [(k, f"<p>{own[k]}") for k in range(30, 72)]
    rows = [(k, f"https://a.example/{k}", page, 1, "h", "b") for k, page in pages]
    rows += [(100 + k, "https://b.example/", f"<div>{n}</div>", 1, "h", "b") for k, n in enumerate(notes)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA), **unit).collect()}
    assert [got[k] for k in range(72)] == [f"{notes[6 + (k - 18) // 2]} {own[k]}" if 18 <= k < 30 else own[k] for k in range(72)]
    assert [got[100 + k] for k in range(12)] == notes


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://x/y", "<p>a"), (3, "no url", "<p>b"), (3, "no url", "<p>b"), (4, "http://x/", "plain")]
    got = html_text.main_text(spark.createDataFrame([(*r, 1, "h", "b") for r in rows], SCHEMA)).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got), key=repr) == sorted(
        [(1, None, "", 0), (2, "", "", 0), (None, "http://x/y", "a", 1), (3, "no url", "b", 1), (3, "no url", "b", 1), (4, "http://x/", "plain", 5)], key=repr)
    assert html_text.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_a_plain_reading(spark, small):
    from llm.queries import QUERIES

    got = {r.page_id: r for r in QUERIES["op9_main_text"](spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|div|ul|li)>", inner)
        want = "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^<>]*>", " ", p)).split()) for p in parts) if t)
        assert got[page.page_id].text == want and got[page.page_id].url == page.url


def test_a_form_around_the_page_keeps_its_text():
    page = '<body><form id="aspnetForm"><p>All of the text.</p><article><h1>Title</h1><form><label>Mail</label></form><p>Body.</p></article></form></body>'
    assert html_text.blocks(page)[0] == ["Title", "Body."]
    assert html_text.blocks('<form action="/"><p>All of the text.</p></form>')[0] == ["All of the text."]
    assert html_text.blocks("<p>Text.</p><form><label>Mail</label></form>")[0] == ["Text."]


def test_quotes_in_values_without_quotes_are_plain():
    assert html_text.blocks("<p>Don't <a href=it's>read</a> this</p><p>it's fine</p>")[0] == ["Don't read this", "it's fine"]
    assert html_text.blocks("<p title=\"a > b\" id='c > d'>one</p><p class=x>two</p>")[0] == ["one", "two"]


def test_teasers_and_titles():
    teaser = "<article><p>A short teaser.</p></article>"
    assert html_text.blocks(f"{teaser}<div>{'<p>The long text goes on.</p>' * 4}</div>")[0] == ["The long text goes on."] * 4
    assert html_text.blocks(f"{teaser}<div><p>Less text.</p></div>")[0] == ["A short teaser."]
    page = '<div class="site-header">Site</div><div class="post-header"><h1>Title</h1></div><p>Text.</p>'
    assert html_text.blocks(page)[0] == ["Title", "Text."]


def test_broken_pages_take_linear_time():
    import time

    for page in ("<div>" * 100_000 + "</x>" * 150_000, "<b>" * 50_000 + "<p>x" * 50_000 + "</i>" * 50_000, "<a " + "= '" * 200_000):
        begun = time.process_time()
        html_text.blocks(page)
        assert time.process_time() - begun < 6  # 1 MB; a quadratic walk takes many minutes
