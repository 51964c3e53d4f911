import html as H
import re

import pytest

import __spark_entry__ as E
from affinity.llm.html_text import extract, main_text, smoothed, threshold

SF = "/root/testdata/sf0.01"
P = "A long paragraph of words that says what the article is about, more than once."

CASES = [
    ("", ""), ("<p>", ""), ("plain text only", "plain text only"), ("a &lt;b&gt; &amp; c&nbsp;d", "a <b> & c d"),
    (f"<nav><a>Home</a></nav><article><h1>T</h1><p>{P}</p><p>x</p></article><footer>f</footer>", f"T {P} x"),
    (f'<div class="header">Menu</div><div id="content"><p>{P}</p><p>Short.</p><div class="comments"><p>{P}</p></div></div>', f"{P} Short."),
    (f'<main><p>{P}</p><aside>{P}</aside><form><p>{P}</p></form><p>fo<b>o</b>d</p><div class="cookie-notice">ok</div></main>', f"{P} food"),
    (f"<article><p>{P}<p>{P}<br>more</article><script>if (a<b) 1;</script>", f"{P} {P} more"),
    (f"<article><p>{P}</p><style>p{{}}</style><!-- no --><p>a\n\n b\tc</p>", f"{P} a b c"),
    (f"<body><div><ul><li><a>Home</a><li><a>News</a></ul></div><div><h1>T</h1><p>{P}</p><p>y</p><p>{P}</p></div><div><a>Legal</a></div>", f"T {P} y {P}"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_pages(page, text):
    assert main_text(page) == text


def test_smoothing_and_threshold():
    import numpy as np
    flat = smoothed(np.ones(7), 1.0)
    assert abs(flat - 1).max() < 1e-12
    cut = threshold(np.array([1.0, 2, 1, 90, 100, 80]))
    assert 2 < cut < 80


def test_nulls_repeats_clashing_columns_empty(spark):
    rows = [(1, "u", None, "x", 1), (1, "u", CASES[4][0], "x", 1), (None, None, CASES[4][0], "x", 1)]
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, tags bigint")
    got = sorted(r["text"] for r in extract(d).collect())
    assert got == ["", f"T {P} x", f"T {P} x"] and extract(d.limit(0)).count() == 0


def test_query_against_the_template(spark):
    """The test pages have one article of p, h1 and br: a plain split of it is the truth."""
    def truth(page):
        body = re.search(r"<article>(.*)</article>", page, re.S)[1]
        lines = (" ".join(H.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", body))
        return " ".join(x for x in lines if x)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in E.queries()["op4_html_text"](spark, SF).collect():
        assert r.text == truth(pages[r.page_id]) and r.n_chars == len(r.text)


WHOLE = [
    (f"<main><article><p>{P}</p><p>{P}</p></article><section><p>{P}</p></section></main>", f"{P} {P} {P}"),
    (f"<main><article><p>{P}</p><p>{P}</p><p>{P}</p></article><section><p>{P}</p><p>x</p><p>{P}</p></section></main>", f"{P} {P} {P} {P} x {P}"),
    (f"<nav>n</nav><div><article><p>{P}</p><p>1</p></article><article><p>{P}</p><p>2</p></article></div>", f"{P} 1 {P} 2"),
    (f"<article><p>{P}</p></article><article><p>{P}</p></article><article><p>{P}</p></article>", f"{P} {P} {P}"),
    (f"<body><div><ul><li><a>Home</a><li><a>News</a></ul></div><h1>T</h1><div><p>{P}</p></div><div>" + f"<p>{P}</p>" * 30
     + f"<p>y</p></div><div><p>{P}</p><p>end</p></div><div><a>Legal</a></div>", " ".join(["T", *[P] * 31, "y", P, "end"])),
    (f"<main><div><p>{P}</p></div><div class=\"sidebar\"><p>{P}</p></div><article>" + f"<p>{P}</p>" * 12 + "</article><p>z</p></main>", " ".join([*[P] * 13, "z"])),
    (f"{P}<div>" + f"<p>{P}</p>" * 12 + "</div>", " ".join([P] * 13)),
]


@pytest.mark.parametrize("page, text", WHOLE)
def test_content_in_several_elements_is_whole(page, text):
    assert main_text(page) == text


BROKEN = [
    (f"<html><head><title>x</title><body><article><p>{P}</p></article>", P),
    (f"<html><head><meta charset=utf-8><title>x</title><article><p>{P}</p></article>", P),
    (f"<body><nav><ul><li><a>Home</a><article><p>{P}</p><p>y</p></article>", f"{P} y"),
    (f"<body><div><header><div><nav><a>Home</a><main><p>{P}</p><p>y</p></main></div>", f"{P} y"),
    (f"<body><form action=x><input><main><p>{P}</p><form><p>{P}</p></form></main></form>", P),
    (f"<body><div class='with sidebar'><main><p>{P}</p></main></div>", P),
    (f"<article><p>{P}</p><aside><article><p>{P}</p></article></aside></article>", P),
    (f"<div><a>Home</a></div><div><h1>TITLE</h1><div>" + f"<p>{P}</p>" * 3 + "</div></div>", " ".join(["TITLE", P, P, P])),
    (f"<div><p>Home</p><h1>TITLE</h1><p>by me</p><div>" + f"<p>{P}</p>" * 3 + "</div></div>", " ".join(["TITLE by me", P, P, P])),
]


@pytest.mark.parametrize("page, text", BROKEN)
def test_missing_end_tags_and_titles_beside_the_text(page, text):
    assert main_text(page) == text


IDS = """side-effects share-price form-follows-function search-theory hidden-figures replies legal notice header-image
    comment-on-method menu-engineering advertising related-work""".split()


@pytest.mark.parametrize("name", IDS)
def test_ids_made_from_headings_stay(name):
    page = f'<article><h1 class="page-header">T</h1><section id="{name}"><h2 id="{name}">S</h2><p>{P}</p></section><p>{P}</p></article>'
    assert main_text(page) == f"T S {P} {P}"


def test_marked_parts_of_an_article_go():
    for mark in ('class="share-bar"', 'class="ad"', 'class="related-posts"', 'id="comments"', 'class="newsletter"', 'role="search"', "hidden"):
        assert main_text(f'<article><header class="entry-header"><h1>T</h1></header><p>{P}</p><div {mark}><p>{P}</p></div></article>') == f"T {P}"


def _news(title, paragraphs):
    """A template without article or main."""
    menu = "".join(f"<li><a href=/{k}>Part {k}</a></li>" for k in range(12))
    body = "".join(f"<p>{x}</p>" for x in paragraphs)
    return (f"<!doctype html><html><head><title>x</title><style>p{{}}</style></head><body><div id=top-bar><ul>{menu}</ul></div>"
            f"<div id=wrap><div class=col><h1 id=search-for-it>{title}</h1><div class=story>{body}</div></div>"
            f"<div class=sidebar><ul>{menu}</ul></div></div><div class=footer><a>Imprint</a> <a>Legal</a></div></body></html>")


def _docs(title, paragraphs):
    """A template with main, sections with ids made from their headings, lists, and no optional end tags."""
    parts = "".join(f"<section id='{w.lower()}'><h2 id='{w.lower()}'>{w}</h2><p>{x}<ul><li>one<li>two</ul></section>"
                    for w, x in zip(("Related-work", "Legal", "Notice", "Search"), paragraphs))
    return (f"<html><head><title>x</title><body><nav><a>Home</a><ul><li><a>API</a></ul></nav><main><header><h1>{title}</h1></header>{parts}"
            f"<div class='pagination'><a>next</a></div></main><footer>(c)</footer>")


def test_other_templates():
    import random
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9)))
    for _ in range(60):
        texts = [" ".join(word() for _ in range(rnd.randint(25, 90))) for _ in range(4)]
        assert main_text(_news("A title", texts)) == " ".join(["A title", *texts])
        want = " ".join(f"{w} {x} one two" for w, x in zip(("Related-work", "Legal", "Notice", "Search"), texts))
        assert main_text(_docs("A title", texts)) == f"A title {want}"


@pytest.mark.parametrize("page", [
    "<div>" + "<b>x</i>" * 40_000,
    "<i><div>" + "<b>x</i>" * 40_000,
    "<div>" + "<b>" * 20_000 + "<p>x</p>" * 20_000,
    "<div>x" * 20_000,
    "<ul>" + "<b><li>x" * 30_000,
    "<article><p>" + "word " * 400_000,
    "x</div></p>" * 40_000,
])
def test_time_is_linear_in_long_and_broken_pages(page):
    import time
    begin = time.process_time()
    text = main_text(page)
    assert text and time.process_time() - begin < 8
