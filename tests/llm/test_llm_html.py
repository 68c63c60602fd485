"""Block rules on pages with and without landmarks."""
import html
import re
import time

import pytest
from llm_cases import clash, frame

from ontime_spark.llm import html_extract as H

LONG = ("The main thing of the article is that it is long and has many of the words that are in the list of the common "
        "words, so that it is good for the reader and for the extractor of the text. And it goes on for a while.")
CHROME = [
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav>", "<header><h2>The Daily Site</h2></header>",
    "<footer>&copy; 2024 The Site</footer>", f"<aside><p>{LONG}</p></aside>", f"<div class='sidebar'><p>{LONG}</p></div>",
    f"<div id='cookie-notice'>{LONG}</div>", "<div class=\"ad\">Buy now</div>", f"<div class='ad-banner top'>{LONG}</div>",
    "<form><label>Name</label><input><select><option>x</option></select></form>", "<script>var t='</p>';</script>",
    "<style>p{margin:0}</style>", f"<section id='comments'><article class='comment'><p>{LONG}</p></article></section>",
    f"<div class=commentList><p>{LONG}</p></div>", "<!-- <p>hidden</p> -->", f"<div style='display:none'>{LONG}</div>",
    f"<div role=complementary>{LONG}</div>", "<noscript>Turn it on</noscript>", "<button>Go</button>"]


@pytest.mark.parametrize("chrome", CHROME)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>"])
def test_chrome_is_left_out_wherever_it_stands(chrome, wrap):
    body = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p><p><b>{LONG}</b><br>{LONG}</p>"
    want = f"A title {LONG} Short. {LONG} {LONG}"
    pages = [chrome + wrap.format(body), wrap.format(body) + chrome]
    if not chrome.startswith("<header"):  # an article's own header is part of it
        pages.append(wrap.format(body.replace("<p>Short", chrome + "<p>Short", 1)))
    for page in pages:
        assert H.main_text(f"<html><head><title>x</title></head><body>{page}</body></html>") == want


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<article><p>a &lt;b&gt; &eacute;&#233;&nbsp;c\n\t d</p>", "a <b> éé c d"),
    ("<article><p>one<p>two <b>three", "one two three"), ("<article><p>cut &am", "cut &am"), ("<article><p>cut <a hre", "cut"),
    ("<article><p title='a>b'>x</p></article>", "x"), ("<article><p title='a>x</p></article>", "x"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T x"),
    (f"<div class='page with-sidebar no-ads'><h1>T</h1><p>{LONG}</p></div>", f"T {LONG}"),
    ("<body><p>no landmark, no stop word match</p></body>", "no landmark, no stop word match"), ("just text", "just text"),
    (f"<nav>Home</nav><div><p>{'Это русский текст без ориентиров страницы. ' * 8}</p></div><div><a href=/>Меню</a></div>",
     ("Это русский текст без ориентиров страницы. " * 8).strip()),
    (f"<div><h1>标题</h1><p>{'这是没有地标的中文正文段落' * 9}</p></div><footer>版权</footer>", "标题 " + "这是没有地标的中文正文段落" * 9),
    (f"<form action=/post><h1>T</h1><p>{LONG}</p><p>{LONG}</p></form>", f"T {LONG} {LONG}"),
    (f"<article><p>{LONG}</p><form><label>Your name</label></form></article>", LONG),
    (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG), (f"<article class=promo-story><p>{LONG}</p></article>", LONG),
    (f"<article><div class='side-by-side'><p>{LONG}</p></div></article>", LONG),
    ("<article><p>x</p><p><a href=/a>A paragraph that is nearly one long link to another page of the site</a> it is.</p></article>",
     "x A paragraph that is nearly one long link to another page of the site it is."),
    (f"<article><p>{LONG}</p><ul><li><a href=/1>First other page</a></li><li><a href=/2>Second</a></li></ul></article>", LONG)])
def test_edges(page, text):
    assert H.main_text(page) == text


def test_ambiguous_blocks_take_the_nearest_label():
    label = H.classify([H.Block(t, n, c, False, h) for t, n, c, h in [
        ("Home", 4, False, False), ("tiny", 0, False, False), (LONG, 0, False, False), ("Ok.", 0, False, False),
        (LONG, 0, False, False), ("Head", 0, False, True), ("menu", 4, True, False)]])
    assert label == [False, False, True, True, True, False, False]


def test_deep_and_long_pages_take_linear_time():
    start = time.perf_counter()
    assert H.main_text("<article>" + "<div>" * 200_000 + "deep") == "deep"
    assert H.main_text("<div class='x'>" * 60_000 + "</span>" * 20_000 + "deep" + "</div>" * 60_000) == "deep"
    assert H.main_text("<article>" + "<p>word <b>two</b>" * 100_000) == " ".join(["word two"] * 100_000)
    assert time.perf_counter() - start < 8


def test_pages_table(spark):
    """The test pages have one article each: its blocks, cut and decoded by plain patterns."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in H.op2_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for r in rows:
        m = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)
        parts = re.split(r"</?(?:p|h1|br)[^>]*>", re.sub(r"</?b>|<[a-z/][^>]*$", "", m.group(1))) if m else []
        text = " ".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (text, len(text), r.url)


def test_rows_and_clashing_columns(spark):
    rows = [(1, None), (2, "<article><p>x y</p></article>"), (2, "<article><p>x y</p></article>"), (3, "<p>" * 3000),
            (4, "<article>" + "<div>" * 500 + "deep" + "</div>" * 500)]
    out, r = H.extract(clash(frame(spark, rows, "page_id long, html string")))
    assert sorted((x.page_id, x[r].text) for x in out.collect()) == [(1, ""), (2, "x y"), (2, "x y"), (3, ""), (4, "deep")]
    assert H.extract(frame(spark, [], "page_id long, html string"))[0].count() == 0
