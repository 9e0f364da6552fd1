import time

import pytest

from wickwork.llm import html_extract
from wickwork.llm.html_extract import between_surge_and_dive, main_text

LONG = "many words of running text that make this paragraph long enough to stand out"

CASES = {
    "article": (f"<nav>Menu</nav><article><h1>T</h1><p>{LONG}</p><p>Short.</p></article><footer>F</footer>", f"T\n{LONG}\nShort."),
    "references": ("<article><p>a &amp; b &lt;i&gt; &eacute; &#228; &unknown;</p></article>", "a & b <i> é ä &unknown;"),
    "white space": ("<article><p> a\n\t b&nbsp;c </p>\n<p>\n</p></article>", "a b c"),
    "raw elements": ('<style>p{}</style><script>var t="</p>";</script><p>text</p><!-- <p>no</p> --><noscript>n</noscript>', "text"),
    "not closed": ("<article><p><b>one<br><p>two<p>three", "one\ntwo\nthree"),
    "cut tag": ("<article><p>one</p><p>two <a hre", "one\ntwo"),
    "inline": ("<article><p>a<b>b</b>c <i>d</i></p></article>", "abc d"),
    "inside": (
        f"<article><p>{LONG}</p><div class='ad'>Buy</div><aside>Side</aside><form><p>Name</p></form>"
        f"<div class='share-buttons'>Share</div><p>End.</p></article>",
        f"{LONG}\nEnd.",
    ),
    "comments": (f"<article><p>{LONG}</p></article><div id='comments'><article><p>{LONG} {LONG}</p></article></div>", LONG),
    "article comments": (f"<article><p>{LONG}</p></article><section><article class='comment'><p>{LONG} more</p></article></section>", LONG),
    "header": ("<header><p>Site</p></header><article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
    "no article": (
        f"<div class='site-header'>Site</div><div><h1>T</h1><p>{LONG}</p><p>Hm.</p></div><div class='sidebar'>s<p>s</p><p>s</p></div>"
        "<div class='footer'>f</div>",
        f"T\n{LONG}\nHm.",
    ),
    "notice": (f"<div class='cookie-notice'><p>{LONG}</p></div><main><p>x</p></main><div role='alert'>y</div>", "x"),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    "layout classes": ("<body class='has-sidebar'><div class='no-header'><article class='sidebar-left'><p>x</p></article></div></body>", "x"),
    "plain": ("just text &amp; more", "just text & more"),
    "empty": ("", ""),
    "no text": ("<html><body><img src=x></body></html>", ""),
    "quoted >": ("<article><p title='a > b'>x</p></article>", "x"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    html, text = CASES[name]
    assert main_text(html) == text


def test_null_page():
    assert main_text(None) == ""


def test_surge_and_dive():
    assert between_surge_and_dive([0, 5, 0, 0, 0, 40, 0, 3, 50, 0, 0, 0, 9], 3) == (5, 9)
    assert between_surge_and_dive([0, 0], 3) == (0, 0)
    assert between_surge_and_dive([7], 3) == (0, 1)


def test_links_alone_are_no_text():
    links = "".join(f"<div><a href='/{k}'>a rather long link text number {k}</a></div>" for k in range(30))
    assert main_text(f"<body>{links}<br><br><div></div><p>{LONG}</p></body>") == LONG


def test_whole_text_of_a_very_long_page():
    paragraphs = [f"{k} {LONG}" for k in range(20000)]
    assert main_text("<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>") == "\n".join(paragraphs)


@pytest.mark.parametrize("tag", ["<div>", "<article>", "<div class='ad'><article>", "<div></span>", "<b class='ad'>"])
def test_many_unclosed_elements(tag):
    started = time.perf_counter()
    text = main_text(tag * 30_000 + f"<p>{LONG}</p>")
    assert time.perf_counter() - started < 20
    assert text == ("" if tag.startswith("<b") else LONG)


MARKED = {
    "siblings": (f"<article><p>{LONG} one</p></article><div class='ad'>Buy</div><article><p>{LONG}</p></article>", f"{LONG} one\n{LONG}"),
    "body beside cards": (
        f"<div>Home</div><article><h3>Card</h3></article><div><h1>T</h1><p>{LONG}</p><p>Hm.</p></div><div>c 2024</div>",
        f"Card\nT\n{LONG}\nHm.\nc 2024",
    ),
    "short lines outside": (f"<div>Home</div><article><p>{LONG}</p></article><div>c 2024</div>", LONG),
    "related cards": (f"<main><p>{LONG}</p></main><div class='related'><article><p>card</p></article></div>", LONG),
    "related cards inside": (f"<main><p>{LONG}</p><div class='related'><article><p>card</p></article></div></main>", LONG),
    "class of a wrapper": (f"<main><h1>T</h1><div class='widget'><article><p>{LONG}</p></article></div></main>", f"T\n{LONG}"),
    "links": (f"<article><p>{LONG}</p>" + "<p><a href='/x'>Source</a></p>" * 4 + "</article>", LONG + "\nSource" * 4),
}


@pytest.mark.parametrize("name", MARKED)
def test_marked_articles_are_evidence(name):
    html, text = MARKED[name]
    assert main_text(html) == text


def test_marked_pages_take_the_surge_and_dive_search(monkeypatch):
    searched = []
    search = html_extract.surges
    monkeypatch.setattr(html_extract, "surges", lambda lengths, window: searched.append(lengths) or search(lengths, window))
    assert main_text(f"<article><p>{LONG}</p></article>") == LONG
    assert [n for lengths in searched for n in lengths if n] == [html_extract.LONG + len(LONG)]


UNMARKED = {
    "line ends between blocks": (f"<div>\n<div class=section>\n<p>{LONG} one</p>\n</div>\n\n<div class=section>\n<p>{LONG}</p>\n</div>\n</div>", f"{LONG} one\n{LONG}"),
    "line ends and a short line": (f"<div>\n<p>{LONG}</p>\n</div>\n<div>\n<p>&nbsp;</p>\n</div>\n<div>\n<p>Hm.</p>\n</div>", f"{LONG}\nHm."),
    "advert": (f"<div><p>{LONG} one</p><div class='ad'><p>Buy</p><p>now</p><p>here</p></div><p>{LONG}</p></div>", f"{LONG} one\n{LONG}"),
    "links": (f"<div><p>{LONG} one</p>" + "<p><a href='/x'>More</a></p>" * 4 + f"<p>{LONG}</p></div>", f"{LONG} one\n{LONG}"),
    "short after links": (f"<div><p>{LONG}</p>" + "<p><a href='/x'>More</a></p>" * 4 + "<p>c 2024</p></div>", LONG),
    "white space around a body": (f"<article>\n<h3>Card</h3>\n</article>\n<div>\n<div>\n<p>{LONG}</p>\n</div>\n<div>\n<p>Hm.</p>\n</div>\n</div>", f"Card\n{LONG}\nHm."),
}


@pytest.mark.parametrize("name", UNMARKED)
def test_gaps_do_not_end_the_text(name):
    html, text = UNMARKED[name]
    assert main_text(html) == text


def test_query_columns(spark, clashing):
    pages = clashing(spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, None), (2, None, None)], "page_id bigint, url string, html string"), "text", "n_chars")
    out = html_extract.extract(pages, "page_id", "url")
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(1, "a", 1), (2, "", 0), (2, "", 0)]
    assert html_extract.extract(pages.limit(0), "page_id").count() == 0
