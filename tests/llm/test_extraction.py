"""Main text of pages: the given table against its own article markup, and pages of other makes."""

import html
import re

import pytest
from llm_corpus import docs, nothing, rows  # noqa: F401

from seqloom.llm import extraction
from seqloom.llm.queries import QUERIES

LONG = "A paragraph that is long enough to look like prose, with several clauses, and with a second half. " * 4
OTHER = "Another stretch of running text follows here, so that the region has more than one line of content. " * 3


def one_line(text):
    return " ".join(text.split())


def test_given_pages_are_their_articles(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"].run(spark, sf).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        page = pages[r.page_id]
        inside = page.html.split("<article>")[1].split("</article>")[0]
        blocks = [one_line(html.unescape(re.sub("<[^>]*>", " ", b))) for b in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (page.url, len(r.text))


HEAD = "<!doctype html><html><head><title>No</title><style>p{}</style><script>var a='<p>no</p>';</script></head>"
WANT = ["The headline", one_line(LONG), "Short one.", "first item", "second item", one_line(OTHER)]
BODY = f"<h1>The headline</h1><p>{LONG}</p><p>Short one.</p><ul><li>first item</li><li>second item</li></ul><p>{OTHER}</p>"
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News and more news</a></li><li><a>About us</a></li></ul>"
READERS = f"<p><b>Ann</b> wrote:</p><p>{OTHER}</p><p>I do not agree.</p>"
MADE = {
    "article": f"<nav>{MENU}</nav><article>{BODY}</article><footer><p>{LONG}</p></footer>",
    "article with its own header, footer, aside": (
        f"<header><a>Site</a><p>{LONG}</p></header><main><article><header><h1>The headline</h1></header>"
        f"{BODY.replace('<h1>The headline</h1>', '')}<aside><p>{OTHER}</p></aside><footer>By me</footer></article></main>"
    ),
    "headline before the article": f"<main><h1>The headline</h1><article>{BODY.replace('<h1>The headline</h1>', '')}</article></main>",
    "names": (
        f"<div id='header'><p>Site name</p></div><div class='main-menu'>{MENU}</div><div class='content'>{BODY}</div>"
        f"<div class='sidebar'><h3>More</h3><p>{OTHER}</p></div><div class='cookie-notice'><p>{OTHER}</p></div>"
        f"<section id='comments'><h2>Comments</h2>{READERS}</section><div class='advertBox ad'><p>{LONG}</p></div>"
    ),
    "wrapper named after its sidebar": f"<div class='with-sidebar'><main>{BODY}</main><div class='sidebar'><p>{LONG}</p></div></div>",
    "nameless": (
        f"<div><a>Home</a> <a>News</a></div><div>{MENU}</div><div>{BODY}</div><div><p>Buy now!</p></div>"
        "<div>&copy; 2020 A company, all rights kept</div>"
    ),
    "a box for every block": (
        f"<div>{MENU}</div><div><h2>The headline</h2><div><p>{LONG}</p></div><div><p>Short one.</p></div><div><ul><li>first item</li>"
        f"<li>second item</li></ul></div><div><p>{OTHER}</p></div></div><div><a>Next page</a></div>"
    ),
    "table layout": f"<table><tr><td>{MENU}</td><td>{BODY}</td></tr></table><p><a>Imprint</a></p>",
    "readers behind a heading": f"<article>{BODY}<h3>3 Comments</h3>{READERS}</article>",
    "never closed": f"<article><h1>The headline<p>{LONG}<p><b>Short one.<br><ul><li>first item<li>second item</ul><p>{OTHER}",
    "form and hidden parts": (
        f"<article>{BODY}<form><label>Your name</label><input><button>Send</button></form><p hidden>gone</p>"
        "<div style='display: none'>gone too</div><noscript>turn it on</noscript><svg><text>x</text></svg></article>"
    ),
    "comments, declarations": f"<!-- <p>no</p> --><![CDATA[ no ]]><!weird><?php no ?><article>{BODY}</article><!-- never closed <p>no</p>",
}


@pytest.mark.parametrize("name", MADE)
def test_pages_of_other_makes(name):
    assert extraction.main_text(f"{HEAD}<body>{MADE[name]}").split("\n") == WANT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<script>only()", ""), ("<", "<"), ("just text &amp; more", "just text & more"),
        ("<p>a&nbsp;b\n\tc<br>d</p>", "a b c d"), ("<p>&#65;&lt;b&gt;&eacute;&nix;</p>", "A<b>é&nix;"),
        ("<p>one</p><p>one</p>", "one\none"), ("</div></p></article>x", "x"), ("<a b='<p>'>t", "t"),
    ],
)
def test_awkward_pages(page, want):
    assert extraction.main_text(page) == want


def test_whole_of_a_long_page_and_deep_nesting():
    lines = [f"line number {i} of a very long page" for i in range(20_000)]
    page = "<div>" * 3000 + "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"
    assert extraction.main_text(page).split("\n") == lines


def test_frames(spark, nothing):
    rows = [(1, None, "x"), (None, "<article><p>Text.</p></article>", None), (None, "<article><p>Text.</p></article>", None), (2, "", "y")]
    made = extraction.extract(spark.createDataFrame(rows, "page_id LONG, html STRING, _text STRING"))
    got = sorted((str(r["__rest"]["page_id"]), r["_text"], r["_n_blocks"], str(r["__rest"]["_text"])) for r in made.collect())
    assert got == [("1", "", 0, "x"), ("2", "", 0, "y"), ("None", "Text.", 1, "None"), ("None", "Text.", 1, "None")]
    assert extraction.extract(nothing, "text").collect() == []
