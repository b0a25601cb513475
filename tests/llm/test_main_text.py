import time
from html.parser import HTMLParser
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from hearthstream.llm.main_text import INLINE, VOID, extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style></head><body>
<header><h1>Site name of the publisher</h1></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">Other</a></ul></nav>
<div class="cookie-notice">We use cookies to make this page better for all readers.</div>
<div class="layout"><aside class="sidebar"><p>Side text that is long enough to look like prose.</p></aside>
<article><header><h2>A title</h2></header><p>First &amp; longest paragraph of the article,
 with a <b>bold</b> word and a <a href="#x">link</a>.</p><div class="ad-slot"><div>Buy now</div> today</div>
<p>Short.</p><script>var x = "<p>no</p>";</script><ul><li>one<li>two</ul>
<form><p>Subscribe here for much more of this text</p><input></form>
<p>Last one&nbsp;here &#233;&eacute;.</article>
<section id="comments"><article class="comment"><p>A reader comment that is rather long as well.</p></article></section>
</div><footer>&copy; someone</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == (
        "A title First & longest paragraph of the article, with a bold word and a link. Short. "
        "one two Last one here éé."
    )


def test_without_an_article_element_density_decides():
    long = "This sentence is long enough to make the distribution surge at once. "
    page = (
        "<body><div><a href=a>Home</a> <a href=b>News</a></div><div>Menu</div>"
        f"<div><div>{long * 2}</div><div>Mid.</div><div>{long}</div></div>"
        "<div><a href=c>Imprint and contact of this site</a></div></body>"
    )
    got = main_text(page)
    assert got.startswith("This sentence") and "Mid." in got and got.endswith("at once.")
    assert "Imprint" not in got and "Home" not in got


LONG = "This sentence is long enough to make the distribution surge at once."


def test_linked_lines_of_an_article_without_an_element_are_kept():
    page = (
        f"<div><a href=a>Home</a></div><h1><a href=b>Title</a></h1><p>{LONG}</p>"
        f"<h2><a href=c>Part</a></h2><p>{LONG}</p><p><a href=d>See there</a></p>"
        + "".join(f"<li><a href=e>Item {k}</a></li>" for k in range(5))
        + f"<div class=ad>Buy</div><p>{LONG}</p><ul><li>one<li>two</ul><div><a href=f>Imprint</a></div>"
    )
    linked = ["See there", *(f"Item {k}" for k in range(5))]
    assert main_text(page) == " ".join(["Title", LONG, "Part", LONG, *linked, LONG, "one two"])
    near = f"<p>{LONG}</p><p><a href=d>See there</a></p><p>{LONG}</p>"
    assert main_text(near) == f"{LONG} See there {LONG}"


def test_short_articles_without_an_element_are_kept():
    page = "<div class=nav>Home of all the news</div><p>It rained.</p><p>Then not</p><footer>Us</footer>"
    assert main_text(page) == "It rained. Then not"
    assert main_text("<p>Hello world</p>") == "Hello world"


def test_degenerate_pages():
    assert main_text(None) == main_text("") == main_text("<html><body></body></html>") == ""
    assert main_text("<script>x") == main_text("<!-- open") == ""
    assert main_text("<article><p>unclosed <b>bold<p>next") == "unclosed bold next"
    assert main_text("a < b and c > d " * 10).startswith("a < b and c > d")
    assert len(main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000)) == 4


def test_frame_keeps_keys_and_repeats(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract_main_text(pages, ["page_id", "url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((r.page_id or 0, len(r.text), r.n_chars) for r in got.collect())
    n = len(main_text(PAGE))
    assert found == [(0, 0, 0), (1, n, n), (1, n, n), (2, 0, 0)]
    assert extract_main_text(pages.where("false"), ["page_id"]).count() == 0


BODY = "<article><p>Body text of the page.</p></article>"


def test_names_that_describe_the_page_do_not_hide_it():
    for names in ("has-sidebar", "single-comment", "no-comments", "page-with-header", "home nav-closed",
                  "js cookie-ok", "ad-free"):
        assert main_text(f'<html><body class="{names}">{BODY}</body></html>') == "Body text of the page.", names
        assert main_text(f'<body><div class="{names}">{BODY}</div></body>') == "Body text of the page.", names
    assert main_text('<article class="post-header-top"><p>Body text of the page.</p></article>') == "Body text of the page."
    assert main_text(f'<form id=aspnet><div class="header"><a href=x>Us</a></div>{BODY}</form>') == "Body text of the page."
    long = " ".join([LONG] * 3)
    assert main_text(f'<form><div class="has-sidebar"><p>{long}</p></div></form>') == long


def test_sections_of_an_article_stay_and_its_boxes_go():
    page = (
        f'<article><p>{LONG} {LONG}</p><section class="related-work"><p>Others did this.</p></section>'
        '<div class="share-of-market"><p>Half of it.</p></div>'
        '<div class="share-buttons"><a href=a>Tell</a> <a href=b>Send</a></div>'
        '<div class="site-notice"><p>Read this</p></div><div class="related"><a href=c>More of it</a></div>'
        f'<p>End.</p><div class="comments"><p>{LONG} {LONG} {LONG}</p></div></article>'
    )
    assert main_text(page) == f"{LONG} {LONG} Others did this. Half of it. End."


def test_short_first_paragraph_without_a_full_stop():
    assert main_text(f"<div><div>Menu</div><p>By the river</p><p>{LONG}</p></div>") == f"By the river {LONG}"


def test_broken_markup_takes_linear_time():
    began = time.process_time()
    size = 1_000_000
    for piece in ("<a ", '<p x="', "<div>", "</x>", "<span id=a>", '<p x=">', "<", "<!-", "<p><span class=ad>", "&amp", "<script>x</script>"):
        main_text(piece * (size // len(piece)))
    main_text("<p><div>" + "<span id=ad>" * 40_000 + "<p></p>" * 60_000)
    main_text("<div>" * 100_000 + "</p></section>" * 40_000)
    assert time.process_time() - began < 36


def simple_main_text(page):
    """The article of a page that marks it well: a tree by the standard parser, without windows or scores."""
    out, skip, inside, line = [], 0, 0, []

    class Reader(HTMLParser):
        def flush(self):
            text = " ".join("".join(line).split())
            if text:
                out.append(text)
            line.clear()

        def handle_starttag(self, tag, attrs):
            nonlocal skip, inside
            if tag not in INLINE:
                self.flush()
            skip += tag in ("script", "style", "nav", "footer") or bool(skip and tag not in VOID)
            inside += tag == "article"

        def handle_endtag(self, tag):
            nonlocal skip, inside
            if tag not in INLINE:
                self.flush()
            skip -= bool(skip)
            inside -= tag == "article"

        def handle_data(self, data):
            if inside and not skip:
                line.append(data)

    Reader().feed(page)
    return " ".join(out)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01/pages.parquet").exists(), reason="no data")
def test_given_pages_against_a_plain_reader():
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        assert main_text(page) == simple_main_text(page or "")
