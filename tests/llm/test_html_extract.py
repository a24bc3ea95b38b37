import html as entities
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from siltline.llm import html_extract
from siltline.llm.html_extract import main_text

SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar no-ads-page">
<header id="top"><h1>Site name</h1><nav><a href=/>Home</a></nav></header><div id="wrap">
<div class="sidebar"><p>Side text about nothing, long enough to look like content if one only counts.</p></div>
<div id="content"><h2>Title</h2><p>One long paragraph with <a href=x>a link</a> &amp; more&nbsp;words, so that it
  is <b>well</b> above the rest.</p><p>On.</p><ul><li>first item<li>second   item</ul><table><tr><td>a<td>b</table>
<script>if (a < b) document.write("<p>no</p>")</script><!-- <p>no</p> --><div class="adBox ad"><p>Buy</p></div>
<p>Another long paragraph of the article that has many words to be counted &lt;here&gt;.<br>Next line</p>
<section id="comments"><p>Nice article, thank you for the many words that you have written here!</p></section></div></div>
<div class="cookie-notice">We use cookies</div><form><p>Mail</p><input><button>Send</button></form><footer>&copy; c</footer></body></html>"""
CONTENT = "\n".join([
    "Title", "One long paragraph with a link & more words, so that it is well above the rest.", "On.", "first item", "second item",
    "a", "b", "Another long paragraph of the article that has many words to be counted <here>. Next line",
])


def test_site_without_semantic_elements():
    assert main_text(SITE) == CONTENT


def test_article_keeps_short_lines_and_its_headings():
    page = ("<nav>Menu</nav><article><header><h1>Name</h1><p>by A</p></header><p>Go.</p><p>" + "word " * 60 +
            "<p>End<aside>Also</aside><footer>foot</footer></article><p>outside " + "text " * 50)
    assert main_text(page) == "Name\nGo.\n" + ("word " * 60).strip() + "\nEnd"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), (" \n ", ""), ("plain  text", "plain text"), ("<p>a<p", "a"), ("<div>a<!-- b", "a"), ("<p>a &am", "a &am"),
    ("<p>x &lt; y &#233;&eacute", "x < y éé"), ("</div></p>a</b>", "a"), ("<p hidden>a</p><p>b", "b"), ("<p>a<script>x", "a"),
    ("<p style='display: none'>a</p><p>b</p>", "b"), ("<b>a<p>b<i>c</p>d", "a\nbc\nd"), ("<div role=navigation>a</div>b", "b"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages():
    assert main_text("<p>" + "a b  " * 200_000) == ("a b " * 200_000).strip()
    assert main_text("<div>" * 3000 + "text" + "</div>" * 3000) == "text"
    assert main_text("<b>" * 3000 + "<p>x</p>" * 3000).count("x") == 3000


def test_table_holds_every_article_whole(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for row in pages.select("html", html_extract.extract(F.col("html")).alias("text")).collect():
        article = row.html.split("<article>")[1].split("</article>")[0]
        blocks = [entities.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))) for x in re.split("</?(?:p|h1)>", article)]
        assert row.text == "\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_column(spark):
    pages = spark.createDataFrame([(1, None), (2, SITE), (2, SITE), (None, "")], "page_id long, html string")
    got = pages.select(html_extract.extract(F.col("html")).alias("text")).collect()
    assert sorted(r.text for r in got) == ["", "", CONTENT, CONTENT]
    assert pages.where("false").select(html_extract.extract(F.col("html"))).count() == 0


LONG = "<p>" + "long text of the page, word by word " * 20


def lines_of(page):
    return main_text(page).split("\n")


def test_teasers_do_not_replace_the_text():
    teasers = "".join(f"<article><h3>Teaser {k}</h3><p>{'a few words to read on ' * 4}</article>" for k in range(3))
    assert lines_of(f"<main><div><h1>Title</h1>{LONG * 3}</div>{teasers}</main>")[:4] == ["Title", *[LONG[3:].strip()] * 3]
    assert lines_of(f"<div><h1>Title</h1>{LONG * 3}</div>{teasers}").count(LONG[3:].strip()) == 3


def test_article_in_several_parts():
    page = "".join(f"<article><h2>Part {k}</h2>{LONG}</article><p>between</p>" for k in range(4))
    assert lines_of(f"<div>{page}</div>") == [x for k in range(4) for x in (f"Part {k}", LONG[3:].strip())]
    page = f"<article>{LONG}{LONG}</article><article class=comment><p>{'nice words ' * 8}</article>"
    assert lines_of(page) == [LONG[3:].strip()] * 2


@pytest.mark.parametrize("name", ["content-with-sidebar", "comments-open", "widget", "banner-page", "share", "skip"])
def test_named_wrappers_of_the_page(name):
    side = "<div class=sidebar><p>side text</div>"
    want = ["Title", *[LONG[3:].strip()] * 2]
    assert lines_of(f"<div class='{name}'><h1>Title</h1>{LONG * 2}</p>{side}</div><p class=ad>Buy") == want
    assert lines_of(f"<span id={name}><h1>Title</h1>{LONG * 2}</span>") == want
    assert main_text(f"<p class={name}>One</p><p class={name}>Two</p>") == "One\nTwo"


def test_headings_with_names_of_their_own_stay():
    page = f"<article><h2 id='related-work'>Related work</h2>{LONG}</p><h2 id=login>Login</h2>{LONG}</p></article>"
    assert lines_of(page) == ["Related work", LONG[3:].strip(), "Login", LONG[3:].strip()]
    assert lines_of(f"<article>{LONG}</p><div class=related><h3>Related</h3><p>More</div></article>") == [LONG[3:].strip()]


def test_cut_of_an_unfinished_end():
    pattern = re.compile(r"<(?:[A-Za-z/][^<>]*|!--(?:(?!-->).)*|![^<>]*)\Z", re.S)
    r = random.Random(3)
    for _ in range(20_000):
        page = "".join(r.choice(["<", ">", "!", "--", "-", "a", "/", " ", "\n", "<!--", "-->"]) for _ in range(r.randint(0, 12)))
        assert html_extract._finished(page) == pattern.sub("", page), page
    begun = time.monotonic()
    assert main_text("<p>a</p>" + "<!-- b " * 150_000) == "a"
    assert time.monotonic() - begun < 5
