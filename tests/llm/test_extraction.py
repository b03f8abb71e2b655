"""Main text of pages of several layouts."""

import time

import pytest
from pyspark.sql import functions as F

from solvind.llm.extraction import extract_pages, host, main_text, votes
from solvind.llm.queries import on_workers

MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News &amp; more</a></li></ul></nav>'


def page(kind, k):
    text = [f"Paragraph {i} of page {k} &amp; its <b>bold</b>  words, long enough to count." for i in range(3)]
    if kind == "article":
        body = f'<div class="ad">Buy now {k}</div><article><h1>Title {k}</h1><p>{"<p>".join(text)}<script>var t="</p>";</script></article>'
        plain = f"Title {k} " + " ".join(text)
    elif kind == "divs":
        paragraphs = "".join(f"<p>{x}</p>" for x in text)
        body = f'<div id="main"><div class="post-{k} body">{paragraphs}</div><div class="comments"><p>{"I like this very much. " * 40}</p></div></div>'
        plain = " ".join(text)
    else:
        body = f'<table><tr><td class="left"><ul><li>One<li>Two</ul></td><td class="text">{"<br>".join(text)}<form><p>Your name</p></form></td></tr></table>'
        plain = " ".join(text)
    source = f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><!-- c -->{MENU}<header>Site</header>'
    source += f'{body}<aside><p>See also this and that</p></aside><div class="cookie-notice">We use cookies</div><footer>&copy; Site</footer></body></html>'
    return source, " ".join(plain.replace("&amp;", "&").replace("<b>", "").replace("</b>", "").split())


def test_pages_of_three_hosts(spark):
    on_workers(spark)
    rows, wanted = [], {}
    for kind_number, kind in enumerate(("article", "divs", "table")):
        for k in range(20):
            source, wanted[100 * kind_number + k] = page(kind, k)
            rows.append((100 * kind_number + k, f"https://user@www.{kind}.example:80/x?{k}", source, "h", "p"))
    found = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, host string, paths string")).collect()
    assert {row.page_id: row.text for row in found} == wanted
    assert all(row.n_chars == len(row.text) and row.url for row in found)


def test_hosts_outvote_a_page(spark):
    """A page with little text of its own and a long unmarked box is read as its host's other pages are."""
    on_workers(spark)
    rows = [(k, "http://h/x", page("divs", k)[0]) for k in range(10)]
    rows.append((50, "http://h/y", f'<html><body><div id="main"><div class="post-9 body"><p>Short.</p></div></div><div class="box"><p>{"spam " * 90}</p></div></body></html>'))
    found = {row.page_id: row.text for row in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[50] == "Short."


def test_odd_pages(spark):
    on_workers(spark)
    sources = [None, "", "   ", "plain text &lt;3", "<p>open<div>other", "<", "<<p>>x</p>", "</div></p>x", '<a href="x>y">z</a>', "<!-- never closed <p>x", "<script>x", "<p>" * 3000 + "deep", "x" * 300_000]
    rows = [(k, None if k % 2 else "no host", source) for k, source in enumerate(sources)] + [(0, None, None)]
    found = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {row.page_id: row.text for row in found}
    assert len(found) == len(rows) and None not in texts.values()
    assert texts[0] == texts[1] == texts[2] == "" and texts[3] == "plain text <3" and texts[4] == "open other" and texts[11] == "deep" and len(texts[12]) == 300_000
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_votes_and_hosts(spark):
    assert votes("") == [] and abs(sum(share for _, share in votes(page("divs", 1)[0])) - 1) < 1e-9
    assert main_text("<p>a &eacute;&#x41;&nbsp;b</p>", []) == "a éA b"
    urls = ["HTTP://A.b:8/x", "//c.d/x", "e.f/x", None, "https://u:p@g.h?x", "https://[::1]/"]
    found = [row[0] for row in spark.createDataFrame([(u,) for u in urls], "u string").select(host(F.col("u"))).collect()]
    assert found[:5] == ["a.b", "c.d", "", "", "g.h"]


def test_captions_formulas_and_media_stay():
    source = "<article><p>Before.</p><figure><img src=x><figcaption>The caption.</figcaption></figure><p>Be <math><mi>a</mi><mspace class='ad'/><mo>=</mo><mn>2</mn></math> so.</p>"
    source += "<audio controls><p>Spoken words.</p></audio><video><p>Moving pictures.</p></video></article>"
    assert main_text(source, []) == "Before. The caption. Be a=2 so. Spoken words. Moving pictures."


def test_elements_without_end_tag_do_not_take_the_article():
    for opened in ('<svg class="icon" />', "<math/>", "<svg>", "<canvas>", "<datalist><option value=1><option value=2></datalist>", "<svg/><svg><text>no</text></svg>"):
        assert main_text(f"<article><p>One {opened} two.</p><p>Three.</p></article>", []) == "One two. Three.", opened
    assert main_text("<p>Kept.</p><script>var lost", []) == "Kept."


def test_rare_layouts_of_a_large_host(spark):
    """What a page's text is does not depend on how many other layouts its host has."""
    on_workers(spark)
    name = lambda k: "".join("abcdefghij"[int(d)] for d in str(k))
    part = lambda k, i: f'<div class="{name(k)}"><p>Part {name(i)} of page {name(k)}, long enough to count.</p></div>'
    rows = [(k, "http://h/x", f"<html><body>{''.join(f'<section id={name(k)}>{part(k, i)}</section>' for i in range(3))}</body></html>") for k in range(120)]
    for some in (rows[:5], rows):
        found = {row.page_id: row.text for row in extract_pages(spark.createDataFrame(some, "page_id long, url string, html string")).collect()}
        for k, _, _ in some:
            assert found[k] == " ".join(f"Part {name(i)} of page {name(k)}, long enough to count." for i in range(3))


def test_headings_and_second_containers():
    page = '<body><article><header><h1>Title</h1><p>12 May</p></header><h2 class="section-header">Part</h2><p>Some long text of it.</p></article></body>'
    assert main_text(page, ["/body/article"]) == "Title Part Some long text of it."
    page = '<body><div class="lead">First.</div><div class="text">Then.<div class="in">Inner.</div></div><div class="x">Else.</div></body>'
    paths = ["/body/div.text", "/body/div.lead", "/body", "/body/div.text/div.in", "/body/div.x"]
    assert main_text(page, paths, 4) == "First. Then. Inner."
    assert main_text(page, paths, 1) == "Then. Inner."


@pytest.mark.parametrize("tags", ["<div>x", "<span>x", "<div class=a>x<p>", "<ul><li>x"])
def test_deep_pages(tags):
    """Unclosed tags cost what their number does, not its square."""
    started = time.perf_counter()
    assert main_text(tags * 20_000, []).count("x") > 0
    assert time.perf_counter() - started < 20
