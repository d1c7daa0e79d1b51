"""Extraction: markup cases, held-out pages, and exact marginals by enumeration."""

import itertools
import math

import pytest

from shelfwise.llm.html_extraction import STATES, Model, Page, main_text
from shelfwise.llm.html_pages import LABELLED, labelled_pages


@pytest.fixture(scope="module")
def model():
    return Model(LABELLED)


@pytest.mark.parametrize("page, text", [
    ('<body><nav><a href="/">Home</a></nav><article><h1>A  title</h1><p>One &amp; two,\n three&nbsp;&#233;.</p></article><footer>(c) x</footer></body>',
     "A title One & two, three é."),
    ('<div class="cookie-notice">We use cookies to follow you around, for long.</div><main><h1>T</h1><p>Some <b>bold</b>text<br>here.</p>'
     '<div class="advert">Buy this now</div><p>End.</p></main><section class="comments"><h2>Comments</h2><div class="comment"><p>I think this is a really good article.</p></div></section>',
     "T Some boldtext here. End."),
    ('<article><p>a<script>var x = "</p></article>";</script>b<style>p{}</style><!-- c > --></p><form><p>Your name</p><input></form></article><aside><p>Side</p></aside>', "ab"),
    ('<article><p title="a > b">quoted</p><p>unclosed<p>next</article>', "quoted unclosed next"),
    ("no markup &lt;here&gt;", "no markup <here>"),
    ("", ""), (None, ""), ("<nav><a href=x>only</a></nav>", ""), ("   ", ""), ("<!-- never closed <p>x</p>", ""),
])
def test_cases(model, page, text):
    assert model.extract(page) == text


def test_marginals_match_enumeration(model):
    page = Page('<nav><a href="/">Home</a></nav><div class="content"><h1>T</h1><p>Some words that end here.</p></div><footer>x</footer>')
    n = len(page.parent)
    mass, content = 0.0, [0.0] * n
    for y in itertools.product(STATES, repeat=n):
        if y[0] != 2:  # the root holds content
            continue
        log = sum(model.seen.get(s, [0, 0, 0])[y[i]] for i in range(n) for s in page.seen(i))
        log += sum(model.down.get(page.kind(i), model.down["other"])[y[page.parent[i]]][y[i]] for i in range(1, n))
        mass += math.exp(log)
        for i in range(n):
            content[i] += math.exp(log) * (y[i] == 1)
    assert model.marginals(page)[1:] == pytest.approx([c / mass for c in content[1:]], abs=1e-9)


def test_held_out_pages(model):
    wrong = runs = 0
    for source in labelled_pages(150, seed=5):
        page = Page(source)
        found = model.marginals(page)
        runs += len(page.runs)
        wrong += sum((found[b] > 0.5) != bool(page.mark[b]) for b, _ in page.runs)
    assert wrong < 0.03 * runs


def test_deep_and_long_pages(model):
    assert model.extract("<div>" * 3000 + "deep") in ("", "deep")
    long = "<article>" + "<p>many words stand in this paragraph.</p>" * 3000 + "</article>"
    assert len(model.extract(long)) == 3000 * 35 + 2999
    assert model.extract("<p " * 20000) is not None


def test_column(spark):
    rows = [(1, "<article><p>Text.</p></article>"), (1, "<article><p>Text.</p></article>"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    assert [r[0] for r in pages.select(main_text(pages.html)).collect()] == ["Text.", "Text.", ""]
    assert pages.limit(0).select(main_text(pages.html)).count() == 0


S = "The river had risen in the night and by morning the fields lay under water."


@pytest.mark.parametrize("page, text", [
    (f"<body>{S}</body>", S), (f"<body><section>{S}</section>", S), (f"<div>{S}</div>", S), (f"<div>{S}</div><div>{S}</div>", f"{S} {S}"),
    (f"<center>{S}</center>", S), (f"<pre>{S}</pre>", S), (f"<div>{S}<br>{S}</div>", f"{S} {S}"),
    (f"<html><head><title>T</title><h1>Heading</h1><p>{S}</p>", f"Heading {S}"), (f"<head><title>T</title>{S}<p>{S}", f"{S} {S}"),
    (f"<article><p>{S}<svg/> More.</p></article>", f"{S} More."), (f"<body><h1>Title</h1>{S}<br>{S}</body>", f"Title {S} {S}"),
    (f"Intro <b>x</b><p>{S}</p>", f"Intro x {S}"), ("<article><p>Seen <span style='display: none'>hidden</span>text.</p></article>", "Seen text."),
    (f"<body><nav><a href=/>Home</a></nav>{S}<footer>(c) x</footer></body>", S), ("<article><p>a < b <3</p></article>", "a < b <3"),
])
def test_pages_without_the_usual_elements(model, page, text):
    assert model.extract(page) == text


def test_held_out_pages_without_the_usual_elements(model):
    pages = labelled_pages(600, seed=41)[600:]
    wrong = runs = 0
    for source in pages:
        page = Page(source)
        found = model.marginals(page)
        runs += len(page.runs)
        wrong += sum((found[b] > 0.5) != bool(page.mark[b]) for b, _ in page.runs)
    assert len(pages) == 150 and wrong < 0.03 * runs


@pytest.mark.parametrize("start, unit", [("", "<a "), ("", '<a href="'), ("", '<a "x>"'), ("", "<b>"), ("", "</i>"), ("<script>", "</script "), ("", "<!--"),
                                         ("<ul>" + "<div>" * 20000, "<li></li>"), ("<b>" * 50000, "<p></p>"), ("<b>" * 50000, "</i>")])
def test_time_grows_with_the_page(model, start, unit):
    import time

    def seconds(size):
        began = time.process_time()
        Page(start + unit * (size // len(unit)) + "'")
        return time.process_time() - began

    seconds(10_000)
    assert seconds(1_000_000) < 10 and seconds(1_000_000) < 4 * seconds(500_000) + 0.5
