"""Main text of pages; the cut against all labellings."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from tests.compare import difference
from wardscope.llm import catalog
from wardscope.llm.html import extract, main_text, minimum_cut


@pytest.mark.parametrize("seed", range(60))
def test_cut_against_all_labellings(seed):
    draw = random.Random(seed)
    n = draw.randint(1, 9)
    costs = [draw.choice([-3, -1.5, -0.5, 0, 0.4, 1, 2.5]) + draw.random() / 100 for _ in range(n)]
    edges = [(a, b, draw.choice([0.3, 1.0, 2.0])) for a in range(n) for b in range(a) if draw.random() < 0.5]

    def price(labels):
        return sum(-c if not k and c > 0 else 0 for c, k in zip(costs, labels)) * -1 + sum(-c for c, k in zip(costs, labels) if k and c < 0) + sum(
            c for a, b, c in edges if labels[a] != labels[b])
    best = min(map(price, itertools.product([False, True], repeat=n)))
    assert price(minimum_cut(costs, edges)) == pytest.approx(best)


PROSE = "It was a long day by the sea and nobody wanted to go home before the boats came in."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<", "<") if False else ("<p", ""), ("<script>var a = '<p>no</p>'</script>", ""),
    (f"<body><nav><a href=/>Home</a> <a href=/x>News</a></nav><header><h2>Site</h2></header><article><h1>Title &amp; more</h1><p>{PROSE}<p>a&nbsp;b<br>c\n\n d"
     f"</article><aside><p>{PROSE}</p></aside><footer>&copy; us</footer>", f"Title & more\n{PROSE}\na b c d"),
    (f"<div class='cookie-notice'><p>{PROSE}</p></div><div id=main><h1>Head</h1><p>{PROSE}</p><ul><li>one thing to keep in mind here</li></ul></div>"
     f"<form><p>{PROSE}</p></form><section id=comments><article class=comment><p>{PROSE}</p></article></section>", f"Head\n{PROSE}\none thing to keep in mind here"),
    (f"<main><p>{PROSE}</p><div class='ad-box'>Buy now</div><p>{PROSE}</p><div class=related><ul><li><a href=1>Other story</a></ul></div></main>", f"{PROSE}\n{PROSE}"),
    (f"<article><header class=article-header><h1>Name</h1></header><p>{PROSE} <a href=x>with a link</a></p><p>x.</p></article>", f"Name\n{PROSE} with a link\nx."),
    (f"<title>No</title><style>p{{}}</style><!-- <p>no</p> --><body><p>{PROSE}<div><p>Second one of it.", f"{PROSE}\nSecond one of it.")])
def test_pages(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("opening, closing", [
    ("<article class='post hentry category-social'>", "</article>"), ("<div id=content class='with-sidebar'>", "</div>"),
    ("<main class='main-content has-sidebar'>", "</main>"), ("<article class='entry no-comments'>", "</article>"),
    ("<article class='post tag-legal'>", "</article>"), ("<article class='post comments-open'>", "</article>"), ("<div class='post-body hasSidebar'>", "</div>"), ("<svg><path d=x><article>", "</article>"),
    ("<article><title>x<p>", "</article>"), ("<div><noscript><p>js</p></div><article>", "</article>"),
    ("<template><div><template><p>no</p></template><p>no</p></div></template><article>", "</article>")])
def test_articles_stay(opening, closing):
    page = f"{opening}<p>{PROSE}</p><p>{PROSE}</p>{closing}<div class='left-sidebar'><p>{PROSE}</p></div><div class=site-footer><p>{PROSE}</p></div>"
    assert main_text(page) == f"{PROSE}\n{PROSE}"


@pytest.mark.parametrize("opening", ["<div class='post-comments'>", "<div id=cookie-notice>", "<div class='widget-area'>", "<article class='comment byuser'>",
                                     "<div class='main-menu'>", "<section class=relatedPosts>", "<noscript>", "<div class='newsletter-signup has-image'>"])
def test_what_stands_beside_goes(opening):
    assert main_text(f"<article><p>{PROSE}</p></article>{opening}<p>{PROSE}</p>") == PROSE


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</p>" * 100_000, "<svg>" + "<div>" * 100_000 + "</p>" * 100_000,
                                  "<noscript>" + "<div>" * 100_000 + "</p></div>" * 100_000])
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    assert main_text(page + f"<article><p>{PROSE}</p></article>" if not page.startswith("<nos") else page) in (PROSE, "")
    assert time.perf_counter() - start < 10


def test_query_matches_sql(spark, duck, small):
    assert difference(spark, duck, small, catalog.QUERIES["op5_main_text"], catalog.ORACLES["op5_main_text"]) is None


def test_columns_and_long_pages(spark):
    page = "<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>"
    frame = spark.createDataFrame([(1, page, "x"), (1, page, "x"), (2, None, "y")], "page_id long, html string, text string")
    rows = sorted(extract(frame).collect())
    assert [r.page_id for r in rows] == [1, 1, 2] and rows[0].n_chars == 5000 * (len(PROSE) + 1) - 1 and rows[2].text == ""
    assert extract(frame.limit(0)).collect() == []
