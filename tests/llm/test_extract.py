import html
import re

import numpy as np
import pytest

from lodestat.llm import extract
from lodestat.llm.queries import QUERIES

BODY = "A long paragraph of the article that says something worth reading, with many words in it."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<br>b", "a b"), ("<p>x<b>y</b>z</p>", "xyz"),
    (f"<nav><a href=x>menu</a></nav><article><h1>T &amp; U</h1><p>{BODY}</p><p>Short.</p></article><footer>f</footer>", f"T & U {BODY} Short."),
    (f"<article><p>{BODY}<p>b<script>if (a < b) x('</p>')</script><style>p{{}}</style></article>", f"{BODY} b"),
    (f"<div class='cookie-notice'>We use cookies, please agree to all of them now</div><div id=main><p>{BODY}</p></div>", BODY),
    (f"<main><p>{BODY}</p><section id='comments'><p>{BODY} says a reader</p></section><form><input>send</form></main>", BODY),
    (f"<div class=ad>unclosed advert<article><p>{BODY}</p></article>", BODY),
    (f"<article><p>{BODY}</p><p>tail &lt;end&gt;&nbsp;here <a hre", f"{BODY} tail <end> here"),
    (f"<article><p>{BODY}</p><![weird[ x ]]></article>", BODY),
    ("<nav>only a menu</nav>", ""),
])
def test_pages(page, text):
    assert extract.main_text(page) == text


def test_ratio_finds_the_content_of_unmarked_pages():
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(12))
    page = f"<div class=top>{links}</div><div class=text><p>{BODY}</p><p>{BODY}</p><p>So.</p><p>{BODY}</p></div><div class=low>{links}</div>"
    assert extract.main_text(page) == f"{BODY} {BODY} So. {BODY}"


def test_smoothing_and_threshold():
    values = np.array([1.0, 1, 1, 90, 2, 90, 1, 1, 1])
    smooth = extract.smoothed(values)
    assert smooth[4] > extract.threshold(smooth) > smooth[0] and abs(extract.smoothed(np.ones(9)) - 1).max() < 1e-12


def plain(page):
    start, stop = page.find("<article>"), page.find("</article>")
    part = page[start + 9: stop if stop >= 0 else len(page)]
    tail = part.rfind("<")
    part = part[:tail] if stop < 0 and ">" not in part[tail:] else part
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", part))).split())


def test_query_equals_a_plain_reading(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    found = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in QUERIES["op7_main_texts"](spark, sf).collect()}
    assert found == {r["page_id"]: (r["url"], plain(r["html"]), len(plain(r["html"]))) for r in rows}


def test_edges(spark):
    rows = [(1, "u", f"<article>{BODY * 2000}</article>", "q"), (2, None, None, "q"), (2, None, None, "q"), (None, "v", "", "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract.extract(df).collect()
    assert sorted(r["n_chars"] for r in out) == [0, 0, 0, len(BODY) * 2000]
    assert extract.extract(df.where("1 = 0")).count() == 0


def test_all_containers_with_content_are_returned():
    sections = "".join(f"<div class=section><p>{x} {BODY}</p></div>" for x in ("One.", "Two, and it is the longest of the three.", "Three."))
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(12))
    assert extract.main_text(f"<div>{links}</div><div id=post>{sections}</div><div>{links}</div>") == (
        f"One. {BODY} Two, and it is the longest of the three. {BODY} Three. {BODY}")


@pytest.mark.parametrize("wrapper", ["main no-sidebar", "has-widgets", "noSidebar", "page with_comments", "widget", "sidebar-layout"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_a_wrapper_of_the_article_is_not_skipped(wrapper, tag):
    assert extract.main_text(f"<p>Top</p><div class='{wrapper}'><{tag}><p>{BODY}</p></{tag}></div>") == BODY


def test_cards_in_a_sidebar_stay_out():
    card = "<div class=sidebar><article><p>A card of another page.</p></article></div>"
    assert extract.main_text(f"<article><p>{BODY}</p></article>{card}") == BODY == extract.main_text(f"<div><p>{BODY}</p></div>{card}")


@pytest.mark.parametrize("strip", [("article",), ("article", "nav"), ("article", "nav", "class")])
def test_given_pages_without_their_marks(spark, sf, strip):
    """With the article, then the menu unmarked, the ratios choose the article's lines; an unmarked advert is prose by its ratio."""
    hits = []
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        page = re.sub(r"<(/?)(?:%s)>" % "|".join(strip), r"<\1div>", r["html"] or "")
        page = page.replace(' class="ad"', "") if "class" in strip else page
        found, text = extract.main_text(page), plain(r["html"] or "")
        hits.append(found.endswith(text) if "class" in strip else found == text)
    assert np.mean(hits) == 1 if strip == ("article",) else np.mean(hits) > 0.9


def test_constant_ratios_change_the_result(monkeypatch):
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(12))
    pages = [f"<div>{links}</div><div><p>{BODY}</p><p>{BODY}</p></div>", f"<article><p>{BODY}</p></article><div>{links}</div><div><p>{BODY * 3}</p></div>"]
    before = [extract.main_text(p) for p in pages]
    assert before[0] == f"{BODY} {BODY}" and "link" not in before[1]
    monkeypatch.setattr(extract, "ratios", lambda length, tags: np.ones(len(length)))
    assert extract.main_text(pages[0]) != before[0] and extract.main_text(pages[1]) != before[1]


@pytest.mark.parametrize("part, kept", [
    ("<p class='search-results'>Found text.</p>", True), ("<section id='related-work'><p>Found text.</p></section>", True),
    ("<p class='social-science'>Found text.</p>", True), ("<math><mi>Found text.</mi></math>", True), ("<object>Found text.</object>", True),
    ("<div class='share-buttons'>Found text.</div>", False), ("<div class='comment-list'><p>Found text.</p></div>", False),
    ("<aside>Found text.</aside>", False), ("<div class='cookie-notice'>Found text.</div>", False), ("<ul class=related><li>Found text.</ul>", False)])
def test_inside_an_article_only_plain_names_are_left_out(part, kept):
    assert extract.main_text(f"<article><p>{BODY}</p>{part}<p>{BODY}</p></article>") == (f"{BODY} Found text. {BODY}" if kept else f"{BODY} {BODY}")
