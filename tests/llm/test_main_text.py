"""Main text: path scores against a plain version, pages without markup of their content, odd markup."""

import math

import pytest
from pyspark.sql import functions as F

from lakehouse_kpis.llm import html_text
from lakehouse_kpis.llm.html_text import main_text

ARTICLE = "<article><h1>Head</h1><p>A first, long sentence; it goes on.</p>{}</article>"
PROSE = "Head A first, long sentence; it goes on."


def plain_scores(found):
    """Scores by their definition, block by block, over paths as numbers."""
    def ratio(path):
        own = [b for b in found if b.path == path]
        length = sum(max(len(b.text) - b.linked, 0) for b in own) / len(own)
        marks = sum(sum(c in ".,;:!?…、。，．！？¿¡" for c in b.text) + 0.5 for b in own) / len(own)
        return math.sqrt(length * marks)

    def smoothed(i):
        near = [(math.exp(-0.5 * (j - i) ** 2), ratio(found[j].path))
                for j in range(len(found)) if abs(j - i) <= 2]
        return sum(w * r for w, r in near) / sum(w for w, _ in near)

    scores = {}
    for path in {b.path for b in found}:
        at = [i for i, b in enumerate(found) if b.path == path]
        scores[path] = sum(smoothed(i) for i in at) / len(at)
    return scores


def test_path_scores_equal_the_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = [r["html"] for r in pages.select(F.col("html").cast("string").alias("html")).collect()]
    pages.append("<div><p>One, two.</p><ul><li><a>x</a><li>y, z.</ul><p>Three.</p></div><div>Four</div>")
    for page in pages:
        found = html_text.read_page(page or "").blocks
        want = plain_scores(found)
        got = html_text.path_scores(found)
        assert got.keys() == want.keys()
        assert all(got[p] == pytest.approx(want[p]) for p in want)


@pytest.mark.parametrize("name", [
    "share-prices", "login-security", "widget-theory", "related-work", "post-header", "entry-header",
    "no-sidebar",
])
def test_a_name_that_only_speaks_of_a_marked_word_stays(name):
    for marked in (f"<p class='{name}'>Second, short.</p>", f"<div id={name}><p>Second, short.</p></div>"):
        assert main_text(ARTICLE.format(marked)) == f"{PROSE} Second, short."


@pytest.mark.parametrize("name", [
    "share-buttons", "related-posts", "comment-list", "comments", "cookieNotice", "newsletter",
    "sidebar-right", "site-header", "ad-slot-2", "login_form",
])
def test_a_name_that_marks_something_else_goes(name):
    assert main_text(ARTICLE.format(f"<div class='{name}'><p>Nice, read; yes.</p></div>")) == PROSE


def test_markup_of_any_depth():
    nested = "<div>" * 3000
    assert main_text(f"{nested}<nav>Menu</nav>{ARTICLE.format('')}") == PROSE
    assert main_text("<b><i>" * 20_000 + "<p>One, two." + "<ul>" + "<li><div>" * 5000 + "Three, four.") == (
        "One, two. Three, four.")


def test_a_list_of_links_in_the_article_stays():
    works = "<ul><li><a href=1>Work one</a></li><li><a href=2>Work two</a></li></ul>"
    assert main_text(works + ARTICLE.format(works) + works) == f"{PROSE} Work one Work two"


def test_forms():
    search = "<form><label>Search, all of it: </label><input></form>"
    assert main_text(f"<body>{search}{ARTICLE.format(search)}") == PROSE
    assert main_text(f"<form id=page>{ARTICLE.format('')}<div class=comments>Nice, read.</div></form>") == PROSE
    prose = "<div><div><p>A first, long sentence; it goes on.</p><p>Second, one.</p></div></div>"
    assert main_text(f"<body><form>{prose}</form><div>Site</div>") == (
        "A first, long sentence; it goes on. Second, one.")
    assert main_text(f"<body>{search}<div>{prose}</div>") == "A first, long sentence; it goes on. Second, one."


def test_comments_as_articles_go():
    comment = "<article class=comment><p>Nice, read; really.</p></article>"
    assert main_text(f"<main>{ARTICLE.format('')}{comment}</main>") == PROSE
    assert main_text(ARTICLE.format(comment)) == PROSE


def test_pages_without_article():
    menu = "<ul class=m><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul>"
    text = "".join(f"<p>Sentence {i}, of a text; with marks, and length.</p>" for i in range(6))
    page = f"<body><div class=top>{menu}</div><div><div class=t>{text}<p>Short</p></div></div><div>Rights</div>"
    want = " ".join(f"Sentence {i}, of a text; with marks, and length." for i in range(6)) + " Short"
    assert main_text(page) == want


def test_odd_rows(spark):
    """Repeated rows, a clashing column, a very long page, nulls."""
    long = ARTICLE.format("<p>Word, word.</p>" * 50_000)
    rows = [(1, "u", "<p>One, two.", "x"), (1, "u", "<p>One, two.", "x"), (None, None, None, None), (2, "u", long, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extracted(pages.withColumn("n_chars", F.lit("z"))).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [
        (0, 0), (1, 9), (1, 9), (2, len(PROSE) + 50_000 * len(" Word, word."))]
