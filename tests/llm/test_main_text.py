"""Main text: whole texts against the marked articles of the test pages, and pages made for single rules."""

from __future__ import annotations

import html
import re

import pytest

from statlas.llm import htmltext

BREAKS = re.compile(r"<(?:/?(?:p|h[1-6]|br|li|ul|ol|div|blockquote))(?:\s[^>]*)?/?>")


def article(page: str) -> str:
    """The text of the page's article element, block by block, without looking for it."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*(>|\Z)", "", x))).strip() for x in BREAKS.split(inner))
    return " ".join(x for x in parts if x)


def test_whole_texts_of_marked_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for page_id, page in pages.items():
        assert htmltext.main_text(page) == article(page), page_id
        bare = re.sub("</?article>", lambda m: m[0].replace("article", "div"), page)
        assert htmltext.main_text(bare).endswith(article(page)[-40:]), page_id


LONG = "Words of a sentence, and more of them. " * 6


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><svg-icon></svg-icon><style-guide></style-guide><p>A, b. C.</p></article>", "A, b. C."),
        (f"<article><header><h1>Head</h1></header><p>{LONG}</p></article>", f"Head {LONG}"),
        (f"<header><p>{LONG}</p></header><article><p>{LONG}</p></article>", LONG),
        (f'<article><section id="discussion"><h2 id="related-work">Related work</h2><p class="search term">{LONG}</p></section></article>', f"Related work {LONG}"),
        (f'<article><div class="entry-header"><h3 id=menu>Menu</h3></div><div class="ad-hoc">Made ad hoc, here.</div><p>{LONG}</p></article>', f"Menu Made ad hoc, here. {LONG}"),
        (f'<article><p>{LONG}</p><div class="junk">Buy now</div></article><div class="junk">Buy now</div>', LONG),
        (f'<article><p>{LONG}</p><div class="site-ad box"><p>{LONG}</p></div><section id="comments"><p>{LONG}</p></section></article>', LONG),
        (f"<article><p>{LONG}</p><ul><li>One</li><li><a href=/x>Two</a></li></ul><table><tr><td>3</td><td>4</td></tr></table></article>", f"{LONG} One Two 3 4"),
        (f"<div><p>{LONG}</p><section><p>{LONG}{LONG}</p></section><section><p>{LONG}</p></section></div>", f"{LONG} {LONG}{LONG} {LONG}"),
        (f"<main><section><p>{LONG}</p></section><article><p>{LONG}{LONG}</p></article></main>", f"{LONG} {LONG}{LONG}"),
        (f"<div><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><p>{LONG}</p><h2>Next</h2><p>{LONG}</p></div>", f"{LONG} Next {LONG}"),
        ("<div><a href=/a>Home</a></div>", "Home"),
        ("<script>x</script><nav><p>A, b.</p></nav>", ""),
    ],
)
def test_rules(page, text):
    assert htmltext.main_text(page) == re.sub(r"\s+", " ", text).strip()


def test_very_long_and_deep_pages():
    many = "<p>One, two. Three.</p>" * 30_000
    assert len(htmltext.main_text(f"<article>{many}</article>").split()) == 90_000
    assert htmltext.main_text("<div>" * 3_000 + "<p>One, two. Three.</p>") == "One, two. Three."


def test_no_rows_and_other_columns(spark):
    pages = spark.createDataFrame([(1, None, None, "a"), (1, None, None, "a"), (None, "u", "<p>A, b.</p>", "c")], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text) for r in htmltext.extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, None, ""), (1, None, ""), (None, "u", "A, b.")], key=str)
    assert htmltext.extract(pages.where("false")).count() == 0
