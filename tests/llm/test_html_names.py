"""Pages whose names say what an article is about, marks around several articles, and deep nesting."""

import time

import pytest

from veilsift.llm import html_extract

WORDS = "several plain words of the text that stand in a block of their own"


def text_of(body: str) -> str:
    return html_extract.extract(f"<html><body><nav><a>home</a></nav>{body}<footer>footer words here</footer></body></html>", html_extract.PRIOR)


@pytest.mark.parametrize(
    "part",
    [
        '<div id="banner-history"><p>{}</p></div>', '<div class="sponsor-interview"><p>{}</p></div>', '<div class="ad-hoc-networks"><p>{}</p></div>',
        '<section class="pagination-tips"><p>{}</p></section>', '<section id="cookies"><h3>{}</h3></section>', "<menu><li>{}</li></menu>",
        '<div class="navigation-of-ships">{}</div>', '<h2 id="related">{}</h2>',
    ],
)
def test_names_of_topics_stay(part):
    got = text_of(f"<article><p>first {WORDS}</p>{part.format('inner ' + WORDS)}<p>last {WORDS}</p></article>")
    assert got == f"first {WORDS}\ninner {WORDS}\nlast {WORDS}"


@pytest.mark.parametrize(
    "part",
    [
        '<div class="ad">{}</div>', '<div class="ad-slot top">{}</div>', '<div id="cookie-consent-banner">{}</div>', '<aside>{}</aside>', '<div class="newsletter-signup">{}</div>',
        '<div class="related-posts">{}</div>', '<ul class="share-buttons">{}</ul>', '<div class="comments-list">{}</div>', '<form>{}</form>', '<div role="navigation">{}</div>',
    ],
)
def test_names_of_frames_go(part):
    got = text_of(f"<article><p>first {WORDS}</p>{part.format('inner ' + WORDS)}<p>last {WORDS}</p></article>")
    assert got == f"first {WORDS}\nlast {WORDS}"


def test_menu_outside_of_an_article_frames():
    assert text_of(f"<menu><li>{WORDS}</li></menu><article><p>first {WORDS}</p></article>") == f"first {WORDS}"


def test_words_between_articles_end_no_run():
    between = " ".join(f"w{i}" for i in range(120))
    got = text_of(f"<article><p>first {WORDS}</p></article><p>{between}</p><article><p>second {WORDS}</p></article>").split("\n")
    assert got[0] == f"first {WORDS}" and got[-1] == f"second {WORDS}"


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 200_000 + "words", ("<b>" * 100_000) + "x</i>" * 100_000, "<p>" + "<b>" * 100_000 + "<div></div>" * 100_000, "<div>" * 100_000 + "x<br>" * 100_000,
        "<a>" * 100_000 + "x<i></i>" * 50_000, "</div>" * 200_000,
    ],
)
def test_time_grows_with_the_page_not_its_depth(page):
    start = time.time()
    html_extract.extract(page, html_extract.PRIOR)
    assert time.time() - start < 6


def test_sample_is_bounded_without_ids(spark, monkeypatch):
    pages = spark.createDataFrame([(None, f"<article><p>page {i} {WORDS}</p></article><p>other {i}</p>") for i in range(400)], "page_id long, html string")
    seen = []
    monkeypatch.setattr(html_extract, "weights", lambda a, b: seen.append(a["words", ""]) or {})
    html_extract.fit(pages, train_pages=100)
    assert 50 * 15 < seen[0] < 150 * 15
