"""Pages whose layout words, markup or depth used to lose their article."""

import time

import pytest

from fundspark.llm import html_extract as H

LONG = "Long text of the article, sentence after sentence. " * 20
ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>Second part.</p><p>Third part.</p>"
WANT = f"Title {LONG.strip()} Second part. Third part."


def text_of(html):
    page = H.read_page(html)
    return H.text_under(page, H.candidate(page)[0]) or ""


@pytest.mark.parametrize(
    "around",
    [
        '<div class="content has-sidebar">{}<div class="sidebar"><p>Side text here.</p></div></div>',
        '<div class="page with-banner"><article>{}</article></div>',
        '<div class="widget">{}</div>', '<div id="alert-system">{}</div>', '<section class="main-widget">{}</section>',
        '<form id="aspnetForm"><div>{}</div></form>',
        '<div class="widget"><div class="page sidebar-left">{}</div><div class="comments"><p>Reader says so.</p></div></div>',
        "<svg viewBox='0 0 1 1'/>{}", "<select><option>One<option>Two {}", "<math/>{}", "<article><svg><path d='x'></svg>{}</article>",
        '<div class="share"><a href=x>Share</a></div>{}<div class="related"><p>Other story of the day.</p></div>',
    ],
)
def test_articles_are_not_lost(around):
    html = f"<html><body><nav><a href=/>Menu</a></nav>{around.format(ARTICLE)}<footer>Foot</footer></body></html>"
    assert text_of(html) == WANT


def test_marked_parts_stay_out():
    talk = "".join(f"<article><p>{LONG}</p></article>" for _ in range(5))
    assert text_of(f'<article>{ARTICLE}</article><div class="comments">{talk}</div>') == WANT
    assert text_of(f'<div class="cookie-banner"><p>We use them.</p></div><form><p>Name</p></form>{ARTICLE}') == WANT
    assert text_of('<form class="login"><p>Name</p><p>Word</p><p>Send</p></form>') == ""
    assert text_of('<div class="cookie-notice">We use them.</div>') == ""


def test_a_heading_of_the_article_is_kept():
    html = f'<div class="header">Site</div><article><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></article>'
    assert text_of(html) == f"Title {LONG.strip()}"


@pytest.mark.parametrize(
    "tag", ['<p title="x>', '<p title="5" tall">', "<p title='it's'>", '<p title="a > b">', "<p data-x=\"<b>\">", '<p a=b"c>', "<p / >"]
)
def test_odd_quotes_leave_no_markup(tag):
    assert text_of(f"<article>{tag}One two</p><p>Three</p></article>") == "One two Three"
    assert text_of(f'<article>{tag}One two</p><p>See <a href="y">this</a> and <a href="z">that</a>.</p></article>') == "One two See this and that."


@pytest.mark.parametrize("piece", ["<div>", "<div><p>x", "<ul><li>x", "<svg>", "<b></i>", "<select>", "<table><tr><td>x", '<p title="x>', "<article class=a>"])
def test_time_grows_in_step_with_depth(piece):
    def took(n):
        html = piece * n + f"<p>{LONG}"
        start = time.perf_counter()
        text_of(html)
        return time.perf_counter() - start

    took(1000)
    small, large = took(10_000), took(100_000)
    assert large < max(30 * small, 6.0), (small, large)
