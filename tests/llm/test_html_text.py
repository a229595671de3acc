"""Page texts: articles as written, furniture left out."""

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthspan.llm import html_text
from monthspan.llm.html_text import main_text
from tests.llm.data import table

PROSE = "The first sentence, of some length, is here. A second one follows it; it ends now."
MORE = "Another paragraph goes on, with commas, and with more words than a menu has."


def plain(page):
    """The article of the given pages, whose markup is simple."""
    article = re.search("<article>(.*)</article>", page, re.S)[1]
    article = re.sub("</?b>", "", article.replace("<br>", " "))
    blocks = [" ".join(html.unescape(b).split()) for b in re.split("</?p>|</?h1>", article)]
    return "\n\n".join(filter(None, blocks))


def test_given_pages(spark):
    pages = {r["page_id"]: r for r in table(spark, "pages").collect()}
    for row in html_text.extract(table(spark, "pages")).collect():
        assert row["text"] == plain(pages[row["page_id"]]["html"])
        assert (row["url"], row["n_chars"]) == (pages[row["page_id"]]["url"], len(row["text"]))


@pytest.mark.parametrize(
    "furniture",
    [
        "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>News, of today.</a></li></ul></nav>",
        f"<header><p>{MORE}</p></header>",
        f"<footer><p>{MORE}</p></footer>",
        f"<aside><p>{MORE}</p></aside>",
        f"<div class='ad'><p>{MORE}</p></div>",
        f"<div id=sidebar-left><p>{MORE}</p></div>",
        f"<section class='reader-comments'><p>{MORE}</p><p>{MORE}</p></section>",
        f"<div class='cookie-notice' role='alert'>{MORE}</div>",
        f"<form action='/s'><label>{MORE}</label><input type=text><button>Go</button></form>",
        f"<script>if (a < b) document.write('<p>{MORE}</p>')</script>",
        f"<style>p:before {{ content: '<p>{MORE}' }}</style>",
        f"<!-- <p>{MORE}</p> -->",
        f"<template><p>{MORE}</p></template><noscript><p>{MORE}</p></noscript>",
    ],
)
@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div id='content'>%s</div>", "<main>%s</main>"])
def test_furniture_is_left_out(furniture, wrap):
    inside = wrap % f"<h1>Title</h1><p>{PROSE}</p><p>{MORE[::-1]}</p>"
    wanted = f"Title\n\n{PROSE}\n\n{MORE[::-1]}"
    assert main_text(f"<html><body>{furniture}{inside}</body></html>") == wanted
    assert main_text(f"<body>{inside}{furniture}</body>") == wanted


def test_furniture_inside_the_article_is_left_out():
    page = f"<article><p>{PROSE}</p><div class=share>Share this, now.</div><p>{MORE}</p></article>"
    assert main_text(page) == f"{PROSE}\n\n{MORE}"


@pytest.mark.parametrize(
    "other",
    [
        f"<article class='teaser'><h3>Next</h3><p>{MORE}</p></article>" * 3,
        f"<article class='reader-comment'><p>{MORE}</p></article>" * 3,
        f"<article id=comment-7 role=complementary><p>{MORE}</p></article>",
        f"<article><p><a href='/x'>{MORE}</a></p></article>" * 3,
    ],
)
def test_articles_beside_the_body(other):
    page = f"<body><div id=story><p>{PROSE}</p><p>{MORE[::-1]}</p></div>{other}</body>"
    assert main_text(page) == f"{PROSE}\n\n{MORE[::-1]}"


def test_a_body_beside_plain_articles_is_not_lost():
    page = f"<div><p>{PROSE} {MORE}</p><p>{PROSE}</p></div><article><p>Short one, too.</p></article>"
    assert main_text(page).startswith(f"{PROSE} {MORE}\n\n{PROSE}")


def test_unnamed_menus_in_main():
    menu = "<div><ul><li><a href='/'>Home</a></li><li><a href='/n'>News, of today.</a></li></ul></div>"
    assert main_text(f"<main>{menu}<h1>T</h1><p>{PROSE}</p></main>") == f"T\n\n{PROSE}"


def test_words_on_the_article_that_tell_its_topic():
    for words in ("post tag-social tags-share", "post no-comments category-ads", "hentry has-sidebar"):
        assert main_text(f"<article class='{words}'><p>{PROSE}</p></article>") == PROSE


@pytest.mark.parametrize(
    "opening",
    [
        "<div class='post tag-social'>",
        "<div class='has-sidebar content'>",
        "<div id='main' class='no-comments'>",
        "<section class='post-notice'>",
        "<div class='entry menu-open'>",
        "<div class='story follow-the-money'>",
        "<div class='sponsored'>",
    ],
)
@pytest.mark.parametrize("beside", ["", f"<nav>{MORE}</nav>", "<p><a href='/'>Home</a></p>"])
def test_a_body_with_a_class_like_furniture(opening, beside):
    close = opening[:4].replace("<", "</").rstrip() + ">" if opening.startswith("<div") else "</section>"
    page = f"<body>{beside}{opening}<p>{PROSE}</p><p>{MORE}</p>{close}<div id=site-footer><p>About us.</p></div></body>"
    assert main_text(page) == f"{PROSE}\n\n{MORE}"


@pytest.mark.parametrize(
    "words", ["comment-list", "commentList", "reader_comments", "sidebar-left", "ad", "site-footer", "related-links"]
)
def test_named_furniture_is_left_out_however_long(words):
    page = f"<div id=story><p>{PROSE}</p><p>{MORE}</p></div><div class='{words}'>" + f"<p>{PROSE} {MORE}</p>" * 40
    assert main_text(page) == f"{PROSE}\n\n{MORE}"


def test_scores_decide(monkeypatch):
    menu = "<div class=x><div><a href='/'>Home</a></div><div><a href='/n'>News, of today.</a></div></div>"
    named = f"<div class=related><p>{MORE}</p></div>"
    pages = [f"{menu}<div id=c><p>{PROSE}</p></div>", f"<div id=c><p>{PROSE}</p></div>{named}"]
    assert [main_text(page) for page in pages] == [PROSE, PROSE]
    monkeypatch.setattr(html_text, "SHARE", 0.0)
    assert all(main_text(page) != PROSE for page in pages)


def test_short_blocks_of_the_article_stay():
    page = f"<div id=c><h2>T</h2><p>{PROSE}</p><ul><li>one</li><li>two</li></ul><p>Yes.</p><p>{MORE}</p></div>"
    assert main_text(page) == f"T\n\n{PROSE}\n\none\n\ntwo\n\nYes.\n\n{MORE}"


def test_references_white_space_and_inline_elements():
    page = "<article><p> a&amp;b &lt;i&gt; &#233;&#x41;&nbsp;c\n\t d<b>e</b><i> f</i><br>g</p></article>"
    assert main_text(page) == "a&b <i> éA c de f g"


def test_broken_markup():
    assert main_text("<article><p><b>one<br><p>two</b></article><footer>no") == "one\n\ntwo"
    assert main_text("<p>only text &lt; here") == "only text < here"
    assert main_text("no markup, at all. a < b") == "no markup, at all. a < b"
    assert main_text('<p>a</p><x "unclosed') .startswith("a")
    assert main_text("") == main_text("<html></html>") == main_text("<script>x") == ""


@given(st.text(alphabet="<>/ap\"'=! -&;x\n", max_size=80))
@settings(max_examples=300, deadline=None)
def test_no_page_is_too_odd(page):
    assert isinstance(main_text(page), str)


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, path int"
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>Hi, you.</p>"), (2, "u", ""), (3, None, "<p>" * 5000)]
    rows.append((4, "u", "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"))
    found = html_text.extract(spark.createDataFrame([(*r, None, None, None) for r in rows], schema)).collect()
    texts = sorted((r["page_id"] or 0, r["text"]) for r in found)
    assert texts[:-1] == [(0, "Hi, you."), (1, ""), (1, ""), (2, ""), (3, "")]
    assert texts[-1][1] == "\n\n".join([PROSE] * 20_000)
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
