"""Pages without marked articles, with teasers, and with wrappers that are named after what they lack."""

import re

import duckdb
import pytest

from tallyroll.llm.html_text import main_text

SF = "/root/testdata/sf0.01"
TEXT = "word " * 60


# Pages without article or main


def test_a_long_block_does_not_decide_for_short_ones():
    page = f"<div><p>{'a' * 300}</p><div class=ad>x</div><p>{'b ' * 5000}</p><p>End.</p></div>"
    assert main_text(page) == " ".join(["a" * 300, *["b"] * 5000, "End."])
    page = f"<body><nav><a href=1>Home</a></nav><h1>Title</h1><div class=ad>Buy</div><p>{TEXT}</p><p><a href=2>Source</a></p></body>"
    assert main_text(page) == f"Title {TEXT}Source"


def test_given_pages_without_article_or_main():
    pages = duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()
    bare = [re.sub(r"<(/?)(?:article|main)\b", r"<\1div", p) for (p,) in pages]
    assert any(a != p for a, (p,) in zip(bare, pages, strict=True))
    assert [main_text(b) for b in bare] == [main_text(p) for (p,) in pages]


# Teasers


def test_articles_do_not_hide_text_outside_of_them():
    page = f"<div id=content><p>{TEXT}</p></div><article><h2><a href=1>More news</a></h2><p>Teaser.</p></article>"
    assert main_text(page).startswith(TEXT) and "Teaser." in main_text(page)


# Class names and elements that are left open


@pytest.mark.parametrize(
    "start", ["<div class='page has-sidebar'>", "<div class=content-sidebar-wrap>", "<div class=no-sidebar>", "<div class='widget-area'>",
              "<div data-id=menu data-role=banner>", "<div title='a class=ad'>"]
)
def test_wrappers_stay(start):
    assert main_text(f"<body>{start}<p>{TEXT}</p></div><div><p>{TEXT * 3}</p></div>") == (TEXT * 4).strip()


@pytest.mark.parametrize("name", ["sidebar", "ad-slot", "cookie-notice", "x share", "site_header", "comments-list"])
def test_boilerplate_goes(name):
    assert main_text(f"<div><p>{TEXT}</p><div class='{name}'><p>Some long words of something else.</p></div></div>") == TEXT.strip()


def test_elements_left_open_end_with_what_holds_them():
    assert main_text(f"<html><head><title>x</title><body><p>{TEXT}") == TEXT.strip()
    assert main_text(f"<ul><li class=share>Share<li>One of the items</ul><p>{TEXT}</p>") == f"One of the items {TEXT}".strip()
    assert main_text(f"<div><div><aside>Also</div><p>{TEXT}</p></div>") == TEXT.strip()
    assert TEXT.strip() in main_text(f"<body><aside>Also<p>{TEXT}</p></body>")
    assert main_text(f"<div class=sidebar><main><p>{TEXT}</p></main></div>") == TEXT.strip()
