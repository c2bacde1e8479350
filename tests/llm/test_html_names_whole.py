"""Names of layout do not take the text of a page."""

from __future__ import annotations

import pytest

from tallyboard.llm.html_text import main_text

LONG = "Plain words of a long text. " * 30
MORE = "Other words of that text. " * 30


def block(names: str, text: str) -> str:
    return f"<div class='{names}'><p>{text}</p></div>"


@pytest.mark.parametrize("outer", ["article", "main", "div"])
@pytest.mark.parametrize("names", ["elementor-widget elementor-widget-text-editor", "widget", "social-story", "legal", "promotion"])
def test_blocks_of_a_page_builder_are_text(outer, names):
    html = f"<body><{outer}>{block(names, LONG)}{block(names, MORE)}{block(names, LONG)}</{outer}></body>"
    assert main_text(html) == (LONG + MORE + LONG).strip()


def test_names_of_layout_still_make_noise_of_small_and_linked_parts():
    html = f"<article><p>{LONG}</p><div class='share'>Share this</div><div class='related'>" + "<a href='x'>Some other piece of text to read</a> " * 30 + "</div></article>"
    assert main_text(html) == LONG.strip()
    assert main_text(f"<body><div class='sidebar'>{MORE}</div><div><p>{LONG}</p><p>{LONG}</p></div></body>") == (LONG + LONG).strip()
