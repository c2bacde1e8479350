"""Pages keep their whole main text, however it is wrapped."""

from __future__ import annotations

import pytest

from tallyboard.llm.html_text import main_text

LONG = "Plain words of a long text. " * 30
MORE = "Other words of that text. " * 30


@pytest.mark.parametrize("tag", ["article", "main"])
def test_a_small_article_inside_does_not_replace_the_text(tag):
    html = f"<body><div class='content'><p>{LONG}</p><p>{MORE}</p><{tag} class='card'><p>One line.</p></{tag}></div></body>"
    assert main_text(html).startswith(LONG + MORE.strip())


@pytest.mark.parametrize("wrap", ["<body>{}</body>", "<body><div>{}</div></body>", "<body><main>{}</main></body>"])
def test_sibling_articles_are_all_kept(wrap):
    html = wrap.format(f"<article><p>{LONG}</p></article><article><p>{MORE}</p></article><article><p>{LONG}</p><p>{MORE}</p></article>")
    assert main_text(html) == (LONG + MORE + LONG + MORE).strip()
