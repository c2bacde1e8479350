"""Pages that are hard to read take time by their length, and a name or a list of links loses no text."""

from __future__ import annotations

import time

import pytest

from tallyboard.llm.html_text import main_text

N = 100_000
HARD = {
    "open tags": "<a " * N, "names not open": "<b>" * N + "x</i>" * N, "paragraphs in spans": "<span>" * N + "<p>x</p>" * N, "open quotes": '<a x="' * N, "open declarations": "<!" * N, "open markers": "<" * N,
    "comments": "<!--" * N, "headers": "<header>" * N, "items": "<ul><li>" * N, "items beyond a limit": "<li><ul>" + "<span>" * N + "<li>x" * N, "a tag at the end": "<a " * N + ">", "sections": "<![CDATA[" * N, "scripts": "<script>" * N,
}


@pytest.mark.parametrize("name", list(HARD))
def test_time_by_length(name):
    began = time.process_time()
    main_text(HARD[name])
    whole = time.process_time() - began
    assert whole < 6, whole


def test_a_name_of_a_subject_loses_no_text():
    page = "<html><body><div class='post'><p>{0} one</p><div class='legal-analysis'><p>{0} two</p></div><div class='privacy'><p>{0} three</p></div><div class='legal'>terms</div></div></body></html>"
    words = "The court held that the sale was void and the buyer had to be paid back in full."
    assert main_text(page.format(words)) == f"{words} one {words} two {words} three"
    footed = page.replace("class='privacy'", "class='privacy footer'")
    assert main_text(footed.format(words)) == f"{words} one {words} two"


def test_a_list_of_links_between_paragraphs_stays():
    words = "A paragraph of some length about the things that the list beneath it names, in order."
    links = "<ul><li><a href='a'>First thing</a></li><li><a href='b'>Second thing</a></li></ul>"
    assert main_text(f"<body><div class='post'><p>{words}</p>{links}<p>{words}</p></div></body>") == f"{words} First thing Second thing {words}"
    assert main_text(f"<body><div class='post'>{links}<p>{words}</p><p>{words}</p></div></body>") == f"{words} {words}"


def test_what_follows_the_last_tag():
    assert main_text("<p>one</p> two < three <b") == "one two < three"
    assert main_text("<p>one</p> two <!-- three") == "one two"
    assert main_text("no tags < at all") == "no tags < at all"
