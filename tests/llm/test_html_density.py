"""The main text is found by density alone: on pages without telling tags, and on random trees against a plain version."""

from __future__ import annotations

import random
import re
from math import e, log

import pytest

from tallyboard.llm.html_text import main_text

WORDS = "river stone lamp garden window copper thread market harbour evening".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def tree(rng, depth):
    """(tag, children), where a child is a tree or a text."""
    tag = rng.choice(["div", "section", "ul", "p"]) if depth else "p"
    if tag == "p":
        return tag, [sentence(rng, rng.randint(1, 40)) if rng.random() < 0.7 else (rng.choice(["a", "b"]), [sentence(rng, rng.randint(1, 6))]) for _ in range(rng.randint(1, 3))]
    if tag == "ul":
        return tag, [("li", [("a", [sentence(rng, 2)]) if rng.random() < 0.6 else sentence(rng, rng.randint(1, 12))]) for _ in range(rng.randint(1, 5))]
    return tag, [tree(rng, depth - 1) for _ in range(rng.randint(1, 4))]


def html(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(html, node[1]))}</{node[0]}>"


def nodes(node):
    yield node
    for c in node[1]:
        if not isinstance(c, str):
            yield from nodes(c)


def text_of(node):
    return node if isinstance(node, str) else "".join(map(text_of, node[1]))


def size(text):
    return len("".join(text.split()))


def plainly(body):
    below = lambda n: list(nodes(n))[1:]
    inline = ("a", "b")
    linked = lambda n: size(text_of(n)) if n[0] == "a" else sum(linked(c) for c in n[1] if not isinstance(c, str))
    share = linked(body) / max(1, size(text_of(body)))

    def density(n):
        c, lc = size(text_of(n)), linked(n)
        if not c:
            return 0.0
        t = max(1, sum(x[0] != "b" for x in below(n)))
        lt = max(1, sum(x[0] == "a" for x in nodes(n)))
        base = log(c / max(1, c - lc) * lc + share * c + e)
        return c / t * max(0.0, log(c / max(1, lc) * t / lt) / (log(base) if base > 1 else 1))

    total = lambda n: sum(density(c) for c in n[1] if not isinstance(c, str) and c[0] not in inline)
    best = max(nodes(body), key=lambda n: total(n))
    path = [n for n in nodes(body) if any(x is best for x in nodes(n))]
    least = min(density(n) for n in path)
    out = []

    def menu(n):
        return n[0] not in inline and sum(x[0] == "a" for x in nodes(n)) > 1 and 0 < size(text_of(n)) == linked(n)

    def take(n, between=False):
        """A block of links alone is a menu, unless it stands between elements with other text."""
        if isinstance(n, str):
            out.append(n)
        elif n is body or between or not menu(n):
            edge = " " if n[0] not in inline else ""
            out.append(edge)
            other = [k for k, c in enumerate(n[1]) if not isinstance(c, str) and size(text_of(c)) > linked(c)]
            for k, c in enumerate(n[1]):
                take(c, bool(other) and other[0] < k < other[-1])
            out.append(edge)

    def walk(n):
        if n is best or (n[0] not in inline and all(n is not x for x in path) and density(n) >= least and density(n) > 0):
            above = next((m for m in nodes(body) if any(c is n for c in m[1])), ("", []))
            other = [k for k, c in enumerate(above[1]) if not isinstance(c, str) and size(text_of(c)) > linked(c)]
            here = next((k for k, c in enumerate(above[1]) if c is n), 0)
            out.append(" ")
            take(n, bool(other) and other[0] < here < other[-1])
            out.append(" ")
        else:
            for c in n[1]:
                if not isinstance(c, str):
                    walk(c)

    walk(body)
    return " ".join("".join(out).split())


def test_random_trees_equal_a_plain_version():
    rng, empty = random.Random(11), 0
    for _ in range(400):
        body = ("body", [tree(rng, 3) for _ in range(rng.randint(1, 4))])
        want = plainly(body)
        assert main_text(f"<html>{html(body)}</html>") == want, html(body)
        empty += not want
    assert empty < 40


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_articles_are_found_without_their_tags(spark, sf):
    for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect():
        assert main_text(re.sub(r"<(/?)(article|main)\b", r"<\1div", r.html)) == main_text(r.html), r.page_id


RNG = random.Random(3)
PARAS = [sentence(RNG, 40) for _ in range(6)]
ITEMS = [sentence(RNG, 15) for _ in range(12)]
MENU = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a></li>" for w in WORDS) + "</ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<div><div>" + MENU + "</div><div><div><div>" + "".join(f"<p>{p}</p>" for p in PARAS) + "</div></div></div></div>", PARAS),
        ("<body>" + MENU + "<div>" + "".join(f"<p>{p}" for p in PARAS) + "</div>" + MENU, PARAS),
        ("<body>" + MENU + "<div><ul>" + "".join(f"<li>{i}" for i in ITEMS) + "</ul></div><div>" + MENU + "</div>", ITEMS),
        ("<body><div><section>" + "".join(f"<p>{p}</p>" for p in PARAS[:3]) + "</section><section>" + "".join(f"<p>{p}</p>" for p in PARAS[3:]) + "</section></div>" + MENU, PARAS),
        ("<body><div><p><b>" + PARAS[0] + "<br>" + PARAS[1] + "</div>" + MENU, PARAS[:2]),
    ],
)
def test_nested_unclosed_and_list_heavy_pages(page, want):
    assert main_text(page) == " ".join(want)
