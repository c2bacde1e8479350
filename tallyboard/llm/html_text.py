"""The main text of web pages, by composite text density (operator 7).

A page is parsed once into elements in page order. Script, style, form, navigation, footer, aside,
hidden and commented parts, and elements whose class, id or role names such a part,
take no part in the rest (a name that only says how the page is laid out does not count: such an
element holds an article or most of the text, or stands within `article` or `main` and is
neither mostly links nor small beside its siblings, which holds anywhere for words that name subjects too, such as `legal`; nor do
such names where without them no text is left). The time is linear in the length of a page, however it is broken.
For every other element the density is its characters per tag, where tags of formatting
within a line do not count, adjusted for links:

    C / T * log(C / LC * T / LT, base ln(C / (C - LC) * LC + LCb / Cb * C + e))

with C characters, T tags, LC and LT those in links, and LCb, Cb those of the body; zeros
count as one. The density sum of an element adds the densities of the blocks among its children. The element of the
largest sum holds the main text. The least density on the path from the body to it is the
threshold at which a block beside the path is text too, such as a title above the
container of the paragraphs. Where that element is within `article` or `main`, or these within it
hold most of its text, the page itself says how far the text reaches: the one around it is taken with the
articles beside it that reach the threshold, or all those within it that do. Elsewhere,
blocks that hold nothing but several links are menus and stay out, but for lists that stand between other text.

Within what is taken nothing is dropped: character references are decoded, white space in
a block becomes one space, blocks are joined by one space in page order.

Defined results: null and empty pages, and pages without text, have an empty text; tags that are
not closed end where their parents end; an end tag that was not opened is ignored; repeated
rows give repeated results; further columns are not read. A page is the unit of work.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm import bytearrays as B

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>|</?[a-zA-Z][^<>]*\Z""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![^\s/])(hidden)(?![^\s/>])""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: What may run to the end of a page without a `>`.
_OPEN_ENDED = ("<!--", "<![CDATA[")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_NOISE_TAGS = frozenset(
    "script style noscript template svg math iframe object embed canvas audio video map nav footer aside fieldset button select textarea input option datalist dialog menu head title noframes xmp".split()
)
_NOISE_ROLES = frozenset("navigation contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tooltip status".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos promotion banner banners cookie cookies consent gdpr privacy "
    "notice notices notification notifications alert alerts popup modal overlay lightbox newsletter subscribe subscription signup signin login register paywall "
    "sidebar sidebars rail related recommended recommendation recommendations teaser teasers trending popular share sharing social "
    "nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs crumbs pagination pager toolbar topbar footer copyright disclaimer legal "
    "comment comments commentlist disqus replies reply respond discussion reactions search searchbox searchform form skip skiplink toc".split()
)
#: Words that name a part by how they begin or end.
_NOISE_STARTS = ("advert", "adsby", "adslot", "adunit", "adbox", "breadcrumb", "cookie", "disqus", "newsletter", "sidebar", "sponsor")
_NOISE_ENDS = ("advert", "banner", "breadcrumbs", "comments", "footer", "menu", "nav", "navbar", "notice", "sidebar")
#: Parts that are noise however long they are; the others may also name the layout of a whole page.
_NEVER_TEXT = ("ad", "comment", "cookie", "consent", "disqus", "gdpr", "notice", "popup", "modal", "repl", "discussion", "sponsor")
#: Words of layout that name subjects as well: they decide only where a part is full of links or small.
_TOPICS = frozenset("legal privacy copyright disclaimer register rail social share sharing search form popular trending alert alerts notification notifications subscription promotion promotions banner related reactions skip toc".split())
_HEADERS = frozenset("masthead header".split())
#: An element named as noise that holds this share of the page's text names its layout; articles that hold this share of an element's are its text.
_MOST = 0.6
#: Within an article, and anywhere for names of subjects, a name of layout makes noise of what has this share of its text in links, or less than that share of its largest sibling's text.
_LINKED, _SMALL = 0.5, 0.25
#: What opening the key closes first, up to the nearest of the given elements.
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
_LIMITS = frozenset("table td th article section div body main aside nav footer header button object".split())
_TEXT_ROOTS = ("article", "main")


def _weight(word: str) -> int:
    """How surely a word names noise."""
    return 2 if word.startswith(_NEVER_TEXT) else int(word not in _TOPICS)


class _Page:
    """Elements in page order as parallel lists; an element's descendants follow it up to `end`."""

    def __init__(self, html: str):
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.end: list[int] = [0]
        self.noise: list[bool] = [False]
        #: Elements that are noise by a name only; decided when the page is read. False, or the name.
        self.named: list[str | bool] = [False]
        #: (element, text) in page order; a text of None is the edge of a block.
        self.parts: list[tuple[int, str | None]] = []
        self.stack = [0]
        #: Where in the stack the open elements of each name are.
        self.open: dict[str, list[int]] = defaultdict(list)
        self._parse(html)
        while self.stack:
            self.end[self.stack.pop()] = len(self.tag)
        self._judge_names()

    def _judge_names(self) -> None:
        """A name makes noise, unless the element holds an article, or most of the page or a fair part of an article under a name of layout."""
        n = len(self.tag)
        roots = [t in _TEXT_ROOTS and not self.named[i] and not self.noise[i] for i, t in enumerate(self.tag)]
        chars, linked, texts, largest, within = [0] * n, [0] * n, roots[:], [0] * n, roots[:]
        for i, text in self.parts:
            if text is not None and not self.noise[i]:
                chars[i] += len(text)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if self.tag[i] == "a":
                linked[i] = chars[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            texts[p] = texts[p] or texts[i]
            largest[p] = max(largest[p], chars[i])
        layout = []
        for i in range(1, n):
            name, p = self.named[i], self.parent[i]
            within[i] = within[i] or within[p]
            if name and not texts[i]:
                if name.startswith(_NEVER_TEXT):
                    self.noise[i] = True
                elif linked[i] > _LINKED * chars[i] or chars[i] < (_SMALL * largest[p] if within[p] or name in _TOPICS else _MOST * chars[0]):
                    layout.append(i)
        own = self.noise[:]
        for i in layout:
            self.noise[i] = True
        self._spread()
        if layout and not self._has_text():
            self.noise = own
            self._spread()

    def _spread(self) -> None:
        for i in range(1, len(self.tag)):
            self.noise[i] = self.noise[i] or self.noise[self.parent[i]]

    def _has_text(self) -> bool:
        return any(t and not self.noise[i] and not t.isspace() for i, t in self.parts)

    def _parse(self, html: str) -> None:
        at, n, last = 0, len(html), html.rfind(">")
        while at < n:
            # After the last `>` nothing is a tag but what runs to the end of the page, which begins at the last `<`.
            start = at if at <= last else max(at, html.rfind("<")) if not html.startswith(_OPEN_ENDED, html.find("<", at)) else at
            m = _TOKEN.search(html, start)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at : m.start()])
            at, name = m.end(), m[2]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if m[1]:
                self._close(name)
                continue
            self._open(name, m[3] or "")
            if name in _RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                stop = close.start() if close else n
                if name not in _NOISE_TAGS:
                    self._text(html[at:stop])
                at = stop
            elif name in _VOID:
                self._pop()

    def _text(self, raw: str) -> None:
        self.parts.append((self.stack[-1], unescape(raw) if "&" in raw else raw))

    def _edge(self, name: str) -> None:
        if name not in _INLINE:
            self.parts.append((self.stack[-1], None))

    def _push(self, name: str) -> None:
        self.open[name].append(len(self.stack))
        self.stack.append(len(self.tag) - 1)

    def _pop(self) -> None:
        element = self.stack.pop()
        self.open[self.tag[element]].pop()
        self.end[element] = len(self.tag)

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._pop()

    def _close_until(self, names: tuple[str, ...] | frozenset, limits) -> None:
        """Closes the outermost of `names` that is open inside the nearest of `limits`."""
        limit = max((self.open[x][-1] for x in limits if self.open[x]), default=0)
        inside = [own[k] for own in (self.open[x] for x in names) if (k := bisect_right(own, limit)) < len(own)]
        if inside:
            self._pop_to(min(inside))

    def _open(self, name: str, attributes: str) -> None:
        if name in _CLOSES_P:
            self._close_until(("p",), _LIMITS)
        elif name in _SIBLINGS:
            self._close_until(*_SIBLINGS[name])
        self._edge(name)
        above = self.stack[-1]
        self.tag.append(name)
        self.parent.append(above)
        self.end.append(0)
        hard, soft = self._is_noise(name, attributes)
        self.noise.append(self.noise[above] or name in _NOISE_TAGS or hard)
        self.named.append(soft)
        self._push(name)

    def _close(self, name: str) -> None:
        self._edge(name)
        if self.open[name]:
            self._pop_to(self.open[name][-1])
        if name in _VOID:
            return
        self._edge(name)

    def _within(self, names) -> bool:
        return any(self.open[x] for x in names)

    def _is_noise(self, name: str, attributes: str) -> tuple[bool, str | bool]:
        """Whether an element is noise for certain, and the name that says so if it is by name."""
        header, found = name == "header", "form" if name == "form" else False
        whole = name in ("html", "body", *_TEXT_ROOTS)
        for key, a, b, c, bare in _ATTRIBUTE.findall(attributes) if attributes else ():
            if bare:
                return not whole, found
            key, value = key.lower(), a or b or c
            if key in ("class", "id") and (not whole or name == "article"):
                words = {w.lower() for w in _WORDS.findall(value)} | set(re.findall("[a-z]+", value.lower()))
                for w in sorted(words):
                    if w in _NOISE_WORDS or w.startswith(_NOISE_STARTS) or w.endswith(_NOISE_ENDS):
                        if not whole or w.startswith(_NEVER_TEXT) or w.startswith(("teaser", "related")):
                            found = max(found, w, key=_weight) if found else w
                header = header or bool(words & _HEADERS)
            elif key == "role" and not whole:
                if value.lower() in _NOISE_ROLES:
                    return True, found
                header = header or value.lower() == "banner"
            elif key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return not whole, found
        return header and not whole and not self._within(_TEXT_ROOTS), found


def _densities(page: _Page, root: int) -> tuple[list[int], list[float], list[float], list[int]]:
    """Characters, density and density sum of every element, and the elements that hold nothing but several links."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in page.parts:
        if text is not None and not page.noise[i]:
            chars[i] += len("".join(text.split()))
    for i in range(n - 1, 0, -1):
        if page.noise[i]:
            continue
        if page.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
        p = page.parent[i]
        chars[p] += chars[i]
        tags[p] += tags[i] + (page.tag[i] == "a" or page.tag[i] not in _INLINE)
        link_chars[p] += link_chars[i]
        link_tags[p] += link_tags[i]
    share = link_chars[root] / max(1, chars[root])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c = chars[i]
        if c and not page.noise[i]:
            t, lc, lt = max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
            base = log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + e)
            density[i] = c / t * max(0.0, log(c / lc * t / lt) / log(base)) if base > 1 else c / t * max(0.0, log(c / lc * t / lt))
            if page.parent[i] >= 0 and page.tag[i] not in _INLINE:
                total[page.parent[i]] += density[i]
    # A block of links alone is a menu, unless it stands between blocks with other text: then it is a list of the text.
    first, last = [n] * n, [0] * n
    for i in range(1, n):
        if chars[i] > link_chars[i]:
            p = page.parent[i]
            first[p], last[p] = min(first[p], i), i
    alone = (i for i in range(root + 1, n) if link_tags[i] > 1 and page.tag[i] not in _INLINE and 0 < chars[i] == link_chars[i])
    menus = [i for i in alone if not first[page.parent[i]] < i < last[page.parent[i]]]
    return chars, density, total, menus


def _chosen(page: _Page) -> tuple[list[int], list[int]]:
    """Elements whose subtrees make the main text, none within another, and menus to leave out of them."""
    n = len(page.tag)
    root = next((i for i in range(n) if page.tag[i] == "body"), 0)
    chars, density, total, menus = _densities(page, root)
    best = max(range(root, page.end[root]), key=lambda i: (total[i], -i))
    path, i = [best], best
    while i != root and i > 0:
        i = page.parent[i]
        path.append(i)
    threshold = min(density[i] for i in path)
    for name in _TEXT_ROOTS:
        above, i = None, best
        while i > 0:
            above, i = (i if page.tag[i] == name else above), page.parent[i]
        if above is not None:
            beside = [i for i in range(root, page.end[root]) if page.tag[i] == name and page.parent[i] == page.parent[above] and not page.noise[i]]
            return [i for i in beside if i == above or density[i] >= threshold], []
        inside, i = [], best + 1
        while i < page.end[best]:
            if page.noise[i] or page.tag[i] == name:
                if not page.noise[i]:
                    inside.append(i)
                i = page.end[i]
            else:
                i += 1
        inside = [i for i in inside if density[i] >= threshold]
        if inside and sum(chars[i] for i in inside) >= _MOST * chars[best]:
            return inside, []
    taken, i = [], root
    on_path = set(path)
    while i < page.end[root]:
        if i == best or (i not in on_path and not page.noise[i] and page.tag[i] not in _INLINE and density[i] >= threshold and density[i] > 0):
            taken.append(i)
            i = page.end[i]
        elif i in on_path or not page.noise[i]:
            i += 1
        else:
            i = page.end[i]
    return taken, menus


def main_text(html: str) -> str:
    if not html:
        return ""
    page = _Page(html)
    inside = [False] * len(page.tag)
    taken, menus = _chosen(page)
    for elements, keep in ((taken, True), (menus, False)):
        for i in elements:
            inside[i : page.end[i]] = [keep] * (page.end[i] - i)
    return " ".join("".join(" " if t is None else t for i, t in page.parts if inside[i] and not page.noise[i]).split())


def _run(batches):
    for batch in batches:
        for part in B.chunks(batch, "html"):
            texts = [main_text(h.decode()) for h in B.row_bytes(part.column("html"))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names[:-1]), pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: id, url and the main text."""
    base = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias(url_col), F.col(html_col).alias("html"))
    schema = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in (id_col, url_col))
    return base.mapInArrow(_run, f"{schema}, text string")
