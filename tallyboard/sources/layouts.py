"""HTML boards as tables of bids.

Pages are cut into tokens with positions, tokens become rows, and what a later row inherits from an
earlier one (commodity, column map, banner) is a window over the page order. Only two steps are
Python: slicing nested tables, and evaluating the grid feed's offset statements.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.functions.numbers import basis_to_cents, parse_eighths, parse_num, parse_ticks, round_half_up, round_to, strict_money, tick_flag
from tallyboard.functions.text import WORD_END, WORD_START, clean, host, squeeze, strip_tags, title_case
from tallyboard.operators.changes import first_or_better
from tallyboard.sources.feeds import BIDS, Feed, _refused

# Headings of columns, in the order in which a heading is tried.
COLUMN_WORDS = {
    "basis": "basis",
    "change": "change|chg|net\\s*chg|net",
    "futures_month": "futures\\s*month|contract\\s*month|board\\s*month",
    "futures": "futures|board|month\\s*symbol|symbol",
    "last_trade": "last\\s*trade",
    "delivery": "delivery|deliv|shipment|ship|period|movement|month|time\\s*frame",
    "cash": "cash|bid|price|net\\s*price|cash\\s*price",
    "commodity": "commodity|grain|product|crop",
    "location": "location|elevator|facility|plant|branch|site|city|terminal",
    "updated": "updated|as\\s*of|time",
}
# Fixed value: labels that are no section.
JUNK_LABEL = "(?i)^(commodity|cash bids?|prices?|delivery|basis|futures|change)$"
LOOK_BEHIND, HEADER_ROWS = 4000, 6


def map_header(cells: Column) -> Column:
    """map of column name to position, or null for a row that heads no bids: each heading takes the first free name it matches."""
    start = F.struct(F.lit(0).alias("i"), F.create_map().cast("map<string,int>").alias("m"))

    def step(s: Column, cell: Column) -> Column:
        free = lambda name: ~F.map_contains_key(s["m"], F.lit(name))
        name = F.coalesce(*(F.when(free(n) & cell.rlike(f"(?i){WORD_START}({w}){WORD_END}"), F.lit(n)) for n, w in COLUMN_WORDS.items()))
        grown = F.when(name.isNotNull(), F.map_concat(s["m"], F.create_map(name, s["i"]))).otherwise(s["m"])
        return F.struct((s["i"] + 1).alias("i"), grown.alias("m"))

    found = F.aggregate(cells, start, step, lambda s: s["m"])
    has = lambda n: F.map_contains_key(found, F.lit(n))
    return F.when((has("cash") | has("basis")) & (has("commodity") | has("delivery")), found)


def _cell(name: str) -> Column:
    return F.coalesce(F.get("cells", F.element_at("map", name)), F.lit(""))


def _items(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<li{WORD_END}[^>]*>(.*?)</li>"), 1), strip_tags)


def last_heading(before: Column) -> Column:
    """The last heading of a text, else its last caption."""
    last = lambda p: F.nullif(strip_tags(F.element_at(F.regexp_extract_all(before, F.lit(p), 1), -1)), F.lit(""))
    return F.coalesce(last(rf"(?is)<h[1-6]{WORD_END}[^>]*>(.*?)</h[1-6]>"), last(rf"(?is)<caption{WORD_END}[^>]*>(.*?)</caption>"))


def location_names(bodies: DataFrame) -> DataFrame:
    """source_id, location_id, name from a page's links; the first of an id wins."""
    link = r"""(?i)cashbidssingle-([0-9]+)['"]?\s*>\s*([^<]{1,60})<"""
    both = F.arrays_zip(F.regexp_extract_all("body", F.lit(link), 1).alias("id"), F.regexp_extract_all("body", F.lit(link), 2).alias("name"))
    found = bodies.select("source_id", F.posexplode(both).alias("n", "x")).select("source_id", "n", F.col("x.id").alias("location_id"), strip_tags(F.col("x.name")).alias("name"))
    return found.where("name <> ''").groupBy("source_id", "location_id").agg(F.min_by("name", "n").alias("name"))


def list_layout(bodies: DataFrame) -> DataFrame:
    """Headings, header lists and data lists, in page order."""
    heading = rf"<h3{WORD_END}[^>]*>.*?</h3>"
    head = rf"""<ul{WORD_END}[^>]*class=["'][^"']*fcControlsSubHdr[^"']*["'][^>]*>.*?</ul>"""
    data = rf"""<ul{WORD_END}[^>]*class=["'][^"']*fcControls[0-9][^"']*["'][^>]*>.*?</ul>"""
    tokens = bodies.select("source_id", F.col("url").alias("source"), F.posexplode(F.regexp_extract_all("body", F.lit(f"(?is){heading}|{head}|{data}"), 0)).alias("n", "token"))
    kind = F.when(F.col("token").rlike("(?i)^<h3"), "heading").when(F.col("token").rlike(f"(?is)^{head}"), "head").otherwise("data")
    title = strip_tags(F.col("token"))
    marked = tokens.withColumn("kind", kind).withColumns(
        {
            "_title": F.when((F.col("kind") == "heading") & (title != "") & (F.length(title) < 40), title_case(title)),
            "_head": F.when(F.col("kind") == "head", F.struct(map_header(_items(F.col("token"))).alias("map"))),
        }
    )
    so_far = Window.partitionBy("source_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    filled = marked.withColumns({"commodity": F.last("_title", True).over(so_far), "map": F.last("_head", True).over(so_far)["map"]})
    rows = filled.where("kind = 'data' and map is not null").withColumn("cells", _items(F.col("token")))
    location_id = F.nullif(F.regexp_extract("token", "(?i)CashBidsLocationID=([0-9]+)", 1), F.lit(""))
    named = rows.withColumn("location_id", location_id).join(location_names(bodies), ["source_id", "location_id"], "left")
    priced = named.withColumns({"cash": parse_num(_cell("cash")), "basis": parse_num(_cell("basis"))}).where("cash is not null or basis is not null")
    nonempty = lambda c: F.nullif(c, F.lit(""))
    return priced.select(
        "source_id",
        (F.row_number().over(Window.partitionBy("source_id").orderBy("n")) - 1).alias("seq"),
        "source",
        "location_id",
        clean(F.coalesce("name", F.concat(F.lit("location "), F.coalesce("location_id", F.lit("unknown"))))).alias("location"),
        clean(F.coalesce("commodity", F.lit("unknown"))).alias("commodity"),
        clean(F.coalesce(nonempty(_cell("delivery")), nonempty(_cell("futures_month")), F.lit("spot"))).alias("delivery"),
        "cash",
        "basis",
        basis_to_cents(F.col("basis"), _cell("basis")).alias("basis_cents"),
        F.coalesce(nonempty(clean(_cell("futures_month"))), nonempty(clean(_cell("futures")))).alias("futures"),
        parse_ticks(_cell("futures")).alias("futures_price"),
        nonempty(clean(_cell("last_trade"))).alias("futures_at"),
        tick_flag(_cell("futures")).alias("futures_flag"),
        parse_ticks(_cell("change")).alias("change"),
    )


# ---------------------------------------------------------------- tables

_MARK = re.compile(r"<(/?)(table|tr|t[hd])\b([^>]*)>", re.I)
_SPAN = re.compile(r'colspan\s*=\s*"?(\d+)', re.I)
_TABLES = "source_id string, source string, place int, row int, cells array<struct<html:string,header:boolean,colspan:int>>, before string"


def slice_tables(html: str) -> list[tuple[int, list[list[tuple[str, bool, int]]]]]:
    """Start and rows of cells (html, is header, colspan) of every closed table, nested ones by themselves.

    One pass over the tags with a stack of open tables. A table holds its finished rows, the open row
    and the open cell; a nested table leaves a space in the cell around it. Unclosed tables, rows and
    cells are not there.
    """
    done, stack = [], []
    for m in _MARK.finditer(html):
        closing, name = m[1] == "/", m[2].lower()
        top = stack[-1] if stack else None
        if name == "table":
            if not closing:
                if m[0].endswith("/>"):
                    continue
                if top and top["cell"]:
                    top["cell"]["parts"].append(html[top["cell"]["at"] : m.start()])
                stack.append({"start": m.start(), "rows": [], "row": None, "cell": None})
            elif top:
                stack.pop()
                done.append((top["start"], [r for r in top["rows"] if r]))
                if stack and stack[-1]["cell"]:
                    stack[-1]["cell"]["parts"].append(" ")
                    stack[-1]["cell"]["at"] = m.end()
        elif top is None:
            continue
        elif name == "tr":
            if not closing and top["row"] is None:
                top["row"] = []
            elif closing and top["row"] is not None:
                top["rows"].append(top["row"])
                top["row"] = top["cell"] = None
        elif top["row"] is not None:
            cell = top["cell"]
            if not closing and cell is None:
                span = _SPAN.search(m[3])
                top["cell"] = {"name": name, "at": m.end(), "parts": [], "span": int(span[1]) if span else 1}
            elif closing and cell and cell["name"] == name:
                text = "".join(cell["parts"]) + html[cell["at"] : m.start()]
                top["row"].append((text, name == "th", cell["span"]))
                top["cell"] = None
    return sorted(done)


def _slice(batches):
    for batch in batches:
        out: list[dict] = []
        for source_id, url, body in zip(*(batch.column(c).to_pylist() for c in ("source_id", "url", "body"))):
            for place, (start, rows) in enumerate(slice_tables(body or "")):
                before = body[max(0, start - LOOK_BEHIND) : start]
                for k, cells in enumerate(rows):
                    listed = [{"html": h, "header": head, "colspan": span} for h, head, span in cells]
                    out.append({"source_id": source_id, "source": url, "place": place, "row": k, "cells": listed, "before": before if k == 0 else None})
        yield pa.RecordBatch.from_pylist(out, schema=_TABLE_SCHEMA)


_TABLE_SCHEMA = pa.schema(
    [
        ("source_id", pa.string()),
        ("source", pa.string()),
        ("place", pa.int32()),
        ("row", pa.int32()),
        ("cells", pa.list_(pa.struct([("html", pa.string()), ("header", pa.bool_()), ("colspan", pa.int32())]))),
        ("before", pa.string()),
    ]
)


def table_rows(bodies: DataFrame) -> DataFrame:
    """Rows of all tables of all pages: place of the table, row, cells as texts, header flags and spans, heading before the table."""
    sliced = bodies.select(F.col("source_id").cast("string"), "url", "body").mapInArrow(_slice, _TABLES)
    table = Window.partitionBy("source_id", "place")
    rows = sliced.withColumns(
        {
            "heading": F.max(last_heading(F.col("before"))).over(table),
            "texts": F.transform("cells", lambda c: strip_tags(c["html"])),
            "n_rows": F.count("*").over(table),
        }
    )
    return rows.select(
        "source_id", "source", "place", "row", F.col("texts").alias("cells"), F.forall("cells", lambda c: c["header"]).alias("all_headers"), F.get("cells", F.lit(0))["colspan"].alias("first_span"), "heading", "n_rows"
    )


def describe_tables(bodies: DataFrame) -> DataFrame:
    """One row per table: rows, heading, header cells and how they map."""
    rows = table_rows(bodies).withColumn("map", map_header(F.col("cells")))
    first = F.min(F.when(F.col("map").isNotNull(), F.struct("row", F.col("cells"))))
    return rows.groupBy("source_id", "place").agg(F.max("n_rows").alias("rows"), F.max("heading").alias("heading"), first["cells"].alias("header_cells"))


def table_layout(bodies: DataFrame) -> DataFrame:
    """Tables whose first rows hold a heading; spanned rows are banners, which name locations if there are two at least."""
    rows = table_rows(bodies).where("n_rows >= 2")
    table = Window.partitionBy("source_id", "place")
    header = F.min(F.when((F.col("row") < HEADER_ROWS) & F.col("_map").isNotNull(), F.struct("row", F.size("cells").alias("width"), F.map_entries("_map").alias("m")))).over(table)
    headed = rows.withColumn("_map", map_header(F.col("cells"))).withColumn("_h", header).where("row > _h.row").withColumn("map", F.map_from_entries("_h.m"))
    spanned = (F.size("cells") == 1) | (F.col("first_span") >= F.col("_h.width"))
    label = F.trim(F.array_join("cells", " "))
    so_far = table.orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    banner = F.when(F.col("_spanned") & (label != "") & ~label.rlike(JUNK_LABEL) & (F.length(label) < 120), label)
    filled = headed.withColumn("_spanned", spanned).withColumns(
        {"_banners": F.count_if(F.col("_spanned") & (label != "")).over(table), "section": F.last(banner, True).over(so_far)}
    )
    data = filled.where("not _spanned and size(cells) >= 2 and not all_headers").withColumns({"cash": parse_num(_cell("cash")), "basis": parse_num(_cell("basis"))})
    nonempty = lambda c: F.nullif(c, F.lit(""))
    place = F.coalesce(nonempty(_cell("location")), F.when(F.col("_banners") >= 2, F.col("section")), F.col("heading"), F.col("section"), host(F.col("source")), F.lit("unknown"))
    bids = data.where("cash is not null or basis is not null").select(
        "source_id",
        (F.row_number().over(Window.partitionBy("source_id").orderBy("place", "row")) - 1).alias("seq"),
        "source",
        F.lit(None).cast("string").alias("location_id"),
        clean(place).alias("location"),
        clean(F.coalesce(nonempty(_cell("commodity")), F.col("section"), F.lit("unknown"))).alias("commodity"),
        clean(F.coalesce(nonempty(_cell("delivery")), nonempty(_cell("futures")), F.lit("spot"))).alias("delivery"),
        "cash",
        "basis",
        basis_to_cents(F.col("basis"), _cell("basis")).alias("basis_cents"),
        F.coalesce(nonempty(clean(_cell("futures_month"))), nonempty(clean(_cell("futures")))).alias("futures"),
        F.when(F.map_contains_key("map", F.lit("futures_month")), parse_ticks(_cell("futures"))).alias("futures_price"),
        nonempty(clean(_cell("last_trade"))).alias("futures_at"),
        tick_flag(_cell("futures")).alias("futures_flag"),
        parse_num(_cell("change")).alias("change"),
    )
    return _one_per_key(bids)


def _one_per_key(bids: DataFrame) -> DataFrame:
    held = first_or_better(bids, ["source_id", "location", "commodity", "delivery"], "seq", ["cash", "basis"])
    order = Window.partitionBy("source_id").orderBy("place")
    return held.withColumn("seq", (F.row_number().over(order) - 1).cast("int")).select(*BIDS)


def list_and_table(bodies: DataFrame) -> Feed:
    """Both layouts of a page, list rows first, one row per location, commodity and delivery."""
    shift = 1 << 20
    both = list_layout(bodies).select(*BIDS).unionByName(table_layout(bodies).withColumn("seq", F.col("seq") + shift).select(*BIDS))
    bids = _one_per_key(both)
    return Feed(bids, _refused(bodies, F.lit(None).cast("string"), bids))


# ---------------------------------------------------------------- fragment with tabs

# Headings of the fragment's columns.
FRAGMENT_COLUMNS = {
    "delivery": ["delivery date", "delivery", "delivery period"],
    "cash": ["cash-price", "cash price", "cash", "price"],
    "basis": ["basis"],
    "futures_month": ["basis-month", "basis month", "futures-month", "futures month"],
    "futures_price": ["futures-price", "futures price", "futures"],
}


def fragment(bodies: DataFrame) -> Feed:
    """Panels of a heading and a table; the tabs tell crop from town; a sole town serves a heading without one."""
    text = lambda c: squeeze(strip_tags(c))
    bare = lambda c: F.trim(F.regexp_replace(c, r"(?i)\s*bids?$", ""))
    buttons = F.transform(F.regexp_extract_all("body", F.lit(r"(?is)<button[^>]*>(.*?)</button>"), 1), text)
    tabs = F.filter(F.transform(F.filter(buttons, lambda t: t.rlike(rf"(?i){WORD_START}bids?$")), bare), lambda t: t != "")
    panel = r"(?is)<h1[^>]*>(.*?)</h1>(.*?)</table>"
    both = F.arrays_zip(F.regexp_extract_all("body", F.lit(panel), 1).alias("head"), F.regexp_extract_all("body", F.lit(panel), 2).alias("table"))
    panels = bodies.select("source_id", F.col("url").alias("source"), tabs.alias("tabs"), F.posexplode(both).alias("p", "x"))
    panels = panels.select("source_id", "source", "tabs", "p", bare(text(F.col("x.head"))).alias("_head"), F.col("x.table").alias("_table"))
    low = F.lower("_head")
    ends = F.get(F.filter("tabs", lambda t: low.endswith(F.lower(t)) & (F.trim(F.expr("_head")) != "") & (F.length(F.trim(F.substring(F.col("_head"), F.lit(1), F.length("_head") - F.length(t)))) > 0)), F.lit(0))
    same = F.get(F.filter("tabs", lambda t: F.lower(t) == low), F.lit(0))
    town = F.trim(F.substring(F.col("_head"), F.lit(1), F.length("_head") - F.length("_crop")))
    page = Window.partitionBy("source_id")
    split = panels.withColumn("_crop", ends).withColumn("_town", F.when(F.col("_crop").isNotNull(), town))
    split = split.withColumn("_towns", F.collect_set("_town").over(page))
    sole = F.when((F.size("_towns") == 1) & same.isNotNull(), F.get("_towns", F.lit(0)))
    named = split.withColumns({"location": F.coalesce("_town", sole), "commodity": F.coalesce("_crop", F.when(sole.isNotNull(), same))})
    thead = F.regexp_extract("_table", r"(?is)<thead.*?</thead>", 0)
    heads = F.transform(F.regexp_extract_all(thead, F.lit(r"(?is)<th[^>]*>(.*?)</th>"), 1), lambda h: F.lower(text(h)))
    at = {name: F.least(*(F.nullif(F.array_position("_heads", w), F.lit(0)) for w in words), F.lit(None).cast("bigint")) if len(words) == 1 else F.least(*(F.nullif(F.array_position("_heads", w), F.lit(0)) for w in words)) for name, words in FRAGMENT_COLUMNS.items()}
    placed = named.withColumn("_heads", heads).withColumns({f"_at_{k}": v for k, v in at.items()})
    missing = F.lit(False)
    for k in FRAGMENT_COLUMNS:
        missing = missing | F.col(f"_at_{k}").isNull()
    fault = F.when(F.col("location").isNull(), "no_town").when(thead == "", "no_thead").when(missing, "missing_column").when(~F.col("_table").rlike("(?is)<tbody.*?</tbody>"), "no_tbody")
    judged = placed.withColumn("_fault", fault)
    first_fault = judged.where("_fault is not null").groupBy("source_id").agg(F.min_by("_fault", "p").alias("code"))
    body = F.regexp_extract("_table", r"(?is)<tbody.*?</tbody>", 0)
    lines = judged.join(first_fault, "source_id", "left_anti").select("*", F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("r", "_tr"))
    lines = lines.withColumn("_cells", F.transform(F.regexp_extract_all("_tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1), text))
    cell = lambda k: F.get("_cells", (F.col(f"_at_{k}") - 1).cast("int"))
    rows = lines.select(
        "source_id",
        F.struct("p", "r").alias("seq"),
        "source",
        F.col("location").alias("location_id"),
        "location",
        "commodity",
        cell("delivery").alias("delivery"),
        strict_money(cell("cash")).alias("cash"),
        strict_money(cell("basis")).alias("basis"),
        cell("futures_month").alias("futures"),
        parse_eighths(cell("futures_price")).alias("futures_price"),
    ).where("delivery <> '' and cash is not null and basis is not null and futures_price is not null")
    bids = _two_places(rows)
    shape = bodies.join(first_fault, "source_id", "left").withColumn("_c", F.coalesce("code", F.when(~F.col("body").rlike(panel), "no_panel")))
    return Feed(bids, _refused(shape, F.col("_c"), bids))


def _two_places(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("source_id").orderBy("seq")
    out = rows.withColumns(
        {
            "seq": (F.row_number().over(order) - 1).cast("int"),
            "basis_cents": round_half_up(F.col("basis") * 100).cast("int"),
            "cash": round_to(F.col("cash"), 2),
            "basis": round_to(F.col("basis"), 2),
            "futures_at": F.lit(None).cast("string"),
            "change": F.lit(None).cast("double"),
        }
    )
    if "futures_flag" not in out.columns:
        out = out.withColumn("futures_flag", F.lit(None).cast("string"))
    return out.select(*BIDS)


# ---------------------------------------------------------------- grid with an offset

_NUMBER = re.compile(r"\d+(?:\.\d*)?|\.\d+")


class _Statements:
    """Assignments to x, each perhaps under a condition: numbers, x, + - * /, parentheses and comparisons, nothing else."""

    COMPARISONS = ("===", "!==", "==", "!=", "<=", ">=", "<", ">")

    def __init__(self, text: str):
        self.text, self.at, self.x = text, 0, 0.0

    def run(self) -> float:
        n = 0
        while self.at < len(self.text):
            if self._take(";"):
                continue
            holds = True
            if self._take("if("):
                holds = bool(self._comparison())
                self._need(")")
            if not self._take("x=") or self._peek("="):
                raise ValueError("a statement does not assign to x")
            value = self._sum()
            if self.at < len(self.text):
                self._need(";")
            if holds:
                self.x = value
            n += 1
        if not n:
            raise ValueError("no statements")
        return self.x

    def _peek(self, token: str) -> bool:
        return self.text.startswith(token, self.at)

    def _take(self, token: str) -> bool:
        if self._peek(token):
            self.at += len(token)
            return True
        return False

    def _need(self, token: str) -> None:
        if not self._take(token):
            raise ValueError(f"expected {token!r} at {self.at}")

    def _comparison(self):
        left = self._sum()
        for op in self.COMPARISONS:
            if self._take(op):
                right = self._sum()
                sign = (left > right) - (left < right)
                return {"<": sign < 0, ">": sign > 0, "<=": sign <= 0, ">=": sign >= 0}.get(op, (sign == 0) != op.startswith("!"))
        return left

    def _sum(self) -> float:
        value = self._product()
        while True:
            if self._take("+"):
                value += self._product()
            elif self._take("-"):
                value -= self._product()
            else:
                return value

    def _product(self) -> float:
        value = self._unary()
        while True:
            if self._take("*"):
                value *= self._unary()
            elif self._take("/"):
                value /= self._unary()
            else:
                return value

    def _unary(self) -> float:
        if self._take("-"):
            return -self._unary()
        if self._take("+"):
            return self._unary()
        if self._take("("):
            value = self._sum()
            self._need(")")
            return value
        if self._take("x"):
            return self.x
        m = _NUMBER.match(self.text, self.at)
        if not m:
            raise ValueError(f"no number at {self.at}")
        self.at = m.end()
        return float(m[0])


def offset_of(body: str) -> float | None:
    """What a function body makes of 0, at four decimals; null for a body outside the grammar, and for 0."""
    try:
        value = _Statements(re.sub(r"\s+", "", body)).run()
    except (ValueError, ZeroDivisionError, RecursionError, OverflowError):
        return None
    return round(value, 4) or None if abs(value) < 1e12 else None


#: A page's function that shifts its numbers, and the shift that it states.
DEFINITION = re.compile(r"(?s)function\s+displayNumber\s*\([^{]*\{(.*?)document\.write")
STATED = re.compile(r"NoScrapeOffset:\s*(-?[0-9.]+)")


def _offsets(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda xs: sorted({v for v in map(offset_of, xs) if v is not None}))


def offsets(bodies: DataFrame) -> DataFrame:
    """source_id, offset and why there is none: all definitions on a page have to agree and negate a stated offset."""
    texts = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(DEFINITION.pattern), 1)
    stated = F.regexp_extract("body", STATED.pattern, 1).try_cast("double")
    found = bodies.select("source_id", F.size(texts).alias("_n"), F.pandas_udf(_offsets, "array<double>")(texts).alias("_values"), stated.alias("_stated"))
    value = F.get("_values", F.lit(0))
    code = (
        F.when(F.col("_n") == 0, "no_definition")
        .when(F.size("_values") == 0, "no_offset")
        .when(F.size("_values") > 1, "offsets_disagree")
        .when(F.col("_stated").isNotNull() & (round_to(value + F.col("_stated"), 4) != 0), "offset_not_as_stated")
    )
    return found.select("source_id", F.when(code.isNull(), value).alias("offset"), code.alias("code"))


def grid(bodies: DataFrame) -> Feed:
    """A grid of measures by delivery, one block of rows per commodity: turned from columns into rows."""
    table = F.regexp_extract("body", r'(?s)<table class="DataGrid[^"]*".*?</table>', 0)
    head = F.regexp_extract(table, r"(?s)<thead>(.*?)</thead>", 1)
    names = F.transform(F.regexp_extract_all(head, F.lit(r'(?s)<th[^>]*scope="col"[^>]*>\s*<span>([^<]*)</span>'), 1), lambda n: F.trim(n))
    off = offsets(bodies)
    code = F.coalesce("code", F.when(F.col("_table") == "", "no_grid").when(F.col("_head") == "", "no_thead").when(F.size("deliveries") == 0, "no_deliveries"))
    pages = bodies.join(off, "source_id").withColumns({"_table": table, "_head": head, "deliveries": names}).withColumn("_code", code)
    group = r'<th[^>]*rowspan="[0-9]+"[^>]*scope="rowgroup"[^>]*>([^<]+)</th>'
    lines = pages.where("_code is null").select("source_id", F.col("url").alias("source"), "offset", "deliveries", F.when(F.col("body").contains("s</span>"), "s").alias("futures_flag"), F.posexplode(F.regexp_extract_all("_table", F.lit(r"(?s)<tr>(.*?)</tr>"), 1)).alias("r", "_tr"))
    groups = F.regexp_extract_all("_tr", F.lit(group), 1)
    label = strip_tags(F.regexp_extract("_tr", r'(?s)<th[^>]*scope="row"[^>]*>(.*?)</th>', 1))
    so_far = Window.partitionBy("source_id").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumns({"_label": label, "_groups": groups})
    marked = marked.withColumns(
        {
            "location": F.last(F.when(F.size("_groups") >= 2, F.trim(F.get("_groups", F.lit(0)))), True).over(so_far),
            "block": F.sum((F.col("_label") == "Cash Price").cast("int")).over(so_far),
        }
    ).where("block > 0")
    cells = F.regexp_extract_all("_tr", F.lit(r"(?s)<td.*?</td>"), 0)
    number = lambda c: round_to(F.regexp_extract(c, r"displayNumber\(\s*(-?[0-9.]+)\s*,", 1).try_cast("double") + F.col("offset"), 4)
    pick = lambda name, value: F.first(F.when(F.col("_label") == name, value), True)
    blocks = marked.withColumn("_cells", cells).groupBy("source_id", "source", "block", "deliveries", "futures_flag").agg(
        F.min_by("location", "r").alias("location"),
        F.min_by(F.trim(F.element_at("_groups", -1)), F.when(F.col("_label") == "Cash Price", F.col("r"))).alias("commodity"),
        pick("Cash Price", F.transform("_cells", number)).alias("_cash"),
        pick("Basis", F.transform("_cells", number)).alias("_basis"),
        pick("Futures Month", F.transform("_cells", strip_tags)).alias("_month"),
        pick("Futures Price", F.transform("_cells", parse_eighths)).alias("_price"),
    )
    long = blocks.select("*", F.posexplode("deliveries").alias("k", "delivery"))
    at = lambda c: F.get(c, F.col("k"))
    rows = long.select(
        "source_id", F.struct("block", "k").alias("seq"), "source", F.col("location").alias("location_id"), "location", "commodity", "delivery",
        at("_cash").alias("cash"), at("_basis").alias("basis"), F.nullif(at("_month"), F.lit("")).alias("futures"), at("_price").alias("futures_price"), "futures_flag",
    ).where("cash is not null and basis is not null and futures_price is not null")
    bids = _two_places(rows)
    return Feed(bids, _refused(pages, F.col("_code"), bids))
