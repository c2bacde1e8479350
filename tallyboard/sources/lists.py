"""Line-based inputs: candidate lists, probe lists, geocodes, run logs, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.functions.places import destination_kind
from tallyboard.functions.text import slug, split_postal

# Fixed value: an operator and town whose coordinate is known to be wrong.
KNOWN_BAD = [("synergycoop", "ricelake")]


def lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, line number (from 0) and line."""
    return texts.select(key, F.posexplode(F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")).alias("n", "line"))


def _entry(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"\s+#.*$", ""))


def read_list(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Entries of a candidate list: comments and blank lines are dropped."""
    found = lines(texts, key, text).withColumn("entry", _entry(F.col("line")))
    return found.where((F.col("entry") != "") & ~F.col("entry").startswith("#")).select(key, "n", "entry")


def probe_list(texts: DataFrame, key: str, text: str) -> DataFrame:
    """site, page and operator of each line; a line of another shape is returned as `bad`."""
    shape = r"^(\S+)\s+(\S+)(?:\s+(.*))?$"
    found = read_list(texts, key, text)
    ok = F.col("entry").rlike(shape)
    part = lambda k: F.when(ok, F.nullif(F.trim(F.regexp_extract("entry", shape, k)), F.lit("")))
    return found.select(key, "n", part(1).alias("site"), part(2).alias("page"), part(3).alias("operator"), F.when(~ok, F.col("entry")).alias("bad"))


def covered_towns(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Slugs of the towns of a coverage list, `Facility|Town, ST` or `Town, ST`."""
    town = F.trim(F.element_at(F.split("entry", r"\|"), -1))
    return read_list(texts, key, text).select(slug(F.get(F.split(town, ","), F.lit(0))).alias("town")).distinct()


def geocodes(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of a geocode table of seven columns with finite coordinates, with the parts of the postal cell."""
    c = F.split("line", "\t")
    at = lambda k: F.get(c, F.lit(k))
    number = lambda k: F.regexp_extract(at(k), r"^\s*([+-]?[0-9]*\.?[0-9]+)", 1).try_cast("double")
    found = lines(texts, key, text).where((F.trim("line") != "") & ~F.col("line").startswith("#") & (F.size(c) >= 7))
    rows = found.select("n", at(0).alias("name"), at(1).alias("url"), at(2).alias("phone"), at(3).alias("address"), at(4).alias("postal"), split_postal(at(4)).alias("p"), number(5).alias("lon"), number(6).alias("lat"))
    return rows.where("lon is not null and lat is not null").select("n", "name", "url", "phone", "address", "postal", "p.*", "lon", "lat")


def locate(entries: DataFrame, codes: DataFrame) -> DataFrame:
    """entries (operator, location, ...) with status hit, known_bad, imprecise, other_operator or missing, and the hit's coordinate."""
    from tallyboard.functions.numbers import decimals

    coded = codes.select("n", slug(F.col("name")).alias("_op"), slug(F.col("town")).alias("_town"), "name", "lat", "lon")
    exact = coded.groupBy("_op", "_town").agg(F.min_by(F.struct("lat", "lon"), "n").alias("_hit"))
    by_town = coded.groupBy("_town").agg(F.min_by("name", "n").alias("_other"))
    asked = entries.withColumns({"_op": slug(F.col("operator")), "_town": slug(F.col("location"))})
    joined = asked.join(exact, ["_op", "_town"], "left").join(by_town, "_town", "left")
    bad = F.lit(False)
    for op, town in KNOWN_BAD:
        bad = bad | ((F.col("_op") == op) & (F.col("_town") == town))
    coarse = F.least(decimals(F.col("_hit.lat")), decimals(F.col("_hit.lon"))) < 6
    status = F.when(bad, "known_bad").when(F.col("_hit").isNotNull(), F.when(coarse, "imprecise").otherwise("hit")).when(F.col("_other").isNotNull(), "other_operator").otherwise("missing")
    placed = joined.withColumn("geo_status", status)
    keep = F.col("geo_status") == "hit"
    return placed.withColumns({"lat": F.when(keep, F.col("_hit.lat")), "lon": F.when(keep, F.col("_hit.lon")), "geo_owner": F.when(F.col("geo_status") == "other_operator", F.col("_other"))}).drop("_op", "_town", "_hit", "_other")


def unwrap_log(line: Column) -> Column:
    """A hosted run's log line without byte order mark, time stamp, colours and group marks."""
    out = F.regexp_replace(line, "^﻿", "")
    out = F.regexp_replace(out, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+Z\s?", "")
    out = F.regexp_replace(out, "\x1b\\[[0-9;]*m", "")
    return F.regexp_replace(out, r"^##\[(?:group|endgroup|debug)\]", "")


def verdicts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """site, location_id, mode, testable and margin of a log's verdict lines; the last of a pair wins."""
    shape = r"^V\s+(\S+)\s+(\S+)\s+(\S+)\s+([0-9]+)\s+(-?[0-9]+)"
    found = lines(texts, key, text).withColumn("line", F.trim(unwrap_log(F.col("line")))).where(F.col("line").rlike(shape))
    part = lambda k: F.regexp_extract("line", shape, k)
    rows = found.select(key, "n", part(1).alias("site"), part(2).alias("location_id"), part(3).alias("mode"), part(4).cast("long").alias("testable"), part(5).cast("long").alias("margin"))
    return rows.groupBy(key, "site", "location_id").agg(*(F.max_by(c, "n").alias(c) for c in ("mode", "testable", "margin")))


def probe_log(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per heading of a run's log: location, its manifest's JSON, verdict, why it may be no town, and what is wrong.

    The manifest is the first balanced JSON object after the heading. The running depth of braces
    outside strings is a window sum over lines, after string literals are cut from each line.
    """
    heading = r"^---\s+(.*?)\s+\((\S+?)\)\s+—\s+([0-9]+)\s+row"
    flag = r"NOT A TOWN\?\s+(.*)$"
    own = lines(texts, key, text).withColumn("line", unwrap_log(F.col("line")))
    order = Window.partitionBy(key).orderBy("n")
    is_heading = F.col("line").rlike(heading)
    own = own.withColumn("_h", F.sum(is_heading.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_h > 0")
    section = Window.partitionBy(key, "_h").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.max((F.ltrim("line").startswith("{")).cast("int")).over(section)
    code = F.regexp_replace("line", r'"(?:[^"\\]|\\.)*"', "")
    depth = F.when(opened == 1, F.length(F.regexp_replace(code, r"[^{]", "")) - F.length(F.regexp_replace(code, r"[^}]", ""))).otherwise(F.lit(0))
    marked = own.withColumns({"_open": opened, "_depth": F.sum(depth).over(section)})
    closed = F.sum(((F.col("_open") == 1) & (F.col("_depth") <= 0)).cast("int")).over(section)
    marked = marked.withColumn("_closed", closed)
    inside = (F.col("_open") == 1) & ((F.col("_closed") == 0) | ((F.col("_closed") == 1) & (F.col("_depth") <= 0)))
    grouped = marked.groupBy(key, "_h").agg(
        F.min_by("line", "n").alias("_head"),
        F.min("n").alias("n"),
        F.max_by(F.when((F.col("_open") == 0) & F.col("line").rlike(flag), F.trim(F.regexp_extract("line", flag, 1))), F.when((F.col("_open") == 0) & F.col("line").rlike(flag), F.col("n"))).alias("logged"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(inside, F.struct("n", "line")))), lambda x: x["line"]), "\n").alias("manifest"),
        F.max("_open").alias("_open"),
        F.max("_closed").alias("_closed"),
    )
    part = lambda k: F.regexp_extract("_head", heading, k)
    wrong = F.when(F.col("_open") == 0, "no manifest followed its heading").when(F.col("_closed") == 0, "its manifest never closed").when(F.try_parse_json("manifest").isNull(), "its manifest is no JSON")
    entries = grouped.select(key, "n", part(1).alias("location"), part(2).alias("location_id"), part(3).cast("long").alias("rows"), "logged", "manifest", wrong.alias("bad"))
    entries = entries.withColumn("site", F.get_json_object("manifest", "$.siteId"))
    joined = entries.join(verdicts(texts, key, text), [key, "site", "location_id"], "left")
    kind = destination_kind(F.col("location"))["kind"]
    return joined.withColumns(
        {
            "not_a_town": F.coalesce("logged", kind),
            "flagged_by_log_only": F.col("logged").isNotNull() & kind.isNull(),
            "flagged_by_build_only": F.col("logged").isNull() & kind.isNotNull(),
        }
    )


def crons(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Schedules of a workflow text, in order."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"""(?m)^\s*-\s*cron:\s*["']([^"']+)["']"""), 1)
    return texts.select(key, F.posexplode(found).alias("n", "cron"))


def lint(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Faults in the plain values of a workflow text: a nested mapping, or a comment inside a quoted string.

    Lines inside a block scalar do not count. Whether a line is inside one depends on the last opener
    and its indent, so lines are folded in order.
    """
    shape = r"^(\s*)(?:-\s+)?[A-Za-z_][A-Za-z0-9_.-]*:(?:\s+(.*))?$"
    split = F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")
    indent = lambda x: F.length(x) - F.length(F.ltrim(x))
    start = F.struct(F.lit(None).cast("int").alias("block"), F.array().cast("array<int>").alias("seen"), F.lit(0).alias("n"))

    def step(s: Column, line: Column) -> Column:
        blank = F.trim(line) == ""
        in_block = s["block"].isNotNull() & (blank | (indent(line) > s["block"]))
        live = ~in_block & ~blank & ~F.trim(line).startswith("#") & line.rlike(shape)
        value = F.trim(F.regexp_extract(line, shape, 2))
        opens = live & value.rlike("^[|>]")
        return F.struct(
            F.when(in_block, s["block"]).when(opens, F.length(F.regexp_extract(line, shape, 1))).alias("block"),
            F.when(live & ~opens, F.concat(s["seen"], F.array(s["n"]))).otherwise(s["seen"]).alias("seen"),
            (s["n"] + 1).alias("n"),
        )

    places = F.aggregate(split, start, step, lambda s: s["seen"])
    rows = texts.select(key, split.alias("_lines"), F.explode(places).alias("_n")).select(key, (F.col("_n") + 1).alias("line"), F.get("_lines", F.col("_n")).alias("_text"))
    value = F.trim(F.regexp_extract("_text", shape, 2))
    cut = F.get(F.split(value, r"\s#"), F.lit(0))
    odd = lambda q: F.length(F.regexp_replace(cut, f"[^{q}]", "")) % 2 == 1
    fault = F.when(value.contains(": ") | value.endswith(":"), "nested mapping").when((cut != value) & (odd('"') | odd("'")), "comment in a quoted string")
    plain = (value != "") & ~value.rlike("""^["'\\[{]""")
    return rows.select(key, "line", F.trim("_text").alias("text"), F.when(plain, fault).alias("why")).where("why is not null")
