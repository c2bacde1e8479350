"""The landed-pages source, board readers in SQL, counters of writes, versions under writers that race or stop, labels, clocks and orders."""

from __future__ import annotations

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyboard.functions.zones import abbreviation, local_clocks, zone_changes
from tallyboard.operators import guards, status
from tallyboard.plans import engine
from tallyboard.sources import landed, landing, layouts, table_functions, versions

LONG = "x" * 600


def land(folder, name, *lines):
    own = folder / f"source_id={name}"
    own.mkdir(parents=True)
    (own / "part-0.txt").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


@pytest.mark.parametrize("partitions", [1, 3, 100])
def test_landed_pages(spark, tmp_path, partitions):
    fetch = lambda url, status, body, at=None: {"url": url, "status": status, "body": body, "fetched_at": at}
    pages = tmp_path / "pages"
    land(pages, "first", fetch("u", 200, LONG), fetch("v", 200, LONG + "v"))
    land(pages, "second", fetch("u", 500, LONG), fetch("v", 200, LONG + "v"))
    land(pages, "again", fetch("u", 500, "no", "2024-01-01T00:00:00+00:00"), fetch("u", 200, LONG, "2024-01-02T00:00:00+00:00"), fetch("u", 200, LONG + "!", "2024-01-01T12:00:00+00:00"))
    land(pages, "short", fetch("u", 200, "{}"), "{ broken", "[]", "", "12", {"url": "u"})
    land(pages, "json", "{ broken", fetch("u", 200, "{}"))
    land(pages, "a%3Ab", fetch("u", 200, LONG))
    land(pages, "unlisted", fetch("u", 200, LONG))
    config = [("first", "html", ["u", "v"]), ("second", "html", ["u", "v"]), ("again", "html", ["u"]), ("short", "html", ["u"]), ("json", "json", ["u"]), ("a:b", "html", ["u"]), ("none", "html", ["u"]), ("bare", "html", None)]
    (tmp_path / "sources").mkdir()
    (tmp_path / "sources" / "part-0.json").write_text("\n".join(json.dumps({"source_id": i, "wire": w, "urls": u}) for i, w, u in config))
    landed.register(spark)
    rows = spark.read.format("landed_pages").option("sources", str(tmp_path / "sources")).option("partitions", partitions).load(str(pages))
    assert rows.rdd.getNumPartitions() == min(partitions, len(config))
    got = {r.source_id: (r.state, r.url, r.body) for r in rows.collect()}
    assert got == {
        "first": ("present", "u", LONG), "second": ("present", "v", LONG + "v"), "again": ("present", "u", LONG), "short": ("unreadable", None, None), "json": ("present", "u", "{}"),
        "a:b": ("present", "u", LONG), "none": ("absent", None, None), "bare": ("absent", None, None),
    }
    empty = spark.read.format("landed_pages").option("sources", str(tmp_path / "sources")).load(str(tmp_path / "nowhere"))
    assert {r.state for r in empty.collect()} == {"absent"}


def test_a_good_fetch_counts_whatever_came_before_it(spark):
    config = spark.createDataFrame([("s", "p", "", "html", ["u", "v"])], "source_id string, platform string, browser_page string, wire string, urls array<string>")
    day = lambda d: dt.datetime(2024, 1, d)
    fetches = [("u", 500, LONG, day(1)), ("u", 200, LONG + "new", day(3)), ("u", 200, LONG + "old", day(2)), ("u", 500, LONG, day(4)), ("v", 200, LONG, day(5))]
    for rows in (fetches, fetches[::-1]):
        pages = spark.createDataFrame([("s", "p", "", *r) for r in rows], landing.PAGES)
        assert [(r.url, r.body) for r in landing.usable(pages, config).collect()] == [("u", LONG + "new")]


PAGE = "<table><tr><th>Bid<td>1</td></th><td colspan=2>x<table><tr><td>in</td></tr></table></td></tr></table><table></table>"
SHIFT = "function displayNumber(n) { var o = 0; o = o - 5; document.write(n) } NoScrapeOffset: 5"


def test_readers_in_sql_are_the_readers(spark):
    rows = [("a", "u", PAGE), ("b", "v", PAGE + PAGE), ("c", "w", None), ("d", "x", SHIFT), ("e", "y", SHIFT.replace("Offset: 5", "Offset: 6")), ("f", "z", "none")]
    bodies = spark.createDataFrame(rows, "source_id string, url string, body string")
    table_functions.register(spark)
    call = lambda what: spark.sql(f"SELECT * FROM read_board(TABLE({{b}}) PARTITION BY (source_id), '{what}')", b=bodies)
    text = lambda r: (r.source_id, r.place, r.row, [c.html for c in r.cells])
    want = bodies.mapInArrow(layouts._slice, layouts._TABLES).collect()
    assert sorted(map(text, call("tables").collect())) == sorted(map(text, want)) and len(want) == 6
    assert sorted(map(tuple, call("offsets").collect())) == sorted(map(tuple, layouts.offsets(bodies).collect()))
    with pytest.raises(AnalysisException, match="reads one of"):
        call("nothing")
    with pytest.raises(AnalysisException, match="needs the columns"):
        spark.sql("SELECT * FROM read_board(TABLE(SELECT 1 AS source_id), 'tables')")


def test_counts_come_with_the_write(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    index = spark.createDataFrame([("a", "live", True), ("b", "refused", False), ("c", "live", False)], "source_id string, health string, write boolean").mapInArrow(seen, "source_id string, health string, write boolean")
    assert engine.write_index(index, str(tmp_path / "index")) == {"total": 3, "live": 2, "refused": 1, "broken": 0}
    assert calls.value == 3
    assert engine.write_snapshots(index.withColumn("changed", F.lit(True)), str(tmp_path / "out")) == {"decided": 3, "written": 1, "changed": 1}
    assert calls.value == 6


def test_a_torn_marker_is_no_version(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert versions.commit(spark.range(1), folder, 0) == 1
    for torn in ("", "rows-of-nobody"):
        (tmp_path / "table" / "_commits" / str(max(int(p.name) for p in (tmp_path / "table" / "_commits").iterdir() if p.name.isdigit()) + 1)).write_text(torn)
    (tmp_path / "table" / "_commits" / ".rows-staged").write_text("rows-staged")
    assert versions.version(spark, folder) == 1 and versions.read(spark, folder, 1).count() == 1
    assert versions.commit(spark.range(2), folder, 1) == 4
    assert versions.version(spark, folder) == 4 and versions.read(spark, folder, 4).count() == 2


def test_writers_that_race_lose_no_commit(spark, tmp_path):
    folder = str(tmp_path / "table")

    def add(writer):
        for k in range(3):
            one = spark.createDataFrame([(writer, k)], "w int, k int")
            versions.update(spark, folder, lambda last: one if last is None else last.unionAll(one), tries=20)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(add, range(3)))
    last = versions.version(spark, folder)
    assert sorted(map(tuple, versions.read(spark, folder, last).collect())) == [(w, k) for w in range(3) for k in range(3)] and last == 9


def test_other_locations_go_by_containment(spark):
    rows = spark.createDataFrame([("s", "Elk", "12"), ("s", "Elk", "12"), ("s", "Fox", "112"), ("s", "Owl 12", ""), ("s", "Ash", "21"), ("s", "Oak", None), ("t", "Elk", "1")], "source_id string, location string, location_id string")
    own = spark.createDataFrame([("s", "12"), ("t", None)], "source_id string, location_id string")
    assert sorted(map(tuple, guards.other_locations(rows, own).collect())) == [("s", "Ash (21)"), ("s", "Oak")]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_published_numbers_follow_the_page_among_ties(spark, partitions):
    from tests.test_guards import ROW, SOURCE, source

    row = {"source_id": "s", "location_id": "T", "location": "Town", "commodity": "Corn", "delivery": "Oct", "basis": -0.5, "basis_cents": -50, "futures": "DEC", "futures_at": ""}
    names = [c.strip().split(" ")[0] for c in ROW.split(",")]
    made = [row | {"seq": 7, "cash": 2.5 + k % 3, "futures_price": 100.0 * (3 + k % 3), "place": k} for k in (5, 2, 9, 0, 4, 7)]
    df = spark.createDataFrame([tuple(r[n] for n in names) + (r["place"],) for r in made], f"{ROW}, place int").repartition(partitions)
    out = guards.run_guards(df, spark.createDataFrame([source("s", location_id="T")], SOURCE))
    got = [r.cash for r in out.published.orderBy("seq").collect()]
    assert got == [2.5 + k % 3 for k in (0, 2, 4, 5, 7, 9)]


@pytest.mark.parametrize("shuffles", ["1", "5"])
def test_names_in_the_order_of_readers(spark, shuffles):
    names = ["zoe", "Zoë", "Zoe", "Émile", "emil", "Co op", "co-op", "coop", "10", "2", "_x", "Straße", "Strasse", None, "ö", "o"]
    df = spark.createDataFrame([("live", n) for n in names] + [("down", "zz")], "state string, name string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        got = [r.name for r in sorted(status.ordered(df, ["name"]).collect(), key=lambda r: r.place)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == ["zz", None, "_x", "10", "2", "Co op", "co-op", "coop", "emil", "Émile", "o", "ö", "Strasse", "Straße", "zoe", "Zoe", "Zoë"]


def test_clocks_of_zones(spark):
    zones = ["America/New_York", "America/Chicago", "Europe/London", "Asia/Kolkata", "Australia/Lord_Howe", "UTC", "America/Sao_Paulo"]
    at = [dt.datetime(2024, 1, 1), dt.datetime(2024, 7, 1), dt.datetime(2023, 12, 31, 23, 59, 59), *(dt.datetime(2024, m, d, h, 59, 59) + dt.timedelta(seconds=s) for m, d, h in ((3, 10, 6), (11, 3, 5), (3, 31, 0), (10, 27, 0), (4, 6, 14)) for s in (0, 1))]
    rows = spark.createDataFrame([(z, t) for z in zones for t in at] + [("No/Where", at[0]), ("UTC", None), ("UTC", dt.datetime(1900, 1, 1))], "z string, t timestamp")
    from zoneinfo import ZoneInfo

    for r in local_clocks(rows, "t", "z", zone_changes(spark, zones, 2023, 2025)).collect():
        if r.t is None or r.z == "No/Where" or r.t.year == 1900:
            assert r.local_day is r.local_zone is None
            continue
        utc = r.t.replace(tzinfo=dt.timezone.utc)
        here = utc.astimezone(ZoneInfo(r.z))
        assert (r.local_day, r.local_time, r.local_zone) == (f"{here:%Y-%m-%d}", f"{here:%H:%M:%S}", abbreviation(r.z, utc))
    of = lambda z, m: abbreviation(z, dt.datetime(2024, m, 15, tzinfo=dt.timezone.utc))
    assert [of("America/New_York", 7), of("America/Chicago", 1), of("Europe/London", 1), of("Europe/London", 7), of("Asia/Kolkata", 1), of("America/Sao_Paulo", 1), of("UTC", 1)] == ["EDT", "CST", "GMT", "GMT+1", "GMT+5:30", "GMT-3", "UTC"]
