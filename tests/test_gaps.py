"""Links against the standard library's, outlines, captures, versions, and the rules of a whole run."""

from __future__ import annotations

import datetime as dt
import json
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import discovery, generation, status
from tallyboard.plans import engine
from tallyboard.sources import landing, versions
from tallyboard.sources.outlines import outline_of
from tallyboard.streaming import polls

BASES = ["https://a.example.org", "https://a.example.org/b/c/d?q=1#f", "http://h:80/x/", "https://a.example.org/?q"]
LINKS = ["g", "./g", "g/", "/g", "//o.org/g", "?y", "g?y", "#s", "g#s", "g?y#s", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "./../g", "./g/.", "g/./h", "g/../h", "https://z.org/q", "data:x"]


def test_links_resolve_as_the_standard_library_has_them(spark):
    pairs = spark.createDataFrame([(b, x) for b in BASES for x in LINKS], "base string, link string")
    for r in pairs.withColumn("got", discovery.resolved(F.col("link"), F.col("base"))).collect():
        want = urljoin(r.base, r.link)
        assert r.got in (want, want.replace(".org?", ".org/?").replace(".org#", ".org/#")), r
    odd = spark.createDataFrame([(None, "g"), ("https://a.org/", None), ("no page", "g")], "base string, link string")
    assert {r.got for r in odd.select(discovery.resolved(F.col("link"), F.col("base")).alias("got")).collect()} == {None}


def test_outlines():
    assert outline_of("12") is outline_of("null") is outline_of("{") is outline_of(None) is None
    assert outline_of("[]") == ["(root): array of 0"]
    assert outline_of('[{"a": {"b": 1}, "c": [1, 2], "d": [], "e": 2.0, "f": null}, 3]') == [
        "(root): array of 2", "[0]: object, 5 key(s)", "  [0].a = {1}", "  [0].c = [2]", "  [0].d = [0]", "  [0].e = 2", "  [0].f = null",
    ]
    deep = outline_of("[" * 900 + "]" * 900)
    assert len(deep) == 900 and outline_of("[" * 200_000 + "]" * 200_000) is None


def test_a_capture_ends_by_quiet_or_by_its_cap(spark):
    start = dt.datetime(2024, 1, 1)
    at = {"quiet": [0.5, 1, 4, 4.5], "capped": [k * 2.4 for k in range(1, 30)], "late": [3.0]}
    rows = spark.createDataFrame([(k, start, start + dt.timedelta(seconds=s)) for k, all_ in at.items() for s in all_], "page string, opened timestamp, at timestamp")
    got = {r.page: (r.n_responses, (r.ended - start).total_seconds(), r.quiet) for r in polls.captures(rows, "page", "at", "opened").collect()}
    assert got == {"quiet": (2, 3.5, True), "capped": (18, 45.0, False), "late": (0, 2.5, True)}


def test_versions(spark, tmp_path):
    folder, one = str(tmp_path / "table"), spark.range(1)
    assert versions.version(spark, folder) == 0 and versions.update(spark, folder, lambda last: None) == (0, False)
    assert versions.commit(one, folder, 0) == 1
    with pytest.raises(versions.Conflict):
        versions.commit(one, folder, 0)

    def rival(last):
        versions.commit(one, folder, versions.version(spark, folder))
        return last

    with pytest.raises(versions.Conflict):
        versions.update(spark, folder, rival)
    assert versions.version(spark, folder) == 3


def test_a_run_of_one_and_a_run_without_any(spark):
    text = json.dumps({"id": "a", "operator": "Op", "location": "T", "platform": "graindesk", "url": "https://b.example.com/a", "bands": {"corn": [2, 12]}, "lat": None, "lon": None, "locationId": "T"})
    from tallyboard.sources import manifests

    loaded = manifests.load(manifests.parse(spark.createDataFrame([("a", text), ("b", text.replace('"a"', '"b"'))], "path string, raw string")))
    bodies = spark.createDataFrame([("a", "graindesk", "u", "oops"), ("b", "graindesk", "u", "[]")], "source_id string, platform string, url string, body string")
    previous = spark.createDataFrame([], "source_id string, bids_hash string, count long, priced_at timestamp, checked_at timestamp")
    index = engine.run(loaded, bodies, previous, F.current_timestamp(), ("graindesk",), only="a").index
    assert [r.source_id for r in index.collect()] == ["a"] and engine.outcome(index).first().failed
    with pytest.raises(RuntimeError):
        engine.require_live(index)
    with pytest.raises(ValueError):
        engine.run(loaded, bodies, previous, F.current_timestamp(), ("graindesk",), only="nobody")


def test_states_without_a_folder_and_empty_tables(spark, tmp_path):
    config = spark.createDataFrame([("a",)], "source_id string")
    assert landing.snapshot_states(spark, str(tmp_path / "none"), config).collect() == [("a", "absent")]
    assert generation.written_ids(spark, str(tmp_path / "none")).count() == 0
    none = spark.createDataFrame([], "state string")
    assert status.state_counts(none).first().verdict == "down"
    answers = spark.createDataFrame([(401, "no such token"), (None, "fetch failed"), (500, None), (200, "HIT")], "status int, verdict string")
    assert status.leads(answers).count() == 2
