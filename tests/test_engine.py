"""A run from files to files: manifests, a landing table, snapshots, the index, and the next run against them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tallyboard.plans import engine
from tallyboard.sources import landing, manifests
from tallyboard.streaming import polls

OFFER = {"destination": "T", "deliveryPeriod": "Oct", "standardCashPrice": "4.10", "basisPrice": "-0.35", "futuresPrice": "445"}


def manifest(name, **more):
    return {"id": name, "operator": "Op", "location": "T", "platform": "graindesk", "url": f"https://board.example.com/{name}", "bands": {"corn": [2, 12]}, "lat": None, "lon": None, "locationId": "T"} | more


def test_files_to_files(spark, tmp_path):
    folder = tmp_path / "manifests"
    folder.mkdir()
    for m in (manifest("good"), manifest("late", altUrls=["https://alt.example.com/late"]), manifest("bad", bands={}), manifest("off", enabled=False), manifest("gone")):
        (folder / f"{m['id']}.json").write_text(json.dumps(m))
    (folder / "broken.json").write_text("{")
    loaded = manifests.load(manifests.parse(manifests.read_manifests(spark, str(folder))))
    complaints = {r.path.rsplit("/", 1)[1]: r.complaints for r in loaded.collect()}
    assert complaints["good.json"] == [] and complaints["bad.json"] == ["no bands"] and "not an object" in complaints["broken.json"]
    config = manifests.to_config(loaded)
    assert {r.source_id for r in config.collect()} == {"good", "late", "gone"}

    body = json.dumps([{"commodity": {"name": "Corn"}, "offers": [OFFER]}])
    pages = [("https://board.example.com/good", 200, body), ("https://board.example.com/late", 500, "oops"), ("https://alt.example.com/late", 200, body), ("https://board.example.com/gone", 404, "")]
    (tmp_path / "pages.json").write_text("\n".join(json.dumps({"browser_page": "", "url": u, "status": s, "body": b}) for u, s, b in pages))
    bodies = landing.usable(landing.read_pages(spark, str(tmp_path / "pages.json")), config)
    assert {r.source_id: r.url for r in bodies.collect()} == {"good": pages[0][0], "late": pages[2][0]}

    (tmp_path / "none.json").write_text("not a snapshot\n")
    previous = landing.read_snapshots(spark, str(tmp_path / "none.json"))
    at = lambda h: F.lit(f"2024-01-01 {h:02}:00:00").cast("timestamp")
    first = engine.run(loaded, bodies, previous, at(0), ("graindesk",))
    index = {r.source_id: (r.health, r.code, r.reason) for r in first.index.collect()}
    assert index == {"good": ("live", None, "first run"), "late": ("live", None, "first run"), "gone": ("refused", "no_rows", None)}
    engine.write_snapshots(first.snapshots, str(tmp_path / "snapshots"))
    engine.write_index(first.index, str(tmp_path / "index"))
    written = spark.read.json(str(tmp_path / "snapshots"))
    assert written.count() == 2 and written.select(F.explode("bids")).count() == 2
    assert spark.read.json(str(tmp_path / "index")).count() == 3

    kept = first.snapshots.select("source_id", "bids_hash", "count", "priced_at", "checked_at")
    for hour, reason, write in ((3, "no change", False), (7, "heartbeat", True)):
        again = engine.run(loaded, bodies, kept, at(hour), ("graindesk",)).snapshots.collect()
        assert {(r.reason, r.write, r.priced_at.hour) for r in again} == {(reason, write, 0)}
    assert {r.reason for r in engine.run(loaded, bodies.withColumn("body", F.replace("body", F.lit("Oct"), F.lit("Nov"))), kept, at(1), ("graindesk",)).snapshots.collect()} == {"price moved"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("a", True), ("b", False)], "k string, write boolean")
    write = polls.commit_batches(str(tmp_path / "out"), "k")
    write(rows, 3)
    write(rows, 3)
    write(rows.withColumn("write", F.lit(True)), 4)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("batch").count().orderBy("batch").collect() == [(3, 1), (4, 2)]


def test_a_second_run_keeps_the_snapshots_it_does_not_write(spark, tmp_path):
    """One source is written again, one skipped, one refused and so not in the run at all."""
    row = "source_id string, count long, write boolean"
    engine.write_snapshots(spark.createDataFrame([("a", 1, True), ("skipped", 1, True), ("refused", 1, True)], row), str(tmp_path / "out"))
    engine.write_snapshots(spark.createDataFrame([("a", 2, True), ("skipped", 2, False), ("new", 2, True)], row), str(tmp_path / "out"))
    got = {r.source_id: r["count"] for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert got == {"a": 2, "skipped": 1, "refused": 1, "new": 2}


def test_numbers_of_a_whole_order(spark):
    from tallyboard.operators.ranking import numbered

    rows = spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1000).alias("v"))
    assert {r.v: r.n for r in numbered(rows, ["v"], "n").collect()} == {v: v for v in range(1000)}
    assert numbered(rows.limit(0), ["v"], "n").count() == 0
