"""One folder a source: names as Spark has them, replaced files, and how many files there are."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tallyboard.plans import engine, landing_queries
from tallyboard.sources import folders

IDS = ["a", "a:b", "50%", "x/y", "é ü", 'q"', "[1]", "{2}", "k=v", "a^b", "c\\d", "t\tab", "s'", "#*?", "~-_.", None]


def test_landed_pages_lie_in_one_file_a_source(spark, sf_dir, tmp_path, monkeypatch):
    paths = iter([tmp_path / "pages", tmp_path / "sources"])
    monkeypatch.setattr(landing_queries, "new_path", lambda _: str(next(paths)))
    found = landing_queries.landed_pages(spark, sf_dir)
    landed = found.where("state <> 'absent'").count()
    files = [p for p in (tmp_path / "pages").rglob("*") if p.is_file()]
    assert len(files) == landed > 0 and len({p.parent for p in files}) == landed


def test_folders_are_named_as_spark_names_them(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"{i} {k}") for i in IDS for k in range(3)], "source_id string, value string").repartition(5)
    folders.write_lines(rows, str(tmp_path / "own"))
    rows.write.partitionBy("source_id").text(str(tmp_path / "spark"))
    names = lambda p: {x.name for x in (tmp_path / p).iterdir() if x.is_dir()}
    assert names("own") == names("spark") and len(names("own")) == len(IDS)
    want = sorted((str(i), f"{i} {k}") for i in IDS for k in range(3))
    as_text = spark.read.schema("value string, source_id string").text(str(tmp_path / "own"))
    for found in (as_text, folders.read_lines(spark, str(tmp_path / "own")), folders.read_lines(spark, str(tmp_path / "spark"))):
        assert sorted((str(r.source_id), r.value) for r in found.collect()) == want
    assert folders.read_lines(spark, str(tmp_path / "nowhere")).count() == 0


def test_only_written_sources_are_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    line = lambda *rows: spark.createDataFrame(rows, "source_id string, value string")
    line(("a", "spark 1"), ("a", "spark 2"), ("kept", "spark")).write.partitionBy("source_id").text(out)
    folders.write_lines(line(("a", "own"), ("new", "own"), ("new", "own again")), out)
    assert sorted(map(tuple, folders.read_lines(spark, out).collect())) == [("a", "own"), ("kept", "spark"), ("new", "own"), ("new", "own again")]
    folders.write_lines(line(("none", "x")).where("false"), out)
    assert spark.read.text(out).count() == 4
    assert {p.name for p in Path(out).iterdir() if p.name.startswith("_")} == {"_SUCCESS"}


def test_a_run_that_fails_replaces_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    folders.write_lines(spark.createDataFrame([("a", "good")], "source_id string, value string"), out)

    def broken(batches):
        for batch in batches:
            if batch.num_rows and "last" in batch.column(0).to_pylist():
                raise RuntimeError("stopped")
            yield batch

    rows = spark.createDataFrame([("a", "bad"), ("b", "bad"), ("last", "bad")], "source_id string, value string").repartition(3)
    with pytest.raises(PythonException):
        folders.write_lines(rows.mapInArrow(broken, "source_id string, value string").withColumn("value", F.col("value")), out)
    assert [tuple(r) for r in folders.read_lines(spark, out).collect()] == [("a", "good")] and [p.name for p in Path(out).iterdir()] == ["source_id=a"]


def test_snapshots_of_four_thousand_sources_in_two_runs(spark, tmp_path):
    out, began = str(tmp_path / "out"), time.time()
    run = lambda n: spark.range(4000).select(F.concat(F.lit("s:"), "id").alias("source_id"), F.lit(n).alias("run"), (F.col("id") % n == 0).alias("write"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("none"))
    assert engine.write_snapshots(run(1), out) == {"decided": 4000, "written": 4000, "changed": 0}
    assert engine.write_snapshots(run(4), out) == {"decided": 4000, "written": 1000, "changed": 0}
    own = F.from_json("value", "run int, write boolean, none long")
    kept = folders.read_lines(spark, out).select("source_id", own.alias("s")).select("source_id", "s.*").collect()
    took = time.time() - began
    assert {r.source_id: (r.run, r.write, r.none) for r in kept} == {f"s:{k}": (4 if k % 4 == 0 else 1, True, None if k % 2 else k) for k in range(4000)} and len(kept) == 4000
    assert sum(p.is_file() for p in Path(out).rglob("*")) == 4000 and took < 40
