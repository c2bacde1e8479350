"""Every registered query against its SQL in DuckDB, on the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tallyboard.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    columns = ", ".join(f'"{c}"' for c in sorted(got.column_names))
    tables.register("got", got)
    tables.execute(f"CREATE OR REPLACE TEMP TABLE want AS {ORACLE[name]}")
    assert sorted(r[0] for r in tables.execute("DESCRIBE want").fetchall()) == sorted(got.column_names)
    for a, b in (("want", "got"), ("got", "want")):
        assert tables.execute(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 3").fetchall() == []
