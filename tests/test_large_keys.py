"""Queries on tables larger or with larger keys than the given ones, against their SQL."""

from __future__ import annotations

import duckdb

from tallyboard.functions import text
from tallyboard.plans.registry import ORACLE, QUERIES


def differing(spark, folder, name, table, sql):
    """Rows of the query `name` that its SQL does not have, and the other way round, over one table made by `sql`."""
    db = duckdb.connect()
    db.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = QUERIES[name](spark, str(folder)).toArrow()
    columns = ", ".join(f'"{c}"' for c in sorted(got.column_names))
    db.register("got", got)
    db.execute(f"CREATE TEMP TABLE want AS {ORACLE[name]}")
    assert db.execute("SELECT count(*) FROM want").fetchone()[0] > 0
    return [db.execute(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 3").fetchall() for a, b in (("want", "got"), ("got", "want"))]


def test_postal_cells_of_six_digits(spark, tmp_path, sf_dir):
    sql = f"SELECT * REPLACE (c_custkey + 49990 AS c_custkey) FROM '{sf_dir}/customer.parquet'"
    assert differing(spark, tmp_path, "postal_cells", "customer", sql) == [[], []]
    cells = spark.createDataFrame([("Elk, MN 123456",)], "c string")
    assert [tuple(r.p) for r in cells.select(text.split_postal("c").alias("p")).collect()] == [("Elk", "MN", "12345")]
