"""All registered queries and their SQL, gathered from the query modules.

A query is registered by `query`, with the DuckDB SQL that gives the same rows where there is such SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "rounding_evidence"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> None:
    for name in ("board_queries", "poll_queries", "text_queries", "page_queries", "name_queries", "feed_queries", "stream_queries", "landing_queries"):
        import_module(f"tallyboard.plans.{name}")


load()
