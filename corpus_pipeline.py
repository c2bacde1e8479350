"""A corpus pipeline of five stages, each by one operator of `tallyboard.llm`.

Documents that the quality rules reject go; lines that many documents share go from all but the
last; of near duplicates the first stays; contaminated documents go; the rest is packed.
Every stage but the last returns the columns of `documents`, with n_chars of the text it returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import decontaminate, line_dedup, packing, quality_rules, simhash_dedup
from tallyboard.llm.names import free
from tallyboard.plans.shipping import ship
from tallyboard.sources.scratch import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_rules.keep_good(docs, quality_rules.fit(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = {"lines_col": free(docs, "n_lines"), "dropped_col": free(docs, "n_dropped")}
    kept = line_dedup.drop_common_lines(docs, **names).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_dedup.keep_first(docs, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: The first stage's perplexity model has no SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
