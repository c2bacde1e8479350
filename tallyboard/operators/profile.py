"""Profiles of a board: how its cash is rounded, what it carries, and whether two runs agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.numbers import round_half_up, round_to

MIN_MARGIN = 2


def rounding_evidence(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group: how many testable rows each rule of rounding explains, and the rule named by that.

    Cash is taken in whole cents first. `exact` subsumes the others; a rule is named if it alone explains
    every testable row, and is confident if its best rival misses two rows at least.
    """
    derived = round_half_up(F.col("basis") * 100) + F.col("futures_price")
    cents = round_half_up(F.col("cash") * 100)
    ready = rows.where("cash is not null and basis is not null and futures_price is not null").select(*by, derived.alias("_d"), cents.alias("_c"))
    d, c = F.col("_d"), F.col("_c")
    out = ready.groupBy(*by).agg(
        F.count("*").alias("testable"),
        F.count_if(F.abs(d - c) < 1e-9).alias("exact"),
        F.count_if(round_half_up(d) == c).alias("round"),
        F.count_if(F.floor(d + 1e-9) == c).alias("floor"),
        F.array_sort(F.collect_set(round_to(d - c, 3))).alias("residuals"),
    )
    all_of = lambda k: F.col(k) == F.col("testable")
    mode = F.when(all_of("exact"), "exact").when(all_of("floor") & ~all_of("round"), "floor-cent").when(all_of("round") & ~all_of("floor"), "round-cent")
    rival = F.when(F.col("mode") == "exact", F.lit(0)).when(F.col("mode") == "floor-cent", F.col("round")).otherwise(F.col("floor"))
    named = out.withColumn("mode", mode).withColumn("margin", F.when(F.col("mode").isNull(), F.lit(0)).otherwise(F.col("testable") - rival))
    return named.withColumn("confident", F.when((F.col("mode") == "exact") | (F.col("margin") >= MIN_MARGIN), F.col("mode")))


def skeleton(rows: DataFrame) -> DataFrame:
    """Per location: rows, commodities, and the bands that its commodities' words call for."""
    low = F.lower("commodity")
    corn, bean, wheat = low.contains("corn"), low.contains("bean"), low.contains("wheat")
    return rows.groupBy("source_id", "location").agg(
        F.count("*").alias("rows"),
        F.array_sort(F.collect_set("commodity")).alias("commodities"),
        F.max(corn).alias("needs_corn"),
        F.max(~corn & bean).alias("needs_soybeans"),
        F.max(~corn & ~bean & wheat).alias("needs_wheat"),
    )


def agreement(now: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys of this run have the same mode as before, another one, or none before."""
    was = prior.select(*keys, F.coalesce("mode", F.lit("-")).alias("_was"))
    joined = now.select(*keys, F.coalesce("mode", F.lit("-")).alias("_is")).join(was, keys, "left")
    return joined.agg(
        F.count_if(F.col("_was") == F.col("_is")).alias("agree"),
        F.count_if(F.col("_was") != F.col("_is")).alias("differ"),
        F.count_if(F.col("_was").isNull()).alias("fresh"),
    )


def same_run(now: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """Whether all shared keys carry the same mode, testable count and margin; false if none is shared."""
    values = ["mode", "testable", "margin"]
    joined = now.select(*keys, *values).join(prior.select(*keys, *(F.col(v).alias(f"_{v}") for v in values)), keys)
    equal = F.lit(True)
    for v in values:
        equal = equal & F.col(v).eqNullSafe(F.col(f"_{v}"))
    return joined.agg(F.count("*").alias("shared"), F.coalesce(F.bool_and(equal), F.lit(False)).alias("same_run"))


def batch_tally(evidence: DataFrame, refused: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row for a batch of profiles: locations, rows, those with a confident rule, refused rows, names that are no towns."""
    own = evidence.agg(F.count("*").alias("locations"), F.sum("testable").alias("rows"), F.count_if(F.col("confident").isNotNull()).alias("confident"))
    parts = own.unionByName(refused.agg(F.count("*").alias("refused")), True).unionByName(flagged.agg(F.count("*").alias("flagged")), True)
    return parts.agg(*(F.max(c).alias(c) for c in ("locations", "rows", "confident", "refused", "flagged")))


def distinct_counts(rows: DataFrame) -> DataFrame:
    """Per source its distinct commodities and locations, and whether there is one town only."""
    found = rows.groupBy("source_id").agg(F.count_distinct("commodity").alias("commodities"), F.count_distinct("location").alias("locations"))
    return found.withColumn("sole_town", F.col("locations") == 1)
