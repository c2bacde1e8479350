"""From profiles to manifests: what is written, what is skipped and why."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.places import destination_kind, id_for


def plan_manifests(entries: DataFrame, prior: DataFrame, existing: DataFrame, covered: DataFrame, same_run: bool = False) -> DataFrame:
    """Entries (operator, location, site, location_id, mode, ...) with id, fate and cash_rounding.

    Fates in order: destination, no_id, same_key (another file reads the same site and location),
    id_exists, write. A rounding rule is stated only if two runs that are not the same agree on it.
    `prior` has site, location_id, mode; `existing` id, site, location_id; `covered` town slugs.
    """
    from tallyboard.functions.text import slug

    key = ["site", "location_id"]
    was = prior.select(*key, F.col("mode").alias("prior_mode"))
    by_key = existing.where("site is not null and location_id is not null").groupBy(*key).agg(F.min("id").alias("_reads"))
    by_id = existing.select("id").distinct().withColumn("_there", F.lit(True))
    towns = covered.select(F.col("town").alias("_town")).distinct().withColumn("_covered", F.lit(True))
    named = entries.withColumns({"id": id_for(F.col("operator"), F.col("location")), "_kind": destination_kind(F.col("location"))["kind"], "_town": slug(F.col("location"))})
    joined = named.join(was, key, "left").join(by_key, key, "left").join(by_id, "id", "left").join(towns, "_town", "left")
    fate = F.when(F.col("_kind").isNotNull(), "destination").when(F.col("id").isNull(), "no_id").when(F.col("_reads").isNotNull(), "same_key").when(F.col("_there"), "id_exists").otherwise("write")
    stated = F.coalesce(F.col("mode").isNotNull() & (F.col("mode") != "-") & (F.col("mode") == F.col("prior_mode")), F.lit(False))
    agreed = stated & ~F.lit(same_run)
    return joined.withColumns(
        {"fate": fate, "agreed": agreed, "cash_rounding": F.when(agreed, F.col("mode")), "in_merge": ~F.coalesce("_covered", F.lit(False)), "enabled": F.lit(False)}
    ).drop("_kind", "_town", "_reads", "_there", "_covered")


def note(planned: DataFrame) -> DataFrame:
    """The evidence behind each manifest that is to be written, as text."""
    rounding = (
        F.when(F.col("agreed"), F.concat(F.lit("cash rounding "), F.col("mode"), F.lit(" was read by two runs")))
        .when(F.col("mode").isNotNull() & (F.col("mode") != "-"), F.concat(F.lit("cash rounding is left open: this run read "), F.col("mode"), F.coalesce(F.concat(F.lit(", an earlier one "), F.col("prior_mode")), F.lit(", and there is no earlier run"))))
        .otherwise("cash rounding is left open: no rule explains every row")
    )
    return planned.where("fate = 'write'").withColumn("note", F.concat_ws(". ", F.concat(F.lit("site "), F.col("site"), F.lit(", location "), F.col("location_id")), rounding))


def written_ids(spark, folder: str) -> DataFrame:
    """Ids of the manifests in a folder; none where there is no folder yet."""
    try:
        return spark.read.schema("id string, enabled boolean").json(folder).select("id").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "id string")


def write_manifests(noted: DataFrame, folder: str) -> None:
    """The manifests of `note` as JSON, each in a folder of its id, all switched off. One that is there is never overwritten.

    Of several entries with one id the least by site and location is written.
    """
    spark = noted.sparkSession
    rank = F.struct("site", "location_id")
    rows = noted.where("fate = 'write'").select("id", "operator", "location", F.col("site").alias("siteId"), F.col("location_id").alias("locationId"), F.col("cash_rounding").alias("cashRounding"), F.col("in_merge").alias("inMerge"), F.lit(False).alias("enabled"), "note", rank.alias("_rank"))
    kept = [c for c in rows.columns if c not in ("id", "_rank")]
    one = rows.groupBy("id").agg(F.min_by(F.struct(*kept), "_rank").alias("m")).select("id", "m.*")
    new = one.join(written_ids(spark, folder), "id", "left_anti")
    new.write.mode("append").partitionBy("id").json(folder)
