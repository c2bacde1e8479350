"""Streams of responses and of publications: one feed an identity, and publications that no poll confirms in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.times import WITHDRAW_H
from tallyboard.operators.discovery import identity, signature


def first_responses(responses: DataFrame, page: str, at: str, within: str) -> DataFrame:
    """A stream's responses of known feeds, one for each page, platform and identity: what comes again, in this batch or a later one, is dropped.

    State of an identity is kept until the watermark is `within` past its first response, so a crawl that runs into
    the next one does not bring the same feed twice, and state does not grow with the age of the stream.
    """
    known = responses.withColumn("platform", signature(F.col("url"))).where("platform is not null")
    known = known.withColumn("ident", identity(F.col("platform"), F.col("url")))
    return known.withWatermark(at, within).dropDuplicatesWithinWatermark([page, "platform", "ident"])


def confirmations(published: DataFrame, polls: DataFrame, key: str, at: str, hours: float = WITHDRAW_H, late: str | None = None) -> DataFrame:
    """Every publication with the time of each poll of its source within `hours`; one that has none is withdrawn and has a null time.

    Both streams have the key and the time `at`; `published` keeps its further columns. A withdrawn row comes when the watermark, `late` behind the
    slower stream (`hours` where it is not given), says that no poll can come any more; rows that come later than that are dropped. On tables
    it is a left join, and every publication without a poll is withdrawn.
    """
    wait = late or f"{int(hours * 3600)} seconds"
    asked = published.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, wait)
    seen = polls.select(F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("confirmed_at")).withWatermark("confirmed_at", wait)
    in_time = (F.col("confirmed_at") >= F.col(at)) & (F.col("confirmed_at") <= F.col(at) + F.expr(f"INTERVAL {int(hours * 3600)} SECONDS"))
    joined = asked.join(seen, (F.col(key) == F.col("_key")) & in_time, "left")
    return joined.drop("_key").withColumn("withdrawn", F.col("confirmed_at").isNull())
