"""Queries that replay tables as streams: timers of silent sources, feeds seen again, publications that no poll confirms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.plans.page_queries import _CRAWL, _SIGNED, crawl
from tallyboard.plans.poll_queries import _DECIDE, polls, stamp
from tallyboard.plans.registry import query
from tallyboard.streaming.confirmations import confirmations, first_responses
from tallyboard.streaming.replay import replay
from tallyboard.streaming.silence import decide_with_silence

#: The quarter of the month in which a row lies, from 0 to 3.
_QUARTER = "CAST(least(3, floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 648e9)) AS BIGINT)"


def _quarters(rows: DataFrame) -> DataFrame:
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return rows.withColumn("quarter", F.least(F.lit(3), F.floor((F.unix_micros("ts") - start) / 648e9)))


@query(
    _DECIDE
    + """, n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt, (SELECT max(ts) FROM polls) AS upto FROM d),
    quiet AS (
      SELECT user_id, NULL::BIGINT AS event_id, ts + INTERVAL 6 HOUR AS said, true AS write, false AS changed, 'heartbeat: no poll' AS reason, priced, ts + INTERVAL 6 HOUR >= priced + INTERVAL 48 HOUR AS stale
      FROM n WHERE ts + INTERVAL 6 HOUR <= coalesce(nxt, upto)
      UNION ALL
      SELECT user_id, NULL, priced + INTERVAL 48 HOUR, true, false, 'stale: no poll', priced, true FROM n WHERE priced + INTERVAL 48 HOUR > ts AND priced + INTERVAL 48 HOUR <= coalesce(nxt, upto)),
    every AS (
      SELECT user_id, event_id, ts AS said, write, changed, reason, priced, NOT changed AND (epoch_us(ts) - epoch_us(priced)) / 3.6e9 > 48 AS stale FROM d
      UNION ALL SELECT * FROM quiet)
    SELECT user_id, event_id, strftime(said, '%Y-%m-%d %H:%M:%S') AS said_at, write, changed, reason, strftime(priced, '%Y-%m-%d %H:%M:%S') AS priced_at, stale FROM every"""
)
def silent_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month in four batches; the rows of silence come from timers or from what a later batch shows to have been due."""
    rows = _quarters(polls(spark, sf_dir).select("user_id", "event_id", "ts", F.col("price").cast("long").alias("price")))
    parts = [{"polls": rows.where(F.col("quarter") == k).drop("quarter")} for k in range(4)]
    found = replay(spark, parts, lambda s: decide_with_silence(s["polls"], "user_id", "ts", "price", "event_id", stale=48.0))
    return found.select("user_id", "event_id", stamp("ts").alias("said_at"), "write", "changed", "reason", stamp("priced_at").alias("priced_at"), "stale")


@query(
    f"""WITH {_CRAWL}, {_SIGNED}
    SELECT DISTINCT page, platform, CASE platform WHEN 'dtn-cs' THEN regexp_extract(url, '/sites/([^/]+)/', 1) WHEN 'bushel' THEN 'GetBidsList' END AS ident FROM signed WHERE platform IS NOT NULL"""
)
def feeds_seen_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls that share a third of their responses give every feed of the batch operator once."""
    at = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + (F.col("n") % 86400) * 1_000_000)
    rows = crawl(spark, sf_dir).select("page", "n", "url", "status", "mime", "body", at.alias("at"))
    parts = [{"responses": rows.where(F.col("n") % 3 <= 1)}, {"responses": rows.where(F.col("n") % 3 >= 1)}]
    return replay(spark, parts, lambda s: first_responses(s["responses"], "page", "at", "2 days").select("page", "platform", "ident"))


@query(
    f"""WITH e AS (SELECT *, {_QUARTER} AS quarter FROM events),
    intime AS (SELECT * FROM e WHERE NOT (event_id % 17 = 0 AND quarter = 0)),
    upto AS (SELECT least(max(ts) FILTER (event_type = 'purchase'), max(ts) FILTER (event_type <> 'purchase')) - INTERVAL 14 HOUR AS w FROM e),
    c AS (
      SELECT p.event_id, p.ts, count(q.event_id) AS n FROM intime p LEFT JOIN intime q
        ON p.user_id = q.user_id AND q.event_type <> 'purchase' AND q.ts >= p.ts AND q.ts <= p.ts + INTERVAL 14 HOUR WHERE p.event_type = 'purchase' GROUP BY ALL)
    SELECT event_id, n AS confirmations, n = 0 AS withdrawn FROM c, upto WHERE n > 0 OR ts + INTERVAL 14 HOUR < w"""
)
def withdrawn_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as publications, all other events as polls. A seventeenth of the first quarter comes with the last one, is too late and dropped."""
    rows = _quarters(polls(spark, sf_dir))
    late = (F.col("event_id") % 17 == 0) & (F.col("quarter") == 0)
    batch = F.when(late, 3).otherwise(F.col("quarter"))
    sold = F.col("event_type") == "purchase"
    parts = [{"published": rows.where((batch == k) & sold).select("user_id", "event_id", "ts"), "polls": rows.where((batch == k) & ~sold).select("user_id", "ts")} for k in range(4)]
    found = replay(spark, parts, lambda s: confirmations(s["published"], s["polls"], "user_id", "ts"))
    return found.groupBy("event_id").agg(F.count("confirmed_at").alias("confirmations"), F.bool_and("withdrawn").alias("withdrawn"))
