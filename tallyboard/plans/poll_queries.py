"""Queries over the events as polls: change, heartbeats, freshness, schedules, sessions.

A source is a user, a poll an event, its price the value in steps of fifty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions import times
from tallyboard.operators import changes, status
from tallyboard.plans.registry import query, read
from tallyboard.sources import feeds
from tallyboard.sources.folders import read_lines
from tallyboard.sources.scratch import new_path
from tallyboard.streaming import polls as stream

_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_POLLS = "polls AS (SELECT user_id, event_id, ts, event_type, CAST(floor(value / 50) AS BIGINT) AS price FROM events)"


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor(F.col("value") / 50).alias("price"))


def now() -> F.Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def stamp(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


_ISLANDS = f"""WITH {_POLLS},
l AS (SELECT *, lag(event_id) OVER w IS NULL OR price IS DISTINCT FROM lag(price) OVER w AS changed FROM polls WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(CAST(changed AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM l),
i AS (SELECT *, min(ts) OVER (PARTITION BY user_id, run) AS priced FROM r)
"""


@query(_ISLANDS + "SELECT user_id, count(*) FILTER (changed) AS islands, count(*) AS polls FROM i GROUP BY 1")
def change_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.islands(polls(spark, sf_dir), "user_id", "ts", "price", "event_id")
    return found.groupBy("user_id").agg(F.count_if("changed").alias("islands"), F.count("*").alias("polls"))


@query(_ISLANDS + "SELECT user_id, event_id, changed, strftime(priced, '%Y-%m-%d %H:%M:%S') AS priced_at FROM i")
def carried_priced_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.islands(polls(spark, sf_dir), "user_id", "ts", "price", "event_id")
    return found.select("user_id", "event_id", "changed", stamp("priced_at").alias("priced_at"))


_DECIDE = f"""WITH RECURSIVE {_POLLS},
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM polls),
d AS (
  SELECT user_id, event_id, ts, price, rn, ts AS checked, ts AS priced, true AS write, true AS changed, 'first run' AS reason FROM o WHERE rn = 1
  UNION ALL
  SELECT o.user_id, o.event_id, o.ts, o.price, o.rn,
    CASE WHEN o.price = d.price AND (epoch_us(o.ts) - epoch_us(d.checked)) / 3.6e9 BETWEEN 0 AND 5.999999999 THEN d.checked ELSE o.ts END,
    CASE WHEN o.price = d.price THEN d.priced ELSE o.ts END,
    NOT (o.price = d.price AND (epoch_us(o.ts) - epoch_us(d.checked)) / 3.6e9 BETWEEN 0 AND 5.999999999),
    o.price <> d.price,
    CASE WHEN o.price <> d.price THEN 'price moved' WHEN (epoch_us(o.ts) - epoch_us(d.checked)) / 3.6e9 < 6 THEN 'no change' ELSE 'heartbeat' END
  FROM d JOIN o ON o.user_id = d.user_id AND o.rn = d.rn + 1)
"""


@query(_DECIDE + "SELECT user_id, event_id, write, changed, reason, strftime(priced, '%Y-%m-%d %H:%M:%S') AS priced_at FROM d")
def heartbeat_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.decide(polls(spark, sf_dir), "user_id", "ts", "price", "event_id")
    return found.select("user_id", "event_id", "write", "changed", "reason", stamp("priced_at").alias("priced_at"))


@query(_DECIDE + "SELECT user_id, event_id, NOT changed AND (epoch_us(ts) - epoch_us(priced)) / 3.6e9 > 48 AS stale FROM d")
def stale_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.decide(polls(spark, sf_dir), "user_id", "ts", "price", "event_id", stale=48.0).select("user_id", "event_id", "stale")


@query(_DECIDE + "SELECT DISTINCT user_id FROM d WHERE write AND changed AND rn > 1")
def moved_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.decide(polls(spark, sf_dir), "user_id", "ts", "price", "event_id").where("reason <> 'first run'")
    return changes.moved_sources(found, "user_id")


@query(_DECIDE + "SELECT CAST(user_id AS VARCHAR) AS line FROM d WHERE write AND changed AND rn > 1 AND user_id % 3 = 1 GROUP BY user_id")
def moved_list_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of one run over the list of the run before, as the next step reads it."""
    decided = changes.decide(polls(spark, sf_dir), "user_id", "ts", "price", "event_id").where("reason <> 'first run'")
    folder = new_path(spark)
    changes.write_moved(decided.where("user_id % 3 = 0"), "user_id", folder)
    changes.write_moved(decided.where("user_id % 3 = 1"), "user_id", folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query(_DECIDE + "SELECT user_id, count(*) FILTER (write) AS writes, count(*) FILTER (changed) AS changes, user_id || ': ' || count(*) FILTER (changed) || ' moved, ' || count(*) FILTER (write AND NOT changed) || ' heartbeat' AS message FROM d GROUP BY 1")
def commit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.poll_message(changes.decide(polls(spark, sf_dir), "user_id", "ts", "price", "event_id"), "user_id")


_LAST = f"""WITH {_POLLS}, last AS (SELECT user_id, max(ts) AS seen_at, arg_max(event_type, (ts, event_id)) AS kind FROM polls GROUP BY 1),
f AS (SELECT user_id, seen_at, CASE kind WHEN 'error' THEN 'broken' WHEN 'signup' THEN 'refused' ELSE 'live' END AS health, (epoch_us({_NOW}) - epoch_us(seen_at)) / 3.6e9 AS age FROM last),
s AS (SELECT *, CASE WHEN health IN ('broken', 'refused') THEN CASE WHEN age >= 14 THEN 'down' ELSE 'late' END WHEN age < -0.25 OR age >= 14 THEN 'down' WHEN age >= 6 THEN 'late' ELSE 'live' END AS state FROM f)
"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = polls(spark, sf_dir).groupBy("user_id").agg(F.max("ts").alias("at"), F.max_by("event_type", F.struct("ts", "event_id")).alias("kind"))
    health = F.when(F.col("kind") == "error", "broken").when(F.col("kind") == "signup", "refused").otherwise("live")
    found = last.select("user_id", "at", health.alias("health"), times.age_hours(F.col("at"), now()).alias("age"))
    return found.withColumn("state", times.state_of(F.col("health"), F.col("at"), now()))


@query(_LAST + "SELECT user_id, health, floor(age * 1000) AS age_milli, state FROM s")
def freshness_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("user_id", "health", F.floor(F.col("age") * 1000).cast("double").alias("age_milli"), "state")


@query(_LAST + "SELECT count(*) AS total, count(*) FILTER (state = 'live') AS live, count(*) FILTER (state = 'late') AS late, count(*) FILTER (state = 'down') AS down, CASE WHEN bool_or(state = 'down') THEN 'down' WHEN bool_or(state = 'late') THEN 'late' ELSE 'live' END AS verdict FROM s")
def freshness_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.state_counts(_states(spark, sf_dir))


@query(_LAST + "SELECT count(*) AS total, count(*) FILTER (health = 'live') AS live, count(*) FILTER (health = 'refused') AS refused, count(*) FILTER (health = 'broken') AS broken FROM s")
def health_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyboard.plans.engine import counts

    return counts(_states(spark, sf_dir))


@query(_LAST + "SELECT user_id, state, row_number() OVER (ORDER BY CASE state WHEN 'down' THEN 1 WHEN 'late' THEN 2 ELSE 3 END, health, user_id) AS place FROM s")
def status_board_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.ordered(_states(spark, sf_dir), ["health", "user_id"]).select("user_id", "state", "place")


_AGO = "CASE WHEN m < 1 THEN 'just now' WHEN m = 1 THEN '1 minute ago' WHEN m < 90 THEN m || ' minutes ago' ELSE (m // 60) || 'h ' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || 'm ago' END"


@query(f"WITH m AS (SELECT event_id, CAST(floor((epoch_us({_NOW}) - epoch_us(ts)) / 6e7 + 0.5) AS BIGINT) AS m FROM events) SELECT event_id, {_AGO} AS ago FROM m")
def ago_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls(spark, sf_dir).select("event_id", times.ago_words(times.hours_between(now(), F.col("ts")) * 60).alias("ago"))


@query(
    """WITH m AS (SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 12:00:00')) / 6e7 + 0.5) AS BIGINT) AS m FROM events)
    SELECT event_id, CASE WHEN m > 1 THEN 'next run due in ' || m || ' minutes' WHEN m = 1 THEN 'next run due in a minute' WHEN m = 0 THEN 'next run due now' WHEN m = -1 THEN 'next run was due 1 minute ago'
      WHEN m > -90 THEN 'next run was due ' || (-m) || ' minutes ago' ELSE 'next run was due ' || (-m // 60) || 'h ' || lpad(CAST(-m % 60 AS VARCHAR), 2, '0') || 'm ago' END AS due FROM m"""
)
def due_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    return polls(spark, sf_dir).select("event_id", times.due_words(times.hours_between(F.col("ts"), noon) * 60).alias("due"))


@query("SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%Y-%m-%d') AS day, strftime(ts - INTERVAL 6 HOUR, '%H:%M:%S') AS time, 'CST' AS zone FROM events")
def local_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls(spark, sf_dir).select("event_id", F.inline(F.array(times.local_parts(F.col("ts")))))


#: Four zones, two of them south of the equator or without a summer time, over two years of times.
_ZONES = ["America/New_York", "America/Denver", "Europe/London", "Australia/Sydney", "Asia/Kolkata"]
_ZONED = f"""z AS (SELECT event_id, CASE event_id % 5 {" ".join(f"WHEN {k} THEN '{z}'" for k, z in enumerate(_ZONES))} END AS zone,
    CASE event_id % 7 WHEN 0 THEN TIMESTAMP '2024-03-10 06:59:30' + to_seconds(event_id % 60) WHEN 1 THEN TIMESTAMP '2024-10-27 00:59:30' + to_seconds(event_id % 60)
      WHEN 2 THEN TIMESTAMP '2024-04-06 15:59:30' + to_seconds(event_id % 60) ELSE ts + to_days(CAST(event_id % 700 AS INT)) END AS utc FROM events)"""


@query(
    f"""WITH {_ZONED}, l AS (SELECT *, timezone(zone, timezone('UTC', utc)) AS here FROM z), o AS (SELECT *, CAST((epoch_us(here) - epoch_us(utc)) // 60000000 AS BIGINT) AS m FROM l)
    SELECT event_id, zone, strftime(here, '%Y-%m-%d') AS day, strftime(here, '%H:%M:%S') AS time,
      CASE zone WHEN 'America/New_York' THEN CASE m WHEN -240 THEN 'EDT' ELSE 'EST' END WHEN 'America/Denver' THEN CASE m WHEN -360 THEN 'MDT' ELSE 'MST' END
        ELSE 'GMT' || CASE WHEN m = 0 THEN '' ELSE '+' || (m // 60) || CASE WHEN m % 60 = 0 THEN '' ELSE ':' || (m % 60) END END END AS abbreviation FROM o"""
)
def zone_abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks in five zones over two years; three sevenths of the times lie around a change of the hour."""
    from tallyboard.functions.zones import local_clocks, zone_changes

    m = F.col("event_id") % 7
    second = (F.col("event_id") % 60).cast("long") * 1_000_000
    around = lambda t: F.timestamp_micros(F.unix_micros(F.lit(t).cast("timestamp")) + second)
    later = F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 700).cast("long") * 86_400_000_000)
    utc = F.when(m == 0, around("2024-03-10 06:59:30")).when(m == 1, around("2024-10-27 00:59:30")).when(m == 2, around("2024-04-06 15:59:30")).otherwise(later)
    zone = F.element_at(F.array(*map(F.lit, _ZONES)), (F.col("event_id") % 5 + 1).cast("int"))
    rows = polls(spark, sf_dir).select("event_id", zone.alias("zone"), utc.alias("utc"))
    found = local_clocks(rows, "utc", "zone", zone_changes(spark, _ZONES, 2023, 2026))
    return found.select("event_id", "zone", F.col("local_day").alias("day"), F.col("local_time").alias("time"), F.col("local_zone").alias("abbreviation"))


#: Names of which accents, case and punctuation decide the order.
_NAMES = ["Zoë", "zoe", "Zoe", "Émile", "emil", "Emil", "Ångström", "angstrom", "co-op", "Coop", "co op", "Öl", "ol", "Straße", "Strasse", "ñandú", "nandu", "_x", "10", "2"]


@query(
    _LAST
    + f"""SELECT user_id, name, row_number() OVER (ORDER BY CASE state WHEN 'down' THEN 1 WHEN 'late' THEN 2 ELSE 3 END, icu_sort_key(name, 'en'), encode(name), user_id) AS place
    FROM (SELECT user_id, state, ([{", ".join(f"'{n}'" for n in _NAMES)}])[user_id % {len(_NAMES)} + 1] AS name FROM s)"""
)
def status_board_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("user_id") % len(_NAMES) + 1).cast("int"))
    named = _states(spark, sf_dir).withColumn("name", name)
    return status.ordered(named, ["name", "user_id"]).select("user_id", "name", "place")


@query(
    """WITH t AS (SELECT event_id, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS f FROM events),
    c AS (SELECT event_id, f, unnest(generate_series(date_trunc('hour', f), date_trunc('hour', f) + INTERVAL 4 DAY, INTERVAL 1 HOUR)) AS h FROM t),
    m AS (SELECT event_id, f, h + to_minutes(CAST(x AS BIGINT)) AS fire FROM c, (VALUES (3), (23), (43)) v(x) WHERE hour(h) BETWEEN 12 AND 20 AND dayofweek(h) BETWEEN 1 AND 5)
    SELECT event_id, strftime(min(fire), '%Y-%m-%d %H:%M:%S') AS fires FROM m WHERE fire >= f GROUP BY 1"""
)
def cron_next_fire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls(spark, sf_dir).select("event_id", stamp(times.next_fire(times.schedules(spark, ["3-59/20 12-20 * * 1-5"]), F.col("ts"))).alias("fires"))


@query("SELECT event_id, minute(ts) % 10 = 3 AND (day(ts) IN (1, 15) OR dayofweek(ts) = 0) AS fires FROM events")
def cron_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls(spark, sf_dir).select("event_id", times.cron_matches(F.lit("3-59/10 * 1,15 * 7"), F.col("ts")).alias("fires"))


@query(
    """WITH l AS (SELECT user_id, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 3600 * 6000000::BIGINT, true) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM l)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS quiet_at, count(*) AS n_responses FROM s GROUP BY user_id, n"""
)
def session_quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream.quiet_sessions(polls(spark, sf_dir), "user_id", "ts", "6 hours")
    return found.select("user_id", stamp("started").alias("started"), stamp("quiet_at").alias("quiet_at"), "n_responses")


@query("WITH w AS (SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events) SELECT event_id, (epoch_us(nxt) - epoch_us(ts)) // 60000000 AS minutes FROM w")
def gap_to_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.gaps(polls(spark, sf_dir), "user_id", "ts", "event_id").select("event_id", "minutes")


@query("SELECT user_id, count(*) AS n, count(DISTINCT CAST(json_extract(props, '$.k') AS BIGINT)) AS kinds, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS most FROM events GROUP BY 1")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct(k).alias("kinds"), F.max(k).alias("most"))


@query("SELECT event_id, event_id % 3 <> 0 AS has_key, CASE WHEN event_id % 3 = 1 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def json_missing_vs_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 3
    raw = F.when(m == 0, F.lit('{"j": 1}')).when(m == 1, F.col("props")).otherwise(F.lit('{"k": null}'))
    rows = read(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", F.array_contains(F.json_object_keys("raw"), "k").alias("has_key"), F.try_variant_get(F.try_parse_json("raw"), "$.k", "bigint").alias("k"))


_BODIES = """bodies AS (SELECT event_id // 50 AS page, list({'id': user_id, 'n': event_type, 'e': event_id} ORDER BY event_id) AS rows FROM events GROUP BY 1)"""


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    row = F.struct(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name")).alias("location"), "value")
    return rows.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))), lambda x: x["r"]).alias("bids"))).alias("body"))


@query(f"WITH {_BODIES}, r AS (SELECT page, unnest(rows) AS x FROM bodies) SELECT page, CAST(x.id AS VARCHAR) AS place_id, arg_min(x.n, x.e) AS name FROM r GROUP BY page, x.id")
def roster_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.roster(_bodies(spark, sf_dir), "page", "body")


@query(f"WITH {_BODIES}, r AS (SELECT page, unnest(rows) AS x FROM bodies) SELECT page, count(DISTINCT x.id) AS locations FROM r GROUP BY page")
def count_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.count_locations(_bodies(spark, sf_dir), "page", "body")


@query(
    """WITH a AS (SELECT event_id, event_id % 6 AS m FROM events)
    SELECT event_id, CASE m WHEN 0 THEN 'no such token' WHEN 1 THEN 'HTTP 503' WHEN 2 THEN '200 but not JSON' WHEN 3 THEN '200 but not an array' WHEN 4 THEN 'HIT' ELSE 'fetch failed' END AS verdict FROM a"""
)
def response_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("event_id", "verdict")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 6
    code = F.when(m == 0, 401).when(m == 1, 503).when(m == 5, 0).otherwise(200)
    body = F.when(m == 2, F.lit("<html>")).when(m == 3, F.col("props")).when(m == 4, F.concat(F.lit("["), F.col("props"), F.lit("]")))
    return read(spark, sf_dir, "events").select("event_id", code.alias("status"), feeds.response_verdict(code, body).alias("verdict"))


@query("SELECT event_type AS platform, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS place FROM events GROUP BY 1")
def platform_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.tally(read(spark, sf_dir, "events").withColumnRenamed("event_type", "platform"), "platform")


@query("SELECT user_id, count(*) AS offers, count(DISTINCT event_type) AS destinations, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS names FROM events GROUP BY 1")
def sweep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.sweep_summary(read(spark, sf_dir, "events"), "user_id", "event_type").withColumn("names", F.array_join("names", ","))


@query("WITH u AS (SELECT user_id, event_id, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events) SELECT event_id, n >= 100 AND n < 350 AS asked FROM u")
def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyboard.operators.discovery import page_slice

    return page_slice(read(spark, sf_dir, "events").select("event_id"), "event_id", 100, 250)


@query("WITH h AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS token FROM events WHERE event_type = 'purchase' AND value > 150), c(token) AS (VALUES ('1'), ('2'), ('3'), ('5'), ('8'), ('9999')) SELECT token FROM c WHERE token NOT IN (SELECT token FROM h)")
def lost_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyboard.operators.discovery import control_report

    hits = read(spark, sf_dir, "events").where("event_type = 'purchase' and value > 150").select(F.col("user_id").cast("string").alias("token"), F.lit("HIT").alias("verdict"))
    return control_report(hits, ["1", "2", "3", "5", "8", "9999"])


@query("SELECT token FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS token FROM events UNION SELECT * FROM (VALUES ('7'), ('alpha'), ('beta')) v(t))")
def tokens_with_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("token"))
    return status.with_controls(tokens, ["7", "alpha", "beta"]).select("token")


@query("WITH t AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS token FROM events WHERE user_id % 3 <> 1), c(token) AS (VALUES ('3'), ('7'), ('12'), ('alpha')) SELECT token, false AS added FROM t UNION ALL SELECT token, true FROM c WHERE token NOT IN (SELECT token FROM t)")
def controls_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read(spark, sf_dir, "events").where("user_id % 3 <> 1").select(F.col("user_id").cast("string").alias("token"))
    return status.with_controls(tokens, ["3", "7", "12", "alpha"])


@query("SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'HTTP 503' WHEN 2 THEN '200 but not JSON' WHEN 3 THEN '200 but not an array' ELSE 'fetch failed' END AS verdict FROM events WHERE event_id % 6 NOT IN (0, 4)")
def sweep_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.leads(_answers(spark, sf_dir)).select("event_id", "verdict")


_CAPTURES = f"""WITH {_POLLS},
g AS (SELECT user_id, ts, min(ts) OVER w AS opened, epoch_us(ts) - epoch_us(lag(ts) OVER (w ORDER BY ts, event_id)) >= 6 * 3600000000::BIGINT AS late FROM polls WINDOW w AS (PARTITION BY user_id)),
s AS (SELECT *, count(*) FILTER (late) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS before FROM g ORDER BY ts),
e AS (SELECT user_id, opened, count(*) AS n_responses, max(ts) AS last FROM s WHERE before = 0 AND ts < opened + INTERVAL 20 HOUR GROUP BY 1, 2)
SELECT user_id, n_responses, strftime(least(last + INTERVAL 6 HOUR, opened + INTERVAL 20 HOUR), '%Y-%m-%d %H:%M:%S') AS ended, last + INTERVAL 6 HOUR <= opened + INTERVAL 20 HOUR AS quiet FROM e
"""


@query(_CAPTURES)
def capped_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = polls(spark, sf_dir)
    opened = rows.groupBy("user_id").agg(F.min("ts").alias("opened"))
    found = stream.captures(rows.join(opened, "user_id"), "user_id", "ts", "opened", 6 * 3600, 20 * 3600)
    return found.select("user_id", "n_responses", stamp("ended").alias("ended"), "quiet")


@query(_DECIDE + "SELECT user_id, event_id, write, changed, reason, strftime(priced, '%Y-%m-%d %H:%M:%S') AS priced_at FROM d")
def streamed_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The write rule run as a stream over the whole table in one available-now batch; equals `heartbeat_writes`."""
    import uuid

    from tallyboard.sources.scratch import folder

    schema = read(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.floor(F.col("value") / 50).alias("price"))
    out = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    decided = stream.decide_stream(source, "user_id", "ts", "price", "event_id")
    run = decided.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    found = spark.read.schema(decided.schema).parquet(f"{out}/rows")
    return found.select("user_id", "event_id", "write", "changed", "reason", stamp("priced_at").alias("priced_at"))


@query(
    """WITH r AS (SELECT user_id, count(*) AS n, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS early, max(event_id) AS last FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS run, CASE WHEN user_id % 3 = 0 THEN n ELSE early END AS rows FROM r WHERE user_id % 3 = 0 OR early > 0"""
)
def snapshots_after_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run writes a third of the sources, skips a third and does not have the last: these keep their snapshots."""
    from tallyboard.plans.engine import write_snapshots

    events, folder = read(spark, sf_dir, "events"), new_path(spark)
    board = lambda rows, run: rows.groupBy("user_id").agg(F.count("*").alias("rows")).select(F.col("user_id").alias("source_id"), "rows", F.lit(run).alias("run"))
    write_snapshots(board(events.where("ts < timestamp_ntz '2024-01-15'"), 1).withColumn("write", F.lit(True)), folder)
    write_snapshots(board(events.where("user_id % 3 < 2"), 2).withColumn("write", F.col("source_id") % 3 == 0), folder)
    kept = F.from_json("value", "rows bigint, run int")
    return read_lines(spark, folder).select(F.col("source_id").cast("bigint").alias("user_id"), kept.alias("kept")).select("user_id", "kept.run", "kept.rows")
