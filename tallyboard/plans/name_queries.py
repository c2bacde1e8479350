"""Queries of names, keys and manifests over customers, suppliers and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions import places
from tallyboard.operators import generation
from tallyboard.plans.registry import query, read
from tallyboard.sources import lists, manifests

_NAMES = """names AS (SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 0 THEN 'Main' WHEN 1 THEN 'Cargill ' || c_mktsegment WHEN 2 THEN c_mktsegment || ' Ethanol' WHEN 3 THEN c_mktsegment || ' Grain Co-op' WHEN 4 THEN c_mktsegment || '/Elgin'
   WHEN 5 THEN 'Green Plains ' || c_custkey WHEN 6 THEN '' ELSE 'New ' || c_mktsegment END AS name FROM customer)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"WITH {_NAMES.replace('FROM customer', 'FROM {customer}')} SELECT * FROM names", customer=read(spark, sf_dir, "customer"))


@query(
    f"""WITH {_NAMES} SELECT k, name, CASE k % 8 WHEN 0 THEN 'placeholder' WHEN 1 THEN 'buyer' WHEN 2 THEN 'facility' WHEN 3 THEN 'suffix' WHEN 4 THEN 'joined' WHEN 5 THEN 'buyer' END AS kind,
    CASE k % 8 WHEN 0 THEN 'main' WHEN 1 THEN 'cargill' WHEN 2 THEN 'ethanol' WHEN 3 THEN 'grain' WHEN 5 THEN 'green plains' END AS word FROM names"""
)
def destination_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = names(spark, sf_dir).withColumn("d", places.destination_kind(F.col("name")))
    word = F.when(F.col("d.kind") == "suffix", F.when(F.col("d.word").isin("co-op", "coop", "grain", "co."), "grain")).otherwise(F.col("d.word"))
    return found.select("k", "name", F.col("d.kind").alias("kind"), word.alias("word"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE regexp_replace(lower(s_name), '[^a-z0-9]+', '', 'g') || '-' || regexp_replace(lower(n_name), '[^a-z0-9]+', '', 'g') END AS id FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    operator = F.when(F.col("s_suppkey") % 5 == 0, "SET THIS").otherwise(F.col("s_name"))
    return joined.select("s_suppkey", places.id_for(operator, F.col("n_name")).alias("id"))


@query(
    """WITH w AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)
    SELECT p_partkey, a || b || 'coop ' || a || upper(b[1:1]) || b[2:] || 'Coop ' || a || '-' || b || '-coop ' || a || b || ' ' || a || b || 'cooperative ' || a || upper(b[1:1]) || b[2:] || 'Cooperative ' || a || '-' || b || '-cooperative' AS variants FROM w"""
)
def slug_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.initcap("p_name"), F.lit(" Co-op, Inc."))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(places.slug_variants(name), " ").alias("variants"))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'imprecise' WHEN s_suppkey % 4 = 3 THEN 'missing' WHEN s_suppkey % 4 = 2 THEN 'other_operator' ELSE 'hit' END AS geo_status,
    CASE WHEN s_suppkey % 4 = 1 THEN 44.1234567::DOUBLE END AS lat FROM supplier"""
)
def geocode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    supplier = read(spark, sf_dir, "supplier")
    owner = F.when(k % 4 == 2, F.concat(F.lit("Other "), F.col("s_name"))).otherwise(F.col("s_name"))
    line = F.concat_ws("\t", owner, F.lit("u"), F.lit("p"), F.lit("a"), F.concat(F.when(k % 4 == 3, "Elsewhere ").otherwise("Town "), k.cast("string"), F.lit(", MN 55000")), F.lit("-93.7654321"), F.when(k % 4 == 0, "44.12").otherwise("44.1234567"))
    table = supplier.select(k.cast("string").alias("file"), F.concat(F.lit("# head\n"), line, F.lit("\nshort\tline")).alias("text"))
    entries = supplier.select("s_suppkey", F.col("s_name").alias("operator"), F.concat(F.lit("TOWN "), k.cast("string")).alias("location"))
    return lists.locate(entries, lists.geocodes(table, "file", "text")).select("s_suppkey", "geo_status", "lat")


_FATES = """WITH f AS (SELECT s_suppkey AS k FROM supplier)
SELECT CAST(k AS VARCHAR) AS site, CASE WHEN k % 6 = 0 THEN 'destination' WHEN k % 6 = 1 THEN 'no_id' WHEN k % 6 = 2 THEN 'same_key' WHEN k % 6 = 3 THEN 'id_exists' ELSE 'write' END AS fate,
  k % 2 = 0 AND k % 3 = 1 AS agreed, k % 6 <> 0 AND k % 5 <> 0 AS in_merge FROM f"""


@query(_FATES)
def manifest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    supplier, key = read(spark, sf_dir, "supplier"), k.cast("string")
    town = F.when(k % 6 == 0, "Cargill").otherwise(F.concat(F.lit("Town"), key))
    operator = F.when(k % 6 == 1, "SET THIS").otherwise(F.col("s_name"))
    entries = supplier.select(key.alias("site"), key.alias("location_id"), operator.alias("operator"), town.alias("location"), F.when(k % 2 == 0, "floor-cent").otherwise("-").alias("mode"))
    prior = supplier.where(k % 3 == 1).select(key.alias("site"), key.alias("location_id"), F.lit("floor-cent").alias("mode"))
    existing = supplier.where(k % 6 == 2).select(F.concat(F.lit("x"), key).alias("id"), key.alias("site"), key.alias("location_id")).unionByName(
        supplier.where(k % 6 == 3).select(places.id_for(operator, town).alias("id"), F.lit(None).cast("string").alias("site"), F.lit(None).cast("string").alias("location_id"))
    )
    covered = supplier.where(k % 5 == 0).select(F.lower(town).alias("town"))
    return generation.plan_manifests(entries, prior, existing, covered).select("site", "fate", "agreed", "in_merge")


_MANIFESTS = "SELECT CAST(s_suppkey AS VARCHAR) AS path, CASE s_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'no locationId' WHEN 2 THEN 'band inverted' WHEN 3 THEN 'half a coordinate' WHEN 4 THEN 'browserPage missing' ELSE 'relative url' END AS complaints FROM supplier"


@query(_MANIFESTS)
def manifest_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = F.concat(
        F.lit('{"id":"'), F.col("s_name"), F.lit('","operator":"o","location":"l","platform":"'), F.when(k % 6 == 4, "bushel").otherwise("aghost"), F.lit('","url":"'), F.when(k % 6 == 5, "x/y").otherwise("https://a.b/c"),
        F.lit('","bands":{"corn":['), F.when(k % 6 == 2, "9,2").otherwise("2,9"), F.lit(']},"lat":45.5,"lon":'), F.when(k % 6 == 3, "null").otherwise("-93.25"), F.when(k % 6 == 1, "").otherwise(',"locationId":null'), F.lit("}"),
    )
    texts = read(spark, sf_dir, "supplier").select(k.cast("string").alias("path"), raw.alias("raw"))
    return manifests.load(manifests.parse(texts)).select("path", F.array_join("complaints", ",").alias("complaints"))


@query("SELECT s_suppkey, s_suppkey * 2 AS testable, CASE WHEN s_suppkey % 2 = 0 THEN 'exact' ELSE 'floor-cent' END AS mode FROM supplier")
def log_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    mode = F.when(F.col("s_suppkey") % 2 == 0, "exact").otherwise("floor-cent")
    text = F.concat(F.lit("﻿2024-01-01T00:00:00.1Z ##[group]V S "), k, F.lit(" - 1 0\n2024-01-01T00:00:01Z \x1b[32m  V S "), k, F.lit(" "), mode, F.lit(" "), (F.col("s_suppkey") * 2).cast("string"), F.lit(" 3\x1b[0m"))
    found = lists.verdicts(read(spark, sf_dir, "supplier").select(k.alias("log"), text.alias("text")), "log", "text")
    return found.select(F.col("log").cast("long").alias("s_suppkey"), "testable", "mode")


@query("SELECT s_suppkey, 2 AS n, 'Fine Town ' || s_suppkey AS location, CASE WHEN s_suppkey % 3 = 1 THEN 'its manifest never closed' WHEN s_suppkey % 3 = 2 THEN 'no manifest followed its heading' END AS bad FROM supplier")
def probe_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    body = F.when(k % 3 == 0, '{\n  "siteId": "S{",\n  "x": {"y": 1}\n}\ntail').when(k % 3 == 1, '{\n "siteId": "S"\n').otherwise("nothing")
    text = F.concat(F.lit("start\n\n--- Fine Town "), k.cast("string"), F.lit(" (7) — 4 row(s): Corn\n"), body)
    found = lists.probe_log(read(spark, sf_dir, "supplier").select(k.alias("log"), text.alias("text")), "log", "text")
    return found.select(F.col("log").alias("s_suppkey"), F.col("n").cast("int").alias("n"), "location", "bad")


@query("SELECT s_suppkey, 2 AS line, 'nested mapping' AS why FROM supplier UNION ALL SELECT s_suppkey, 6, 'comment in a quoted string' FROM supplier")
def workflow_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("name: ok\nrun: a: b\nscript: |\n  echo: a: b\n\nsay: echo \"x #"), F.col("s_suppkey").cast("string"), F.lit('"\nlist: [a: b]\n'))
    found = lists.lint(read(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text")
    return found.select("s_suppkey", "line", "why")


@query("SELECT s_suppkey, 0 AS n, 'https://a.b/' || s_suppkey AS entry FROM supplier UNION ALL SELECT s_suppkey, 3, 'last' FROM supplier")
def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("https://a.b/"), F.col("s_suppkey").cast("string"), F.lit(" # why\r\n# comment\n\n last "))
    return lists.read_list(read(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("SELECT s_suppkey, 'S' || s_suppkey AS site, 'https://p' AS page, 'Some Operator' AS operator, NULL::VARCHAR AS bad FROM supplier UNION ALL SELECT s_suppkey, NULL, NULL, NULL, 'lonely' FROM supplier")
def probe_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"), F.lit(" https://p  Some Operator # c\nlonely"))
    return lists.probe_list(read(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text").select("s_suppkey", "site", "page", "operator", "bad")


@query("SELECT DISTINCT 'town' || (s_suppkey % 30) AS town FROM supplier")
def covered_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    town = F.concat(F.lit("Town "), (k % 30).cast("string"), F.lit(", MN"))
    text = F.when(k % 2 == 0, F.concat(F.lit("Facility|"), town)).otherwise(town)
    return lists.covered_towns(read(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("SELECT s_suppkey, 0 AS n, '3,13 * * * *' AS cron FROM supplier UNION ALL SELECT s_suppkey, 1, '*/' || (1 + s_suppkey % 9) || ' 1 * * 1-5' FROM supplier")
def workflow_crons(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("on:\n  schedule:\n    - cron: '3,13 * * * *'\n    - cron: \"*/"), (F.col("s_suppkey") % 9 + 1).cast("string"), F.lit(' 1 * * 1-5"\n'))
    return lists.crons(read(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE s_suppkey % 3 WHEN 0 THEN 'Corn' WHEN 1 THEN 'Corn (tons)' ELSE 'Corn' END AS commodity, 'Spot' || CASE WHEN s_suppkey % 3 = 2 THEN ' (Oct)' ELSE '' END AS delivery, 4.1 AS cash, -35 AS basis_cents, 445.0 AS futures_price FROM supplier".replace("4.1 AS", "4.1::DOUBLE AS").replace("445.0 AS", "445.0::DOUBLE AS"))
def json_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bid through the three JSON feeds."""
    from tallyboard.sources import feeds

    k = F.col("s_suppkey")
    nested = '{"locations":[{"id":1,"name":"T","groups":[{"displayName":"Corn","bidPriceUoM":"bu","bids":[{"description":"Spot","bidPrice":"4.1000","basisPrice":"-0.35","futuresPrice":"4.45"},{"description":"x"}]}]}]}'
    widget = '{"cashBids":[{"location":{"id":1,"name":"T"},"commodityDisplayName":"Corn","contractDeliveryLabel":"Spot","cashPrice":4.1,"basisPrice":-0.35,"futuresQuote":"445-0","unitOfMeasure":"tons"},{"location":{"id":1,"name":"T"},"commodityDisplayName":"Corn","contractDeliveryLabel":"Nov","cashPrice":4.1,"basisPrice":-0.35,"futuresQuote":"445-0","primaryPrice":{"cashPrice":9}}]}'
    offers = '[{"commodity":{"name":"Corn"},"offers":[{"destination":"T","deliveryPeriod":"Oct","comments":"Spot","standardCashPrice":"4.1","basisPrice":"-0.35","futuresPrice":"445"},{"destination":"T"}]}]'
    body = F.when(k % 3 == 0, F.lit(nested)).when(k % 3 == 1, F.lit(widget)).otherwise(F.lit(offers))
    platform = F.when(k % 3 == 0, "bushel").when(k % 3 == 1, "dtn-cs").otherwise("graindesk")
    bodies = read(spark, sf_dir, "supplier").select(k.cast("string").alias("source_id"), platform.alias("platform"), F.lit("u").alias("url"), body.alias("body"))
    return feeds.extract(bodies, ("bushel", "dtn-cs", "graindesk")).bids.select("source_id", "commodity", "delivery", "cash", "basis_cents", "futures_price")
