"""Landing tables: what a fetcher outside of Spark left, read as pages, responses and snapshots."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.text import host

PAGES = "source_id string, platform string, browser_page string, url string, status int, body string, fetched_at timestamp"
RESPONSES = "page string, n long, url string, status int, mime string, body string, truncated boolean, at timestamp"
SNAPSHOTS = "source_id string, bids_hash string, count long, priced_at timestamp, checked_at timestamp, observed timestamp"
#: Bodies of pages shorter than this are no board.
LEAST_HTML = 500


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).json(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSES).json(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshots; a row that does not read is no snapshot, and only its own source starts anew."""
    rows = spark.read.schema(SNAPSHOTS + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("source_id is not null").select("source_id", "bids_hash", "count", F.coalesce("priced_at", "observed").alias("priced_at"), "checked_at")


def snapshot_states(spark: SparkSession, folder: str, config: DataFrame) -> DataFrame:
    """For every source whether its snapshot is `present`, `unreadable` or `absent`, from a folder with one part a source.

    Only an absent one means a first run: after an unreadable one the price's clock is not known to start now.
    """
    names = config.select("source_id").distinct()
    try:
        rows = spark.read.schema("value string, source_id string").text(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return names.withColumn("state", F.lit("absent"))
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    found = rows.groupBy("source_id").agg(F.bool_or(is_object).alias("_reads"))
    state = F.when(F.col("_reads"), "present").when(~F.col("_reads"), "unreadable").otherwise("absent")
    return names.join(found, "source_id", "left").select("source_id", state.alias("state"))


def usable(pages: DataFrame, config: DataFrame) -> DataFrame:
    """For every source the first of its URLs, in order, whose page came and is long enough for its kind; of several good fetches of a URL the latest."""
    asked = config.select("source_id", "platform", "browser_page", "wire", F.posexplode("urls").alias("k", "url"))
    joined = asked.join(pages.select("browser_page", "url", "status", "body", "fetched_at"), ["browser_page", "url"])
    good = joined.where(F.col("status").between(200, 299) & ((F.col("wire") == "json") | (F.length("body") >= LEAST_HTML)))
    # Of fetches at one time, or at none, the greatest body: the same whatever order they come in.
    best = F.max_by(F.struct("url", "body"), F.struct((-F.col("k")).alias("k"), "fetched_at", "body"))
    return good.groupBy("source_id", "platform").agg(best.alias("p")).select("source_id", "platform", "p.*")


def api_url(base: Column, token: Column) -> Column:
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/public-sites/"), F.url_encode(token), F.lit("/cash-bids"))


def pack(text: Column) -> Column:
    """base64 of the UTF-8 of a text."""
    return F.base64(F.encode(text, "UTF-8"))


def unpack(packed: Column) -> Column:
    return F.decode(F.unbase64(packed), "UTF-8")


def survey(responses: DataFrame, page: str) -> DataFrame:
    """Responses and hosts of every page."""
    return responses.groupBy(page).agg(F.count("*").alias("responses"), F.count_distinct(host(F.col("url"))).alias("hosts"))
