"""Queries of what lands in files: pages by the data source, readers as table functions, counters of what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.plans.feed_queries import _bodies, _grid_body, _table_body, suppliers
from tallyboard.plans.poll_queries import _LAST, _states
from tallyboard.plans.registry import query
from tallyboard.sources import landed, table_functions
from tallyboard.sources.folders import write_lines
from tallyboard.sources.scratch import new_path

#: Fetches of each source, by rules on its key and the fetch: url, hour, status and length of the body; two of three sources are pages of HTML.
_FETCHES = """fetches AS (
  SELECT s_suppkey AS k, f, f % 2 AS place, CASE WHEN (s_suppkey * 7 + f * 5) % 11 < 4 THEN 500 WHEN (s_suppkey + f) % 13 = 0 THEN 404 ELSE 200 END AS status,
         (s_suppkey * 3 + f * f) % 24 AS hour, CASE WHEN (s_suppkey + 2 * f) % 5 = 0 THEN 40 ELSE 600 + f END AS size
  FROM {supplier} CROSS JOIN {fetch} WHERE s_suppkey % 17 <> 5)"""


@query(
    f"""WITH {_FETCHES.format(supplier="supplier", fetch="(SELECT unnest(range(6)) AS f) n")},
    good AS (SELECT * FROM fetches WHERE status = 200 AND (size >= 500 OR k % 3 = 0) AND k % 19 <> 7),
    best AS (SELECT k, min(place) AS place, arg_min(hour, (place, -hour, -size)) AS hour, arg_min(size, (place, -hour, -size)) AS size FROM good GROUP BY k)
    SELECT CAST(s.s_suppkey AS VARCHAR) AS source_id, CASE WHEN s.s_suppkey % 17 = 5 THEN 'absent' WHEN b.k IS NULL THEN 'unreadable' ELSE 'present' END AS state,
      CAST(b.place AS INT) AS place, 'https://board.example.com/' || s.s_suppkey || '/' || b.place AS url, CAST(b.size AS INT) AS size, CAST(b.hour AS INT) AS hour
    FROM supplier s LEFT JOIN best b ON s.s_suppkey = b.k"""
)
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six fetches a source over two URLs; of some sources nothing lands, of some only broken lines."""
    names = suppliers(spark, sf_dir).select("s_suppkey")
    fetch = spark.range(6).select(F.col("id").alias("f"))
    made = spark.sql("WITH " + _FETCHES.format(supplier="{supplier}", fetch="{fetch}") + " SELECT * FROM fetches", supplier=names, fetch=fetch)
    url = F.concat(F.lit("https://board.example.com/"), F.col("k").cast("string"), F.lit("/"), F.col("place").cast("string"))
    at = F.concat(F.lit("2024-01-02T"), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00:00+00:00"))
    line = F.to_json(F.struct(url.alias("url"), "status", F.repeat(F.lit("x"), F.col("size").cast("int")).alias("body"), at.alias("fetched_at")))
    folder, listed = new_path(spark), new_path(spark)
    broken = F.when(F.col("k") % 19 == 7, F.substring(line, 2, 1 << 20)).otherwise(line)
    write_lines(made.select(F.col("k").cast("string").alias("source_id"), broken.alias("value")), folder)
    urls = F.array(*(F.concat(F.lit("https://board.example.com/"), F.col("s_suppkey").cast("string"), F.lit(f"/{k}")) for k in range(2)))
    names.select(F.col("s_suppkey").cast("string").alias("source_id"), F.when(F.col("s_suppkey") % 3 == 0, "json").otherwise("html").alias("wire"), urls.alias("urls")).write.json(listed)
    landed.register(spark)
    found = spark.read.format("landed_pages").option("sources", listed).load(folder)
    return found.select("source_id", "state", "place", "url", F.length("body").alias("size"), F.hour("fetched_at").alias("hour"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 4 <> 3 THEN (-2 * (s_suppkey + 1000) + 0.25)::DOUBLE END AS \"offset\", CASE WHEN s_suppkey % 4 = 3 THEN 'no_offset' END AS code FROM supplier")
def offsets_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets of `grid_offsets` by the table function, its partitions by source."""
    table_functions.register(spark)
    return spark.sql("SELECT * FROM read_board(TABLE({bodies}) PARTITION BY (source_id), 'offsets')", bodies=_bodies(spark, sf_dir, _grid_body()))


@query(
    """WITH v(place, n, first) AS (VALUES (0, 1, 0), (1, 5, 5)), r AS (SELECT s_suppkey AS k, place, n + 3 * place * (1 - s_suppkey % 2) AS n, first FROM supplier, v)
    SELECT CAST(k AS VARCHAR) AS source_id, CAST(place AS INT) AS place, n AS rows, CASE place WHEN 0 THEN 1 ELSE 5 * (n - CASE n WHEN 5 THEN 2 ELSE 3 END) + CASE n WHEN 5 THEN 2 ELSE 3 END END AS cells, first AS headers FROM r"""
)
def cells_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, cells and header cells of every table, read by the table function and counted by SQL."""
    table_functions.register(spark)
    return spark.sql(
        """SELECT source_id, place, count(*) AS rows, sum(size(cells)) AS cells, sum(size(filter(cells, c -> c.header))) AS headers
        FROM read_board(TABLE({bodies}) PARTITION BY (source_id), 'tables') GROUP BY source_id, place""",
        bodies=_bodies(spark, sf_dir, _table_body()),
    )


@query(
    _LAST
    + """SELECT 'index' AS output, count(*) AS total, count(*) FILTER (health = 'live') AS live, count(*) FILTER (health = 'refused') AS refused, count(*) FILTER (health = 'broken') AS broken FROM s
    UNION ALL SELECT 'snapshots', count(*), count(*) FILTER (state <> 'down'), count(*) FILTER (state = 'live'), NULL FROM s"""
)
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that come with the writing of an index and of snapshots; nothing is read again for them."""
    from tallyboard.plans.engine import write_index, write_snapshots

    states = _states(spark, sf_dir).withColumnRenamed("user_id", "source_id")
    index = write_index(states, new_path(spark))
    decided = states.select("source_id", "health", (F.col("state") != "down").alias("write"), (F.col("state") == "live").alias("changed"))
    kept = write_snapshots(decided, new_path(spark))
    rows = [("index", index["total"], index["live"], index["refused"], index["broken"]), ("snapshots", kept["decided"], kept["written"], kept["changed"], None)]
    return spark.createDataFrame(rows, "output string, total long, live long, refused long, broken long")
