"""The board on which operators are exercised: bids derived from line items, in exact eighths of a cent.

A source is a supplier, its town the supplier's nation, a commodity a type of part, a delivery the month of
shipment. Quotes have a fraction of a cent; cash is the arithmetic of quote and basis, taken exactly, cut or
rounded to cents by the source's number. A few rows are spoiled by rules on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Part type: commodity and level in cents.
CROPS = {"ECONOMY": ("Corn", 400), "SMALL": ("Soybeans", 1000), "MEDIUM": ("Hard Winter Wheat", 550), "LARGE": ("Soybean Meal", 900), "PROMO": ("Milo", 380), "STANDARD": ("Straw", 100)}


def _case(column: str, values: dict, default: str = "NULL") -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + f" ELSE {default} END"


_NAME = _case("p_type", {k: v[0] for k, v in CROPS.items()})
_LEVEL = _case("p_type", {k: v[1] for k, v in CROPS.items()}, "100")

#: A common table expression that both engines run; the first names differ in the month's format alone.
_BOARD = """
raw AS (
  SELECT l_suppkey AS source_id, l_orderkey AS order_key, l_linenumber AS line, l_orderkey * 8 + l_linenumber AS seq, CAST(l_partkey AS BIGINT) * 100000000 + CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS place,
         {name} AS commodity, {month} AS delivery, n_name AS location, CAST(n_nationkey AS STRING) AS location_id,
         8 * (({level}) + CAST(floor(l_extendedprice / 1000) AS BIGINT)) + l_linenumber % 8 AS fut_e8,
         -5 * CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS basis_cents,
         CASE l_returnflag WHEN 'A' THEN 'MAR 24 corn' WHEN 'N' THEN 'MAY 24' ELSE '' END AS futures,
         CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE concat(CAST(l_orderkey % 12 AS STRING), ':00') END AS futures_at
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
priced AS (
  SELECT *, CASE source_id % 3 WHEN 0 THEN fut_e8 + 8 * basis_cents
                 WHEN 1 THEN 8 * CAST(floor((fut_e8 + 8 * basis_cents) / 8.0) AS BIGINT)
                 ELSE 8 * CAST(floor((fut_e8 + 8 * basis_cents) / 8.0 + 0.5) AS BIGINT) END AS cash_e8
  FROM raw),
board AS (
  SELECT source_id, order_key, line, seq, place, commodity, delivery, location, location_id, futures, futures_at, basis_cents, fut_e8, cash_e8,
         CAST(cash_e8 AS DOUBLE) / 800 AS cash, CAST(basis_cents AS DOUBLE) / 100 AS basis,
         CAST(fut_e8 + CASE WHEN source_id % 6 = 0 AND order_key % 5 = 0 THEN 2 WHEN source_id % 30 = 15 AND order_key % 4 = 0 THEN -9 ELSE 0 END AS DOUBLE) / 8 AS futures_price
  FROM priced)
"""

BOARD_SQL = _BOARD.format(name=_NAME, level=_LEVEL, month="strftime(l_shipdate, '%Y-%m')")
_SPARK_SQL = "WITH " + _BOARD.format(name=_NAME, level=_LEVEL, month="date_format(l_shipdate, 'yyyy-MM')")


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of the line items; the three lookups are small tables that Spark may broadcast by their size."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "supplier", "nation")}
    text = _SPARK_SQL
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(text + " SELECT * FROM board", **tables)


ROUGH_SQL = (
    BOARD_SQL
    + """,
rough AS (
  SELECT CASE WHEN source_id % 37 = 11 THEN source_id - 1 ELSE source_id END AS source_id, seq, place, CASE WHEN source_id % 7 = 0 THEN '' ELSE location_id END AS location_id,
         CASE WHEN source_id % 21 = 7 AND order_key % 2 = 0 THEN 'Elsewhere' ELSE location END AS location,
         commodity, delivery,
         CASE WHEN order_key % 301 = 0 AND source_id % 5 = 1 THEN NULL
              WHEN source_id % 19 = 3 AND order_key % 50 = 0 THEN cash * 10
              WHEN source_id % 23 = 7 AND commodity = 'Milo' THEN cash + 50 ELSE cash END AS cash,
         basis, CASE WHEN source_id % 29 = 4 THEN basis_cents * 100 ELSE basis_cents END AS basis_cents, futures, futures_at,
         CASE WHEN order_key % 97 = 0 THEN 0
              WHEN source_id % 19 = 3 AND order_key % 50 = 0 THEN futures_price + cash * 900
              WHEN source_id % 23 = 7 AND commodity = 'Milo' THEN futures_price + 5000
              WHEN order_key % 83 = 0 OR source_id % 31 = 9 THEN NULL ELSE futures_price END
           / CASE WHEN source_id % 13 = 5 THEN 100 ELSE 1 END AS futures_price
  FROM board)
"""
)


def rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board with nulls, zero quotes, stray rows and unit errors in some sources."""
    own = ROUGH_SQL[len(BOARD_SQL) :].replace("FROM board", "FROM {board}").lstrip(",\n")
    return spark.sql(f"WITH {own} SELECT * FROM rough", board=board(spark, sf_dir))


_SOURCES = """
sources AS (
  SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 41 = 6 THEN '999' ELSE CAST(s_nationkey AS STRING) END AS location_id,
         s_suppkey % 43 <> 10 AS has_location_key,
         CASE s_suppkey % 3 WHEN 1 THEN 'floor-cent' WHEN 2 THEN CASE WHEN s_suppkey % 47 = 20 THEN 'banker' ELSE 'round-cent' END ELSE NULL END AS cash_rounding,
         CASE WHEN s_suppkey % 13 = 5 THEN 'dollars' WHEN s_suppkey % 53 = 12 THEN 'pesos' ELSE NULL END AS futures_units,
         s_suppkey % 4 = 1 AS own_bands
  FROM supplier)
"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of every source; one in four has bands of its own."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    found = spark.sql(f"WITH {_SOURCES.replace('FROM supplier', 'FROM {supplier}')} SELECT * FROM sources", supplier=supplier)
    own = F.create_map(F.lit("Corn"), F.array(F.lit(1.0), F.lit(20.0)), F.lit("straw"), F.array(F.lit(0.1), F.lit(9.0)))
    none = F.lit(None).cast("double")
    return found.withColumns({"bands": F.when(F.col("own_bands"), own), "floor": none, "ceiling": none, "cash_rounding_cents": none})


GUARDS_SQL = (
    ROUGH_SQL
    + ","
    + _SOURCES
    + """,
scaled AS (
  SELECT s.source_id, s.location_id AS own, s.has_location_key, s.cash_rounding AS mode, s.own_bands,
         CASE coalesce(s.futures_units, 'cents') WHEN 'cents' THEN 1 WHEN 'dollars' THEN 100 ELSE NULL END AS scale,
         r.source_id IS NOT NULL AS there, r.seq, r.place, nullif(r.location_id, '') AS location_id, r.location, r.commodity, r.delivery, r.cash, r.basis, r.basis_cents, r.futures, r.futures_at,
         CASE WHEN coalesce(s.futures_units, 'cents') = 'cents' THEN r.futures_price
              WHEN s.futures_units = 'dollars' THEN floor(r.futures_price * 100 * 10000 + 0.5) / 10000.0 ELSE NULL END AS fp
  FROM sources s LEFT JOIN rough r ON s.source_id = r.source_id),
judged AS (
  SELECT *, there AND location_id IS NOT DISTINCT FROM nullif(own, '') AS located,
         there AND location_id IS NOT DISTINCT FROM nullif(own, '') AND (fp IS NULL OR fp <> 0) AS kept,
         cash IS NOT NULL AND basis IS NOT NULL AND fp IS NOT NULL AS testable,
         floor((fp - (cash - basis) * 100) * 10000 + 0.5) / 10000.0 AS signed,
         lower(commodity) AS crop
  FROM scaled),
flagged AS (
  SELECT *, kept AND testable AND abs(signed) > 0.05
            AND NOT coalesce(CASE mode WHEN 'floor-cent' THEN signed >= 0 AND signed < 1 WHEN 'round-cent' THEN signed >= -0.5 AND signed < 0.5 END, false) AS fails,
         kept AND testable AND abs(basis_cents - (cash * 100 - fp)) > 5 AS units,
         CASE WHEN own_bands AND crop LIKE '%corn%' THEN 1.0 WHEN own_bands AND crop LIKE '%straw%' THEN 0.1 WHEN crop LIKE '%meal%' THEN NULL
              WHEN crop LIKE '%soybean%' THEN 6.0 WHEN crop LIKE '%wheat%' THEN 3.0 WHEN crop LIKE '%corn%' THEN 2.0 WHEN crop LIKE '%milo%' THEN 2.0 END AS low,
         CASE WHEN own_bands AND crop LIKE '%corn%' THEN 20.0 WHEN own_bands AND crop LIKE '%straw%' THEN 9.0 WHEN crop LIKE '%meal%' THEN NULL
              WHEN crop LIKE '%soybean%' THEN 32.0 WHEN crop LIKE '%wheat%' THEN 20.0 WHEN crop LIKE '%corn%' THEN 12.0 WHEN crop LIKE '%milo%' THEN 14.0 END AS high
  FROM judged),
per_source AS (
  SELECT source_id, bool_and(has_location_key) AS has_key, max(scale) AS scale, max(own) AS own, max(mode) AS mode, count(*) FILTER (there) AS parsed,
         count(*) FILTER (located) AS located, count(DISTINCT location) FILTER (located) AS places, count(*) FILTER (kept) AS kept,
         count(*) FILTER (kept AND testable) AS tested, count(*) FILTER (fails) AS failing, coalesce(max(abs(signed)) FILTER (fails), 0) AS worst, count(*) FILTER (units) AS wrong
  FROM flagged GROUP BY source_id),
per_crop AS (
  SELECT source_id, commodity, count(*) AS rows, min(seq) AS first_seq, max(low) AS low,
         CASE WHEN max(low) IS NULL THEN 'no_band' WHEN count(*) FILTER (cash IS NULL) > 0 THEN 'null_cash'
              WHEN count(*) FILTER (cash < low OR cash > high) BETWEEN 1 AND count(*) - 1 THEN 'one_out_of_band'
              WHEN count(*) FILTER (cash < low OR cash > high) = count(*) THEN 'all_out_of_band' ELSE 'published' END AS fate
  FROM flagged WHERE kept GROUP BY source_id, commodity),
by_fate AS (
  SELECT source_id, arg_min(fate, first_seq) FILTER (fate IN ('null_cash', 'one_out_of_band')) AS refusing, count(*) FILTER (fate = 'published') AS good
  FROM per_crop GROUP BY source_id),
coded AS (
  SELECT p.*, CASE WHEN parsed = 0 THEN 'no_rows' WHEN NOT has_key THEN 'no_location_key' WHEN scale IS NULL THEN 'bad_futures_unit' WHEN located = 0 THEN 'location_absent'
      WHEN own IS NULL AND places > 1 THEN 'null_id_many_places' WHEN kept = 0 THEN 'all_zero_quote' WHEN mode = 'banker' THEN 'bad_rounding_mode'
      WHEN failing > 0 AND worst > 0.5 THEN 'identity_unexplained' WHEN failing > 0 AND failing * 2 >= tested THEN 'identity_unproven' WHEN tested = 0 THEN 'none_testable'
      WHEN wrong > 0 THEN 'basis_units' WHEN refusing IS NOT NULL THEN refusing WHEN coalesce(good, 0) = 0 THEN 'nothing_publishable' END AS code
  FROM per_source p LEFT JOIN by_fate f ON p.source_id = f.source_id)
"""
)
