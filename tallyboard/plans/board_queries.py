"""Queries over the derived board: profiles, identity, bands, guards, moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.numbers import futures_scale as scale_of
from tallyboard.functions.numbers import round_to
from tallyboard.operators import changes, guards, profile
from tallyboard.operators.bands import band_for
from tallyboard.plans.board import BOARD_SQL, GUARDS_SQL, ROUGH_SQL, board, rough, sources
from tallyboard.plans.registry import query

_EVIDENCE = f"""
WITH {BOARD_SQL},
ready AS (SELECT source_id, commodity, floor(basis * 100 + 0.5) + futures_price AS d, floor(cash * 100 + 0.5) AS c FROM board),
counted AS (
  SELECT source_id, count(*) AS testable, count(*) FILTER (abs(d - c) < 1e-9) AS exact, count(*) FILTER (floor(d + 0.5) = c) AS round,
         count(*) FILTER (floor(d + 1e-9) = c) AS floor, count(DISTINCT floor((d - c) * 1000 + 0.5)) AS n_residuals, min(floor((d - c) * 1000 + 0.5) / 1000.0) AS least_residual
  FROM ready GROUP BY source_id),
named AS (
  SELECT *, CASE WHEN exact = testable THEN 'exact' WHEN floor = testable AND round <> testable THEN 'floor-cent' WHEN round = testable AND floor <> testable THEN 'round-cent' END AS mode FROM counted),
margins AS (SELECT *, CASE WHEN mode IS NULL THEN 0 WHEN mode = 'exact' THEN testable WHEN mode = 'floor-cent' THEN testable - round ELSE testable - floor END AS margin FROM named)
"""


@query(_EVIDENCE + "SELECT source_id, testable, exact, round, floor, n_residuals, least_residual, mode, margin, CASE WHEN mode = 'exact' OR margin >= 2 THEN mode END AS confident FROM margins")
def rounding_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.rounding_evidence(board(spark, sf_dir), ["source_id"])
    return found.select("source_id", "testable", "exact", "round", "floor", F.size("residuals").cast("long").alias("n_residuals"), F.array_min("residuals").alias("least_residual"), "mode", "margin", "confident")


@query(_EVIDENCE + "SELECT coalesce(mode, '-') AS mode, count(*) AS sources, min(margin) AS least_margin FROM margins GROUP BY 1")
def rounding_mode_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.rounding_evidence(board(spark, sf_dir), ["source_id"])
    return found.groupBy(F.coalesce("mode", F.lit("-")).alias("mode")).agg(F.count("*").alias("sources"), F.min("margin").alias("least_margin"))


_IDENTITY = f"""
WITH {BOARD_SQL},
tested AS (SELECT *, floor((futures_price - (cash - basis) * 100) * 10000 + 0.5) / 10000.0 AS signed FROM board),
fails AS (SELECT *, abs(signed) > 0.05 AS bad FROM tested)
"""


@query(
    _IDENTITY
    + """SELECT source_id, seq, commodity, delivery, futures_price AS quoted_cents, floor(((cash - basis) * 100) * 10000 + 0.5) / 10000.0 AS derived_cents,
         signed AS signed_cents, abs(signed) AS off_cents FROM fails WHERE bad"""
)
def identity_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = board(spark, sf_dir).where(guards.fails_identity())
    return rows.select(
        "source_id", "seq", "commodity", "delivery", F.col("futures_price").alias("quoted_cents"), guards.derived_cents().alias("derived_cents"), guards.signed_cents().alias("signed_cents"), F.abs(guards.signed_cents()).alias("off_cents")
    )


@query(
    _IDENTITY
    + """, s AS (SELECT source_id, count(*) AS n_rows, count(*) AS n_testable, count(*) FILTER (bad) AS n_failing, coalesce(max(abs(signed)) FILTER (bad), 0) AS worst_cents FROM fails GROUP BY 1)
    SELECT *, CASE WHEN n_failing = 0 THEN 'ok' WHEN worst_cents > 0.5 THEN 'unexplained' WHEN 2 * n_failing >= n_testable THEN 'unproven' ELSE 'lagging' END AS verdict FROM s"""
)
def identity_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guards.identity_summary(board(spark, sf_dir), ["source_id"])
    return found.select("source_id", "n_rows", "n_testable", "n_failing", "worst_cents", "verdict")


@query(
    _IDENTITY
    + """, s AS (SELECT source_id, count(*) FILTER (bad) AS n, count(*) FILTER (bad AND signed > 0) AS up, count(*) FILTER (bad AND signed < 0) AS down,
           coalesce(bool_and(abs(floor(abs(signed) / 0.125 + 0.5) * 0.125 - abs(signed)) < 1e-6) FILTER (bad), false) AS all_eighths FROM fails GROUP BY 1)
    SELECT source_id, CASE WHEN n = 0 THEN 'none' WHEN up = n THEN 'above' WHEN down = n THEN 'below' ELSE 'both' END AS side, all_eighths FROM s"""
)
def failure_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.identity_summary(board(spark, sf_dir), ["source_id"]).select("source_id", "side", "all_eighths")


@query(_IDENTITY + "SELECT source_id, max(abs(signed)) AS worst_cents, min(seq) FILTER (abs(signed) = w) AS seq FROM (SELECT *, max(abs(signed)) OVER (PARTITION BY source_id) AS w FROM fails WHERE bad) GROUP BY source_id")
def worst_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.worst_failure(board(spark, sf_dir))


@query(
    _IDENTITY
    + """, l AS (SELECT source_id, commodity, delivery, arg_max({'m': nullif(futures, ''), 'a': futures_at}, (seq, futures, coalesce(futures_at, ''))) AS x FROM board GROUP BY ALL)
    SELECT f.source_id, f.seq, f.signed AS signed_cents, coalesce(l.x.m, '?') AS month, l.x.a AS "at" FROM fails f JOIN l USING (source_id, commodity, delivery) WHERE bad"""
)
def failure_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.failure_details(board(spark, sf_dir)).select("source_id", "seq", "signed_cents", "month", "at")


@query(
    _IDENTITY
    + """, k AS (SELECT *, bool_or(bad) OVER (PARTITION BY source_id, commodity, delivery) AS failed FROM fails)
    SELECT source_id, coalesce(string_agg(DISTINCT futures_at, ',' ORDER BY futures_at) FILTER (failed), '') AS failed_at,
           coalesce(string_agg(DISTINCT futures_at, ',' ORDER BY futures_at) FILTER (NOT failed), '') AS ok_at FROM k GROUP BY 1"""
)
def failing_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guards.failing_stamps(board(spark, sf_dir))
    return found.select("source_id", F.array_join("failed_at", ",").alias("failed_at"), F.array_join("ok_at", ",").alias("ok_at"))


@query(f"WITH {ROUGH_SQL} SELECT source_id, count(*) FILTER (futures_price = 0) AS zero_quotes, count(*) FILTER (futures_price IS DISTINCT FROM 0) AS kept, count(*) FILTER (futures_price IS NULL) AS no_quote FROM rough GROUP BY 1")
def zero_quote_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.coalesce(F.col("futures_price") == 0, F.lit(False))
    return rough(spark, sf_dir).groupBy("source_id").agg(F.count_if(zero).alias("zero_quotes"), F.count_if(~zero).alias("kept"), F.count_if(F.col("futures_price").isNull()).alias("no_quote"))


@query(
    GUARDS_SQL.replace("raw AS", "WITH raw AS", 1)
    + "SELECT source_id, count(*) FILTER (there AND located) AS located, count(*) FILTER (there AND NOT located) AS dropped, count(DISTINCT location) FILTER (there) AS places FROM flagged GROUP BY 1"
)
def location_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sources(spark, sf_dir).select("source_id", F.col("location_id").alias("own")).join(rough(spark, sf_dir), "source_id", "left")
    there, here = F.col("seq").isNotNull(), guards.null_id(F.col("location_id")).eqNullSafe(guards.null_id(F.col("own")))
    return rows.groupBy("source_id").agg(F.count_if(there & here).alias("located"), F.count_if(there & ~here).alias("dropped"), F.count_distinct(F.when(there, F.col("location"))).alias("places"))


@query(
    f"""WITH {ROUGH_SQL}, own AS (SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_nationkey % 5 AS STRING) END AS own FROM supplier)
    SELECT DISTINCT r.source_id, r.location || coalesce(' (' || nullif(r.location_id, '') || ')', '') AS location FROM rough r JOIN own o ON r.source_id = o.source_id
    WHERE o.own IS NOT NULL AND NOT contains(r.location || coalesce(' (' || nullif(r.location_id, '') || ')', ''), o.own)"""
)
def other_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of one digit, which the pages' ids of one and two digits hold."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    own = supplier.select(F.col("s_suppkey").alias("source_id"), F.when(F.col("s_suppkey") % 7 != 0, (F.col("s_nationkey") % 5).cast("string")).alias("location_id"))
    return guards.other_locations(rough(spark, sf_dir), own)


@query(
    f"""WITH {BOARD_SQL}, crops AS (SELECT DISTINCT commodity, lower(commodity) AS k FROM board),
    bands(name, low, high) AS (VALUES ('corn', 2.0, 12.0), ('soybean', 6.0, 32.0), ('bean', 6.0, 32.0), ('wheat', 3.0, 20.0), ('milo', 2.0, 14.0)),
    hit AS (SELECT commodity, arg_max(name, length(name)) AS name, arg_max(low, length(name)) AS low, arg_max(high, length(name)) AS high FROM crops JOIN bands ON contains(k, name) WHERE NOT contains(k, 'meal') GROUP BY 1)
    SELECT c.commodity, CAST(h.low AS DOUBLE) AS low, CAST(h.high AS DOUBLE) AS high, h.name || ' (default)' AS named FROM crops c LEFT JOIN hit h ON c.commodity = h.commodity"""
)
def band_match_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    crops = board(spark, sf_dir).select("commodity").distinct().withColumn("band", band_for(F.col("commodity")))
    return crops.select("commodity", F.col("band.floor").alias("low"), F.col("band.ceiling").alias("high"), F.col("band.named").alias("named"))


@query(
    f"""WITH {ROUGH_SQL}, b AS (SELECT *, CASE commodity WHEN 'Corn' THEN 2.0 WHEN 'Soybeans' THEN 6.0 WHEN 'Hard Winter Wheat' THEN 3.0 WHEN 'Milo' THEN 2.0 END AS low,
        CASE commodity WHEN 'Corn' THEN 12.0 WHEN 'Soybeans' THEN 32.0 WHEN 'Hard Winter Wheat' THEN 20.0 WHEN 'Milo' THEN 14.0 END AS high FROM rough)
    SELECT source_id, commodity, count(*) AS rows, count(*) FILTER (cash < low OR cash > high) AS n_outside,
      CASE WHEN max(low) IS NULL THEN 'no_band' WHEN count(*) FILTER (cash < low OR cash > high) = 0 THEN 'inside' WHEN count(*) FILTER (cash < low OR cash > high) = count(*) THEN 'all_outside' ELSE 'some_outside' END AS fate
    FROM b GROUP BY 1, 2"""
)
def band_all_vs_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rough(spark, sf_dir).withColumn("band", band_for(F.col("commodity")))
    outside = (F.col("cash") < F.col("band.floor")) | (F.col("cash") > F.col("band.ceiling"))
    found = rows.groupBy("source_id", "commodity").agg(F.count("*").alias("rows"), F.count_if(outside).alias("n_outside"), F.count_if(F.col("band").isNull()).alias("n_bare"))
    fate = F.when(F.col("n_bare") > 0, "no_band").when(F.col("n_outside") == 0, "inside").when(F.col("n_outside") == F.col("rows"), "all_outside").otherwise("some_outside")
    return found.select("source_id", "commodity", "rows", "n_outside", fate.alias("fate"))


_G = "WITH " + GUARDS_SQL


@query(_G + "SELECT source_id, code FROM coded WHERE code IS NOT NULL")
def guard_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.run_guards(rough(spark, sf_dir), sources(spark, sf_dir)).refusals.select("source_id", "code")


@query(
    _G
    + """SELECT f.source_id, f.commodity, count(*) AS rows, 'zero_quote' AS why FROM flagged f JOIN coded c ON f.source_id = c.source_id AND c.code IS NULL
       WHERE f.located AND NOT f.kept GROUP BY 1, 2
       UNION ALL SELECT p.source_id, p.commodity, p.rows, p.fate FROM per_crop p JOIN coded c ON p.source_id = c.source_id AND c.code IS NULL WHERE p.fate IN ('no_band', 'all_out_of_band')"""
)
def withheld_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    withheld = guards.run_guards(rough(spark, sf_dir), sources(spark, sf_dir)).withheld
    return withheld.groupBy("source_id", "commodity", "why").agg(F.sum("rows").alias("rows")).select("source_id", "commodity", "rows", "why")


@query(
    _G
    + """, pub AS (SELECT f.* FROM flagged f JOIN coded c ON f.source_id = c.source_id AND c.code IS NULL JOIN per_crop p ON p.source_id = f.source_id AND p.commodity = f.commodity AND p.fate = 'published' WHERE f.kept)
    SELECT source_id, commodity, count(*) AS rows, count(DISTINCT delivery) AS deliveries, count(*) FILTER (nullif(trim(regexp_replace(futures, '(?i)\\s*corn\\s*$', '')), '') = 'MAR 24') AS march, CAST(sum(basis_cents) AS BIGINT) AS basis_sum,
      CAST(sum(CAST(floor(fp * 8 + 0.5) AS BIGINT)) AS BIGINT) AS eighths FROM pub GROUP BY 1, 2"""
)
def published_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    pub = guards.run_guards(rough(spark, sf_dir), sources(spark, sf_dir)).published
    return pub.groupBy("source_id", "commodity").agg(
        F.count("*").alias("rows"),
        F.count_distinct("delivery").alias("deliveries"),
        F.count_if(F.col("futures_month") == "MAR 24").alias("march"),
        F.sum("basis_cents").alias("basis_sum"),
        F.sum(F.floor(F.col("futures_price_cents") * 8 + 0.5)).alias("eighths"),
    )


@query(_G + "SELECT source_id, parsed - located AS dropped, tested AS verified, code FROM coded")
def guard_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.run_guards(rough(spark, sf_dir), sources(spark, sf_dir)).diagnostics.select("source_id", "dropped", "verified", "code")


@query(
    f"""WITH {BOARD_SQL}, n AS (SELECT source_id, seq, commodity, row_number() OVER (PARTITION BY source_id ORDER BY seq, commodity, delivery, place) - 1 AS page_place FROM board)
    SELECT source_id, page_place AS place, seq FROM n"""
)
def published_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.page_places(board(spark, sf_dir)).select("source_id", "place", "seq")


@query(
    _G
    + """, pub AS (SELECT f.* FROM flagged f JOIN coded c ON f.source_id = c.source_id AND c.code IS NULL JOIN per_crop p ON p.source_id = f.source_id AND p.commodity = f.commodity AND p.fate = 'published' WHERE f.kept)
    SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY seq, commodity, delivery, place) - 1 AS seq, commodity, delivery, cash FROM pub"""
)
def published_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = guards.run_guards(rough(spark, sf_dir), sources(spark, sf_dir)).published
    return published.select("source_id", F.col("seq").cast("long").alias("seq"), "commodity", "delivery", "cash")


@query("SELECT s_suppkey AS source_id, 'bad_band' AS code FROM supplier WHERE s_suppkey % 5 >= 3")
def bad_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One good row a source; a band whose ends are not in order refuses it."""
    names = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("source_id"))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    band = F.create_map(F.lit("Corn"), F.array((F.col("source_id") % 5).cast("double"), F.lit(3.0)))
    own = names.select("source_id", F.lit("T").alias("location_id"), F.lit(True).alias("has_location_key"), band.alias("bands"), *(none.alias(c) for c in ("floor", "ceiling", "cash_rounding_cents")), *(text.alias(c) for c in ("cash_rounding", "futures_units")))
    row = {"seq": 0, "location_id": "T", "location": "Town", "commodity": "Corn", "delivery": "Oct", "cash": 2.5, "basis": -0.5, "basis_cents": -50, "futures": "DEC", "futures_price": 300.0, "futures_at": ""}
    rows = names.select("source_id", *(F.lit(v).alias(c) for c, v in row.items()))
    return guards.run_guards(rows, own).refusals.select("source_id", "code")


@query(
    f"""WITH {ROUGH_SQL} SELECT source_id, count(*) AS wrong_units FROM rough WHERE cash IS NOT NULL AND basis IS NOT NULL AND futures_price IS NOT NULL
    AND abs(basis_cents - (cash * 100 - futures_price)) > 5 GROUP BY 1"""
)
def basis_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rough(spark, sf_dir).where(guards.basis_units_wrong()).groupBy("source_id").agg(F.count("*").alias("wrong_units"))


@query(
    f"""WITH {BOARD_SQL}, u AS (SELECT *, CASE order_key % 5 WHEN 0 THEN 'Dollars' WHEN 1 THEN 'cents' WHEN 2 THEN 'ticks' WHEN 3 THEN NULL ELSE location END AS unit FROM board),
    s AS (SELECT *, CASE WHEN unit IS NULL OR lower(unit) IN ('cents', 'ticks') THEN 1 WHEN lower(unit) = 'dollars' THEN 100 END AS scale FROM u)
    SELECT source_id, seq, place, unit, scale, floor(futures_price / 100 * scale * 10000 + 0.5) / 10000.0 AS cents FROM s"""
)
def futures_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the quotes in each unit, in none, and in one that is not known."""
    m = F.col("order_key") % 5
    unit = F.when(m == 0, "Dollars").when(m == 1, "cents").when(m == 2, "ticks").when(m == 4, F.col("location"))
    rows = board(spark, sf_dir).withColumn("unit", unit).withColumn("scale", scale_of(F.col("unit")))
    return rows.select("source_id", "seq", "place", "unit", "scale", round_to(F.col("futures_price") / 100 * F.col("scale"), 4).alias("cents"))


_MOVES = f"""WITH {BOARD_SQL},
before AS (SELECT source_id, commodity, delivery, arg_max(cash, seq) AS was FROM board WHERE order_key % 2 = 0 GROUP BY 1, 2, 3),
after AS (SELECT source_id, commodity, delivery, max(cash) AS now FROM board WHERE order_key % 2 = 1 GROUP BY 1, 2, 3)
"""


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = board(spark, sf_dir)
    keys = ["source_id", "commodity", "delivery"]
    return rows.where("order_key % 2 = 0"), rows.where("order_key % 2 = 1").groupBy(*keys).agg(F.max("cash").alias("cash"))


@query(_MOVES + 'SELECT source_id, commodity, delivery, was AS "from", now AS "to", now - was AS move FROM before JOIN after USING (source_id, commodity, delivery) WHERE abs(now - was) > 0.75')
def max_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _halves(spark, sf_dir)
    return changes.moves(before, after)


def _periods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = board(spark, sf_dir)
    return rows.where("line % 2 = 0"), rows.where("line % 2 = 1")


_PERIODS = f"WITH {BOARD_SQL}, p AS (SELECT DISTINCT source_id, delivery FROM board WHERE line % 2 = 0), n AS (SELECT DISTINCT source_id, delivery FROM board WHERE line % 2 = 1) "


@query(_PERIODS + "SELECT n.source_id, n.delivery FROM n WHERE EXISTS (SELECT 1 FROM p WHERE p.source_id = n.source_id AND p.delivery = n.delivery)")
def prev_vs_next_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _periods(spark, sf_dir)
    return after.select("source_id", "delivery").distinct().join(before, ["source_id", "delivery"], "left_semi")


@query(_PERIODS + "SELECT n.source_id, n.delivery FROM n WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source_id = n.source_id AND p.delivery = n.delivery)")
def prev_vs_next_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _periods(spark, sf_dir)
    return after.select("source_id", "delivery").distinct().join(before, ["source_id", "delivery"], "left_anti")


@query(_PERIODS + "SELECT source_id, delivery, CASE WHEN p.delivery IS NULL THEN 'new' WHEN n.delivery IS NULL THEN 'gone' ELSE 'both' END AS side FROM (SELECT *, 1 AS a FROM p) p FULL JOIN (SELECT *, 1 AS b FROM n) n USING (source_id, delivery)".replace("p.delivery IS NULL", "a IS NULL").replace("n.delivery IS NULL", "b IS NULL"))
def prev_vs_next_full_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = (x.select("source_id", "delivery").distinct() for x in _periods(spark, sf_dir))
    joined = before.withColumn("a", F.lit(1)).join(after.withColumn("b", F.lit(1)), ["source_id", "delivery"], "full")
    return joined.select("source_id", "delivery", F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").otherwise("both").alias("side"))


@query(_PERIODS + "SELECT source_id, delivery FROM n INTERSECT SELECT source_id, delivery FROM p")
def shared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.shared_keys(*_periods(spark, sf_dir), ["source_id", "delivery"])


@query(_PERIODS + "SELECT source_id, delivery FROM p EXCEPT SELECT source_id, delivery FROM n")
def lost_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = (x.select("source_id", "delivery") for x in _periods(spark, sf_dir))
    return before.subtract(after)


_RUNS = f"""WITH {BOARD_SQL}, ready AS (SELECT source_id, commodity, order_key % 2 AS half, floor(basis * 100 + 0.5) + futures_price AS d, floor(cash * 100 + 0.5) AS c FROM board),
ev AS (SELECT half, source_id, commodity, count(*) AS testable, count(*) FILTER (abs(d - c) < 1e-9) AS e, count(*) FILTER (floor(d + 0.5) = c) AS r, count(*) FILTER (floor(d + 1e-9) = c) AS f FROM ready GROUP BY 1, 2, 3),
named AS (SELECT *, CASE WHEN e = testable THEN 'exact' WHEN f = testable AND r <> testable THEN 'floor-cent' WHEN r = testable AND f <> testable THEN 'round-cent' END AS mode FROM ev),
run AS (SELECT *, CASE WHEN mode IS NULL THEN 0 WHEN mode = 'exact' THEN testable WHEN mode = 'floor-cent' THEN testable - r ELSE testable - f END AS margin FROM named),
now AS (SELECT * FROM run WHERE half = 1), prior AS (SELECT * FROM run WHERE half = 0 AND source_id % 5 <> 2)
"""


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = board(spark, sf_dir)
    evidence = lambda x: profile.rounding_evidence(x, ["source_id", "commodity"])
    return evidence(rows.where("order_key % 2 = 1")), evidence(rows.where("order_key % 2 = 0 and source_id % 5 <> 2"))


@query(
    _RUNS
    + """SELECT count(*) FILTER (p.source_id IS NOT NULL AND coalesce(n.mode, '-') = coalesce(p.mode, '-')) AS agree, count(*) FILTER (p.source_id IS NOT NULL AND coalesce(n.mode, '-') <> coalesce(p.mode, '-')) AS differ,
    count(*) FILTER (p.source_id IS NULL) AS fresh FROM now n LEFT JOIN prior p ON n.source_id = p.source_id AND n.commodity = p.commodity"""
)
def agreement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.agreement(*_two_runs(spark, sf_dir), ["source_id", "commodity"])


@query(
    _RUNS
    + """SELECT count(*) AS shared, coalesce(bool_and(n.mode IS NOT DISTINCT FROM p.mode AND n.testable = p.testable AND n.margin = p.margin), false) AS same_run
    FROM now n JOIN prior p ON n.source_id = p.source_id AND n.commodity = p.commodity"""
)
def same_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.same_run(*_two_runs(spark, sf_dir), ["source_id", "commodity"])


@query(
    f"""WITH {BOARD_SQL} SELECT source_id, location, count(*) AS rows, string_agg(DISTINCT commodity, ',' ORDER BY commodity) AS commodities,
    bool_or(contains(lower(commodity), 'corn')) AS needs_corn, bool_or(contains(lower(commodity), 'bean')) AS needs_soybeans, bool_or(contains(lower(commodity), 'wheat')) AS needs_wheat FROM board GROUP BY 1, 2"""
)
def location_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.skeleton(board(spark, sf_dir)).withColumn("commodities", F.array_join("commodities", ","))


@query(
    _EVIDENCE
    + """SELECT (SELECT count(*) FROM margins) AS locations, (SELECT CAST(sum(testable) AS BIGINT) FROM margins) AS rows, (SELECT count(*) FROM margins WHERE mode = 'exact' OR margin >= 2) AS confident,
    (SELECT count(*) FROM board WHERE order_key % 97 = 0) AS refused, (SELECT count(DISTINCT location) FROM board WHERE location LIKE '%1%') AS flagged"""
)
def batch_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = board(spark, sf_dir)
    evidence = profile.rounding_evidence(rows, ["source_id"])
    return profile.batch_tally(evidence, rows.where("order_key % 97 = 0"), rows.where("location like '%1%'").select("location").distinct())


@query(f"WITH {BOARD_SQL} SELECT source_id, count(DISTINCT commodity) AS commodities, count(DISTINCT location) AS locations, count(DISTINCT location) = 1 AS sole_town FROM board GROUP BY 1")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(board(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {BOARD_SQL},
    o AS (SELECT source_id, commodity, delivery, seq, CASE WHEN order_key % 3 = 0 THEN NULL ELSE cash_e8 END AS cash, CASE WHEN order_key % 5 = 0 THEN NULL ELSE basis_cents END AS basis,
       row_number() OVER (PARTITION BY source_id, commodity, delivery ORDER BY seq, cash_e8, basis_cents) AS rn FROM board),
    f AS (SELECT source_id, commodity, delivery, rn, seq AS place, seq, cash, basis FROM o WHERE rn = 1
      UNION ALL SELECT o.source_id, o.commodity, o.delivery, o.rn, f.place, CASE WHEN better THEN o.seq ELSE f.seq END, CASE WHEN better THEN o.cash ELSE f.cash END, CASE WHEN better THEN o.basis ELSE f.basis END
      FROM (SELECT f.*, (f.cash IS NULL AND x.cash IS NOT NULL) OR (f.basis IS NULL AND x.basis IS NOT NULL) AS better FROM f JOIN o x ON x.source_id = f.source_id AND x.commodity = f.commodity AND x.delivery = f.delivery AND x.rn = f.rn + 1) f
      JOIN o ON o.source_id = f.source_id AND o.commodity = f.commodity AND o.delivery = f.delivery AND o.rn = f.rn + 1)
    SELECT source_id, commodity, delivery, arg_max(place, rn) AS place, arg_max(seq, rn) AS seq, first(cash ORDER BY rn DESC) AS cash, first(basis ORDER BY rn DESC) AS basis FROM f GROUP BY 1, 2, 3"""
)
def dedupe_first_or_better(spark: SparkSession, sf_dir: str) -> DataFrame:
    thin = board(spark, sf_dir).select("source_id", "commodity", "delivery", "seq", F.when(F.col("order_key") % 3 != 0, F.col("cash_e8")).alias("cash"), F.when(F.col("order_key") % 5 != 0, F.col("basis_cents")).alias("basis"))
    return changes.first_or_better(thin, ["source_id", "commodity", "delivery"], "seq", ["cash", "basis"])
