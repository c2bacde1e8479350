"""Set-level integrity guards over the rows of many sources at once.

Input rows carry source_id, seq, location_id, location, commodity, delivery, cash and basis in
dollars, basis_cents, futures (month), futures_price in cents and futures_at. Sources carry their
settings. One row can refuse its source: every refusal is a row (source_id, rank, code), and the
least rank wins, so the first refusal of the guard order does. All guards are conditional aggregates of
one grouping of the rows by source and commodity, and of a second one of its few rows by source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.functions.numbers import FUTURES_UNITS, futures_scale, round_to, rounding_explains
from tallyboard.operators.bands import band_for
from tallyboard.sources.scratch import written

# Fixed values, in cents.
TOLERANCE, TORN_MAX, BASIS_UNIT_MAX, EIGHTH = 0.05, 0.5, 5.0, 0.125
ROUNDING_MODES = ["exact", "floor-cent", "round-cent"]

#: Guard order; a commodity's own refusals come after these by the commodity's first row.
RANKS = {
    "no_rows": 1,
    "no_location_key": 2,
    "bad_futures_unit": 3,
    "location_absent": 4,
    "null_id_many_places": 5,
    "all_zero_quote": 6,
    "bad_rounding_mode": 7,
    "identity_unexplained": 8,
    "identity_unproven": 9,
    "none_testable": 10,
    "basis_units": 11,
    "commodity": 12,
    "nothing_publishable": 13,
}


def null_id(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def testable() -> Column:
    return F.col("cash").isNotNull() & F.col("basis").isNotNull() & F.col("futures_price").isNotNull()


def signed_cents() -> Column:
    """Quote minus derived, at four decimals."""
    return round_to(F.col("futures_price") - (F.col("cash") - F.col("basis")) * 100, 4)


def derived_cents() -> Column:
    return round_to((F.col("cash") - F.col("basis")) * 100, 4)


def fails_identity(mode: Column | None = None, tolerance: Column | None = None) -> Column:
    """Whether a testable row is out of balance beyond what its source's rounding explains."""
    off = F.abs(signed_cents())
    failing = testable() & (off > TOLERANCE)
    if mode is not None:
        within = F.coalesce(tolerance, F.lit(0.0)) if tolerance is not None else F.lit(0.0)
        explained = F.coalesce(rounding_explains(mode, signed_cents()), (within > 0) & (off <= within))
        failing = failing & ~explained
    return F.coalesce(failing, F.lit(False))


def verdict(failing: Column, tested: Column, worst: Column) -> Column:
    """ok, unexplained (a gap no torn read makes), unproven (no minority fails) or lagging."""
    return F.when(failing == 0, "ok").when(worst > TORN_MAX, "unexplained").when(failing * 2 >= tested, "unproven").otherwise("lagging")


def basis_units_wrong() -> Column:
    return testable() & F.coalesce(F.abs(F.col("basis_cents") - (F.col("cash") * 100 - F.col("futures_price"))) > BASIS_UNIT_MAX, F.lit(False))


def identity_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group: rows, testable rows, failing rows, worst gap, verdict, and how the failures lie."""
    fails, signed = fails_identity(), signed_cents()
    eighths = F.abs(F.floor(F.abs(signed) / EIGHTH + 0.5) * EIGHTH - F.abs(signed)) < 1e-6
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(testable()).alias("n_testable"),
        F.count_if(fails).alias("n_failing"),
        F.coalesce(F.max(F.when(fails, F.abs(signed))), F.lit(0.0)).alias("worst_cents"),
        F.count_if(fails & (signed > 0)).alias("n_above"),
        F.count_if(fails & (signed < 0)).alias("n_below"),
        F.coalesce(F.bool_and(F.when(fails, eighths)), F.lit(False)).alias("all_eighths"),
    )
    side = (
        F.when(F.col("n_failing") == 0, "none").when(F.col("n_above") == F.col("n_failing"), "above").when(F.col("n_below") == F.col("n_failing"), "below").otherwise("both")
    )
    return out.withColumns({"side": side, "verdict": verdict(F.col("n_failing"), F.col("n_testable"), F.col("worst_cents"))})


def failing_stamps(rows: DataFrame) -> DataFrame:
    """Per source the clocks on rows whose (commodity, delivery) failed, and those on all others."""
    key = Window.partitionBy("source_id", "commodity", "delivery")
    marked = rows.withColumn("_failed", F.max(fails_identity()).over(key))
    stamps = lambda failed: F.array_sort(F.collect_set(F.when(F.col("_failed") == failed, F.nullif("futures_at", F.lit("")))))
    return marked.groupBy("source_id").agg(stamps(True).alias("failed_at"), stamps(False).alias("ok_at"))


def worst_failure(rows: DataFrame) -> DataFrame:
    """Per source the failing row with the largest gap, the first of equal ones: source_id, worst_cents, seq."""
    failing = rows.where(fails_identity()).select("source_id", "seq", F.abs(signed_cents()).alias("off"))
    worst = F.max(F.struct("off", (-F.col("seq")).alias("back")))
    return failing.groupBy("source_id").agg(worst.alias("w")).select("source_id", F.col("w.off").alias("worst_cents"), (-F.col("w.back")).alias("seq"))


def failure_details(rows: DataFrame) -> DataFrame:
    """Failing rows with contract month and clock as the last row of their (commodity, delivery) has them; `?` where it names no month.

    Of rows with one number the one with the greatest month and clock counts.
    """
    keys = ["source_id", "commodity", "delivery"]
    failing = rows.where(fails_identity()).select(*keys, "seq", "cash", "basis", derived_cents().alias("derived_cents"), F.col("futures_price").alias("quoted_cents"), signed_cents().alias("signed_cents"))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    last = rows.groupBy(*keys).agg(F.max(F.struct("seq", text("futures"), text("futures_at"))).alias("_last"))
    named = lambda c, default: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(default)).otherwise(F.col(c))
    return failing.join(last, keys, "left").withColumns({"month": named("_last.futures", "?"), "at": named("_last.futures_at", None)}).drop("_last")


def _page_order(rows: DataFrame) -> list[Column | str]:
    """By number (a row without one comes late) and names; among equal ones by `place` on the page where the reader gives it, and by what they show."""
    last = [c for c in ("place", "cash", "basis", "futures_price", "futures", "futures_at", "location") if c in rows.columns]
    return [F.coalesce("seq", F.lit(9999)), "commodity", "delivery", *last]


def page_places(rows: DataFrame) -> DataFrame:
    """`rows` with `place` from 0 in each source, in the order in which they are published."""
    order = Window.partitionBy("source_id").orderBy(*_page_order(rows))
    return rows.withColumn("place", (F.row_number().over(order) - 1).cast("long"))


@dataclass
class Outcome:
    published: DataFrame
    withheld: DataFrame
    refusals: DataFrame
    diagnostics: DataFrame


def run_guards(rows: DataFrame, sources: DataFrame) -> Outcome:
    """All guards of all sources.

    `sources` has source_id, location_id, has_location_key, bands (map), floor, ceiling, cash_rounding,
    cash_rounding_cents and futures_units. Every source gets rows in `published`, or one row in
    `refusals`; `withheld` lists commodities (and zero quotes, row by row) of sources not refused.

    The rows are grouped once; that table, of few rows a source, is written, and all but the published rows come from it.
    """
    settings = sources.select(
        "source_id",
        null_id(F.col("location_id")).alias("own_location"),
        F.coalesce("has_location_key", F.lit(True)).alias("has_location_key"),
        "bands",
        "floor",
        "ceiling",
        F.col("cash_rounding").alias("mode"),
        F.coalesce("cash_rounding_cents", F.lit(0.0)).alias("tolerance"),
        futures_scale(F.col("futures_units")).alias("scale"),
    )
    joined = settings.join(rows.withColumn("_there", F.lit(True)), "source_id", "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    located = F.col("_there") & null_id(F.col("location_id")).eqNullSafe(F.col("own_location"))
    scaled = joined.withColumns(
        {
            "_located": located,
            "futures_price": F.when(F.col("scale") == 1, F.col("futures_price")).otherwise(round_to(F.col("futures_price") * F.col("scale"), 4)),
        }
    )
    kept = F.col("_located") & (F.col("futures_price").isNull() | (F.col("futures_price") != 0))
    flagged = scaled.withColumn("_kept", kept).withColumns(
        {
            "_zero": F.col("_located") & ~F.col("_kept"),
            "_tested": F.col("_kept") & testable(),
            "_fails": F.col("_kept") & fails_identity(F.col("mode"), F.col("tolerance")),
            "_units": F.col("_kept") & basis_units_wrong(),
            "_band": band_for(F.col("commodity"), F.col("bands"), F.col("floor"), F.col("ceiling")),
        }
    )
    label = labels()
    name = F.coalesce(F.nullif("commodity", F.lit("")), F.lit("(unnamed)"))
    outside = (F.col("cash") < F.col("_band.floor")) | (F.col("cash") > F.col("_band.ceiling"))
    some = lambda c: F.first(c, True).alias(c)
    zeros = {"zero_named": F.coalesce(F.col("commodity") != "", F.lit(False)), "zero_empty": F.coalesce(F.col("commodity") == "", F.lit(False)), "zero_null": F.col("commodity").isNull()}
    by_commodity = written(
        flagged.groupBy("source_id", name.alias("commodity"))
        .agg(
            *(some(c) for c in ("has_location_key", "scale", "own_location", "mode")),
            F.count_if("_there").alias("n_parsed"),
            F.count_if("_located").alias("n_located"),
            F.collect_set(F.when(F.col("_located"), F.nullif("location", F.lit("")))).alias("places"),
            F.count_if("_kept").alias("n_kept"),
            *(F.count_if(F.col("_zero") & test).alias(c) for c, test in zeros.items()),
            F.count_if("_tested").alias("n_testable"),
            F.count_if("_fails").alias("n_failing"),
            F.max(F.when(F.col("_fails"), F.abs(signed_cents()))).alias("worst_cents"),
            F.count_if("_units").alias("n_wrong_units"),
            F.collect_set(F.when(F.col("_there"), label)).alias("locations"),
            F.collect_set(F.when(F.col("_kept"), F.nullif("futures_at", F.lit("")))).alias("board_at"),
            F.min(F.when(F.col("_kept"), F.coalesce("seq", F.lit(9999)))).alias("first_seq"),
            F.first(F.when(F.col("_kept"), F.col("_band")), True).alias("band"),
            F.count_if(F.col("_kept") & F.col("cash").isNull()).alias("no_cash"),
            F.count_if(F.col("_kept") & outside).alias("n_outside"),
        )
        .withColumn(
            "fate",
            F.when(F.col("n_kept") == 0, "no_row")
            .when(F.col("band").isNull(), "no_band")
            .when(~F.col("band.valid"), "bad_band")
            .when(F.col("no_cash") > 0, "null_cash")
            .when((F.col("n_outside") > 0) & (F.col("n_outside") < F.col("n_kept")), "one_out_of_band")
            .when(F.col("n_outside") == F.col("n_kept"), "all_out_of_band")
            .otherwise("published"),
        )
    )
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    judged = by_commodity.groupBy("source_id").agg(
        *(some(c) for c in ("has_location_key", "scale", "own_location", "mode")),
        *(F.sum(c).alias(c) for c in ("n_parsed", "n_located", "n_kept", "n_testable", "n_failing", "n_wrong_units")),
        F.coalesce(F.max("worst_cents"), F.lit(0.0)).alias("worst_cents"),
        F.size(merged("places")).alias("n_places"),
        merged("locations").alias("locations"),
        merged("board_at").alias("board_at"),
        F.min(F.when(F.col("fate").isin("bad_band", "null_cash", "one_out_of_band"), F.struct("first_seq", "fate"))).alias("refusing"),
        F.count_if(F.col("fate") == "published").alias("n_published"),
    )
    vote = verdict(F.col("n_failing"), F.col("n_testable"), F.col("worst_cents"))
    code = (
        F.when(F.col("n_parsed") == 0, "no_rows")
        .when(~F.col("has_location_key"), "no_location_key")
        .when(F.col("scale").isNull(), "bad_futures_unit")
        .when(F.col("n_located") == 0, "location_absent")
        .when(F.col("own_location").isNull() & (F.col("n_places") > 1), "null_id_many_places")
        .when(F.col("n_kept") == 0, "all_zero_quote")
        .when(F.col("mode").isNotNull() & ~F.col("mode").isin(ROUNDING_MODES), "bad_rounding_mode")
        .when(vote == "unexplained", "identity_unexplained")
        .when(vote == "unproven", "identity_unproven")
        .when(F.col("n_testable") == 0, "none_testable")
        .when(F.col("n_wrong_units") > 0, "basis_units")
        .when(F.col("refusing").isNotNull(), F.col("refusing.fate"))
        .when(F.coalesce("n_published", F.lit(0)) == 0, "nothing_publishable")
    )
    rank = F.coalesce(*(F.when(F.col("code") == c, F.lit(k)) for c, k in RANKS.items()), F.lit(RANKS["commodity"]))
    coded = judged.withColumn("code", code)
    refusals = coded.where("code is not null").select("source_id", rank.alias("rank"), "code")
    fine = coded.where("code is null").select("source_id")
    diagnostics = coded.select("source_id", (F.col("n_parsed") - F.col("n_located")).alias("dropped"), F.col("n_testable").alias("verified"), vote.alias("verdict"), "locations", "board_at", "code")
    raw = {"zero_named": F.col("commodity"), "zero_empty": F.lit(""), "zero_null": F.lit(None).cast("string")}
    counted = by_commodity.select("source_id", F.inline(F.array(*(F.struct(value.alias("commodity"), F.col(c).alias("n")) for c, value in raw.items()))))
    zero = counted.where("n > 0").select("source_id", "commodity", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("rows")).withColumns({"rows": F.lit(1).cast("long"), "why": F.lit("zero_quote")})
    banned = by_commodity.where(F.col("fate").isin("no_band", "all_out_of_band")).select("source_id", "commodity", F.col("n_kept").alias("rows"), F.col("fate").alias("why"))
    withheld = zero.unionByName(banned).join(fine, "source_id", "left_semi")
    open_ = by_commodity.where("fate = 'published'").select("source_id", F.col("commodity").alias("_name")).join(fine, "source_id", "left_semi")
    order = Window.partitionBy("source_id").orderBy(*_page_order(rows))
    published = (
        flagged.where("_kept")
        .join(open_, ["source_id"])
        .where(name == F.col("_name"))
        .select(
            "source_id",
            (F.row_number().over(order) - 1).alias("seq"),
            "commodity",
            "delivery",
            published_month(F.col("futures")).alias("futures_month"),
            "cash",
            F.col("basis").alias("basis_dollars"),
            "basis_cents",
            F.col("futures_price").alias("futures_price_cents"),
        )
    )
    return Outcome(published, withheld, refusals, diagnostics)


def published_month(futures: Column) -> Column:
    """A contract's name without a trailing word for corn."""
    return F.nullif(F.trim(F.regexp_replace(F.coalesce(futures, F.lit("")), r"(?i)\s*corn\s*$", "")), F.lit(""))


def labels() -> Column:
    """A row's place as a page shows it: the name, and the id behind it."""
    return F.concat("location", F.coalesce(F.concat(F.lit(" ("), null_id(F.col("location_id")), F.lit(")")), F.lit("")))


def other_locations(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Labels on a source's page that do not contain its id anywhere, so an id within a longer one counts as its own; none where the id is null.

    Rows meet their source by its key, and each distinct label of a source is looked through once.
    """
    own = sources.select("source_id", null_id(F.col("location_id")).alias("_own")).where(F.col("_own").isNotNull())
    shown = rows.select("source_id", labels().alias("location")).where(F.col("location").isNotNull()).distinct()
    return shown.join(own, "source_id").where(~F.contains("location", "_own")).select("source_id", "location")


def known_units() -> list[str]:
    return list(FUTURES_UNITS)
