"""Price bands: which range a commodity's cash price has to lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default bands in dollars per bushel, and words of goods sold by the ton.
DEFAULT_BANDS = {
    "corn": (2.0, 12.0),
    "soybean": (6.0, 32.0),
    "bean": (6.0, 32.0),
    "wheat": (3.0, 20.0),
    "durum": (4.0, 25.0),
    "sorghum": (2.0, 14.0),
    "milo": (2.0, 14.0),
    "oat": (1.5, 12.0),
    "barley": (2.0, 14.0),
    "rye": (2.0, 20.0),
    "triticale": (2.0, 16.0),
    "sunflower": (8.0, 45.0),
    "canola": (6.0, 35.0),
    "flax": (6.0, 40.0),
    "mustard": (8.0, 60.0),
    "safflower": (8.0, 45.0),
    "buckwheat": (4.0, 40.0),
    "millet": (3.0, 30.0),
    "pea": (4.0, 30.0),
    "lentil": (8.0, 60.0),
    "chickpea": (10.0, 80.0),
    "garbanzo": (10.0, 80.0),
}
PER_TON = ["ddgs", "distillers", "meal", "hull", "gluten", "bran", "pellet"]


def default_table(spark: SparkSession) -> DataFrame:
    rows = [(name, low, high) for name, (low, high) in DEFAULT_BANDS.items()]
    return spark.createDataFrame(rows, "name string, floor double, ceiling double")


def longest(names: Column, commodity: Column) -> Column:
    """The longest of an array of names that the commodity contains; the first of equal ones."""
    key = F.lower(F.trim(F.coalesce(commodity, F.lit(""))))
    hits = F.filter(names, lambda n: key.contains(F.lower(n)))
    return F.aggregate(hits, F.lit(None).cast("string"), lambda best, n: F.when(best.isNull() | (F.length(n) > F.length(best)), n).otherwise(best))


def band_for(commodity: Column, bands: Column | None = None, floor: Column | None = None, ceiling: Column | None = None) -> Column:
    """struct(floor, ceiling, named, valid) or null: the source's own bands, none for goods by the ton, defaults, a legacy pair.

    The default table is a literal, so a lookup is an expression in the scan's stage and no join.
    """
    key = F.lower(F.trim(F.coalesce(commodity, F.lit(""))))
    shape = lambda low, high, named, valid: F.struct(low.cast("double").alias("floor"), high.cast("double").alias("ceiling"), named.cast("string").alias("named"), valid.alias("valid"))
    by_ton = F.greatest(*(key.contains(w) for w in PER_TON))
    ordered = sorted(DEFAULT_BANDS, key=lambda n: -len(n))
    default = F.coalesce(
        *(F.when(key.contains(n), shape(F.lit(DEFAULT_BANDS[n][0]), F.lit(DEFAULT_BANDS[n][1]), F.lit(f"{n} (default)"), F.lit(True))) for n in ordered)
    )
    out = F.when(~by_ton, default)
    if bands is not None:
        own = longest(F.map_keys(bands), commodity)
        pair = F.element_at(bands, own)
        low, high = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
        valid = F.coalesce((F.size(pair) == 2) & (low < high), F.lit(False))
        out = F.when(own.isNotNull(), shape(low, high, own, valid)).otherwise(out)
        if floor is not None and ceiling is not None:
            legacy = F.when(bands.isNull() & ~by_ton & floor.isNotNull() & ceiling.isNotNull(), shape(floor, ceiling, F.lit("legacy"), F.lit(True)))
            out = F.coalesce(out, legacy)
    return out
