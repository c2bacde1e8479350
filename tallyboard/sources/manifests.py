"""Source manifests: one JSON document per source, read with its key presence, validated, projected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyboard.functions.text import url_twins
from tallyboard.operators.guards import ROUNDING_MODES

# Platforms, what they send and how they are reached.
PLATFORMS = {
    "cashbidssingle": ("html", "fetch"),
    "aghost": ("html", "fetch"),
    "fragment": ("html", "fetch"),
    "graindesk": ("json", "fetch"),
    "dtn-cs": ("json", "browser"),
    "bushel": ("json", "browser"),
    "first-party": ("json", "fetch"),
}
REQUIRED = ["id", "operator", "location", "platform", "url"]
TEXTS = ["id", "operator", "location", "state", "platform", "url", "cadence", "provenance", "note", "publicNote", "zip", "phone", "email", "website", "browserPage", "siteId", "companyToken", "address", "cashRounding", "futuresUnits", "apiKeyEnv", "schema"]
UNITS = ["cents", "ticks", "dollars"]


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """path and raw text of every manifest file of a folder."""
    return spark.read.option("wholetext", True).text(f"{folder}/*.json").select(F.input_file_name().alias("path"), F.col("value").alias("raw"))


def wire(platform: Column) -> Column:
    return F.coalesce(*(F.when(platform == p, F.lit(w)) for p, (w, _) in PLATFORMS.items()), F.lit("html"))


def transport(platform: Column) -> Column:
    return F.coalesce(*(F.when(platform == p, F.lit(t)) for p, (_, t) in PLATFORMS.items()), F.lit("fetch"))


def browsable(url: Column) -> Column:
    return url.rlike("^https://") | url.rlike(r"^http://(127\.0\.0\.1|localhost|\[::1\])(?=[:/]|$)")


def parse(manifests: DataFrame) -> DataFrame:
    """Typed columns beside `keys`, the keys that the document has, and `types`, what JSON type each value is."""
    doc = F.try_parse_json("raw")
    text = lambda k: F.try_variant_get(doc, f"$.{k}", "string").alias(k)
    keys = F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>"))
    kind = lambda k: F.schema_of_variant(F.try_variant_get(doc, f"$.{k}", "variant"))
    return manifests.select(
        "*",
        keys.alias("keys"),
        F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        *(text(k) for k in TEXTS),
        text("locationId"),
        *(F.try_variant_get(doc, f"$.{k}", "double").alias(k) for k in ("lat", "lon", "cashRoundingCents")),
        F.try_variant_get(doc, "$.enabled", "boolean").alias("enabled"),
        F.try_variant_get(doc, "$.inMerge", "boolean").alias("inMerge"),
        F.from_json(F.try_variant_get(doc, "$.bands", "string"), "map<string,array<double>>").alias("bands"),
        F.from_json(F.try_variant_get(doc, "$.altUrls", "string"), "array<string>").alias("altUrls"),
        F.create_map(*(x for k in ("lat", "lon", "enabled", "cashRoundingCents") for x in (F.lit(k), kind(k)))).alias("types"),
    )


def _has(key: str) -> Column:
    return F.array_contains("keys", key)


def complaints() -> Column:
    """All complaint kinds of a parsed manifest, in order; a duplicate id is found by `load`."""
    blank = lambda k: F.coalesce(F.col(k), F.lit("")) == ""
    kind = lambda k: F.coalesce(F.element_at("types", k), F.lit("VOID"))
    number = lambda k: kind(k).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|SMALLINT|TINYINT)")
    when = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    pairs = F.map_values("bands")
    browser = transport(F.col("platform")) == "browser"
    return F.array_compact(
        F.array(
            when(~F.col("is_object"), "not an object"),
            *(when(F.col("is_object") & blank(k), f"missing {k}") for k in REQUIRED),
            when(~blank("platform") & ~F.col("platform").isin(*PLATFORMS), "unknown platform"),
            when(~blank("url") & ~F.col("url").rlike("^https?://"), "relative url"),
            when(F.col("bands").isNull() | (F.size("bands") == 0), "no bands"),
            when(F.exists(pairs, lambda p: p.isNull() | (F.size(p) != 2) | F.exists(p, lambda x: x.isNull())), "band is no pair"),
            when(F.exists(pairs, lambda p: (F.size(p) == 2) & (F.get(p, F.lit(0)) >= F.get(p, F.lit(1)))), "band inverted"),
            *(when(~_has(k), f"no {k}") for k in ("lat", "lon")),
            *(when(_has(k) & (kind(k) != "VOID") & ~number(k), f"{k} is no number") for k in ("lat", "lon")),
            when(_has("lat") & _has("lon") & (F.col("lat").isNull() != F.col("lon").isNull()), "half a coordinate"),
            when(number("lat") & number("lon") & ~(F.col("lat").between(24.0000001, 49.9999999) & F.col("lon").between(-124.9999999, -66.0000001)), "outside the area"),
            when(browser & blank("browserPage"), "browserPage missing"),
            when(browser & ~blank("browserPage") & ~browsable(F.col("browserPage")), "browserPage invalid"),
            when(~browser & ~blank("browserPage"), "browserPage unneeded"),
            when(~_has("locationId"), "no locationId"),
            when(F.col("cashRounding").isNotNull() & ~F.col("cashRounding").isin(*ROUNDING_MODES), "unknown cashRounding"),
            when(F.col("futuresUnits").isNotNull() & ~F.col("futuresUnits").isin(*UNITS), "unknown futuresUnits"),
            when(_has("apiKey"), "carries a key"),
            when(F.col("url").rlike("(?i)[?&]apikey="), "key in url"),
            when(F.col("apiKeyEnv").isNotNull() & ~F.col("apiKeyEnv").rlike("^[A-Z][A-Z0-9_]*$"), "bad apiKeyEnv"),
            when(_has("cashRoundingCents") & (~number("cashRoundingCents") | ~F.col("cashRoundingCents").between(0, 1)), "bad cashRoundingCents"),
            when(_has("enabled") & (kind("enabled") != "BOOLEAN"), "enabled is no boolean"),
        )
    )


def load(parsed: DataFrame, order: str = "path") -> DataFrame:
    """Manifests with `complaints` and `warnings`, and `accepted`: valid, not a later duplicate, enabled."""
    same = Window.partitionBy("id").orderBy(order)
    found = parsed.withColumn("complaints", complaints()).withColumn("_place", F.row_number().over(same))
    again = F.col("id").isNotNull() & (F.col("id") != "") & (F.col("_place") > 1)
    listed = found.withColumn("complaints", F.when(again, F.array_append("complaints", "duplicate id")).otherwise(F.col("complaints")))
    warnings = F.array_compact(F.array(F.when(F.col("lat").isNull() | F.col("lon").isNull(), "no coordinates"), F.when(~F.col("inMerge"), "kept off the map")))
    return listed.withColumns({"warnings": warnings, "accepted": (F.size("complaints") == 0) & F.coalesce("enabled", F.lit(True))}).drop("_place")


def to_config(loaded: DataFrame) -> DataFrame:
    """Accepted manifests as the guards read them."""
    return loaded.where("accepted").select(
        F.col("id").alias("source_id"),
        F.col("locationId").alias("location_id"),
        _has("locationId").alias("has_location_key"),
        "location",
        "operator",
        "platform",
        "bands",
        F.lit(None).cast("double").alias("floor"),
        F.lit(None).cast("double").alias("ceiling"),
        F.col("cashRounding").alias("cash_rounding"),
        F.coalesce("cashRoundingCents", F.lit(0.0)).alias("cash_rounding_cents"),
        F.col("futuresUnits").alias("futures_units"),
        F.coalesce("schema", F.concat("platform", F.lit("/1"))).alias("schema"),
        url_twins(F.col("url"), F.col("altUrls")).alias("urls"),
        F.coalesce("browserPage", F.lit("")).alias("browser_page"),
        wire(F.col("platform")).alias("wire"),
    )


def fetch_keys(config: DataFrame) -> DataFrame:
    """The distinct pages to read; many sources share one."""
    return config.select("browser_page", F.get("urls", F.lit(0)).alias("url")).distinct()


def missing_secrets(loaded: DataFrame, names: list[str]) -> DataFrame:
    """Sources by the secret that they need and that is not set."""
    return loaded.where(F.col("apiKeyEnv").isNotNull() & ~F.col("apiKeyEnv").isin(names or [""])).groupBy("apiKeyEnv").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def blank_fields(loaded: DataFrame, fields: tuple[str, ...] = ("state", "website", "address", "phone"), mark: str = "SET THIS") -> DataFrame:
    """What a person still has to fill in, by manifest."""
    empty = F.array_compact(F.array(*(F.when(F.col(k).isNull() | (F.col(k) == mark), F.lit(k)) for k in fields)))
    return loaded.select("id", empty.alias("blanks"), F.size(empty).alias("n_blanks"))
