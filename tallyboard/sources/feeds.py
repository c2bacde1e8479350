"""JSON feeds as tables of bids: one transform per feed, chosen by platform.

Each takes bodies (source_id, url, body) and gives bids and refusals. The shape of a body is judged
first, so a refusal says what is wrong; rows that lack a field are dropped; no body is walked in Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.numbers import loose_number, parse_ticks, round_half_up, round_to, strict_decimal
from tallyboard.functions.text import host

#: Columns of every feed's bids.
BIDS = [
    "source_id", "seq", "source", "location_id", "location", "commodity", "delivery", "cash", "basis", "basis_cents",
    "futures", "futures_price", "futures_at", "futures_flag", "change",
]


@dataclass
class Feed:
    bids: DataFrame
    refusals: DataFrame
    #: Rows that were refused one by one: source_id, location, commodity, delivery, why.
    unreconciled: DataFrame | None = None


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _finish(rows: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Prices at four decimals and basis in cents; what a feed lacks is null."""
    have = {"cash": round_to(F.col("cash"), 4), "basis": round_to(F.col("basis"), 4), "basis_cents": round_half_up(F.col("basis") * 100).cast("int")}
    out = rows.withColumns(have | (extra or {}))
    for name, kind in (("futures_at", "string"), ("futures_flag", "string"), ("change", "double")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out.select(*BIDS)


def _refused(bodies: DataFrame, code: Column, bids: DataFrame) -> DataFrame:
    """Bodies with a shape code, and bodies of a good shape that gave no bid."""
    none = bodies.join(bids.select("source_id").distinct(), "source_id", "left_anti")
    return none.select("source_id", F.coalesce(code, F.lit("no_usable_row")).alias("code"))


def _shape(body: Column, wanted: str, path: str = "$") -> Column:
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), path, "variant"))
    return F.when(F.try_parse_json(body).isNull(), "not_json").when(kind.isNull() | ~kind.startswith(wanted), "wrong_shape")


def nested_board(bodies: DataFrame) -> Feed:
    """locations, groups, bids; dollars as text; the unit stands on the group."""
    schema = """struct<meta:struct<lastUpdated:string>,locations:array<struct<id:string,name:string,groups:array<struct<displayName:string,bidPriceUoM:string,
      bids:array<struct<description:string,bidPrice:string,basisPrice:string,futuresPrice:string,futuresChange:string,futuresSymbol:string>>>>>>>"""
    code = F.coalesce(_shape(F.col("body"), "ARRAY", "$.locations"), F.when(F.size(F.from_json("body", "struct<locations:array<string>>")["locations"]) == 0, "empty"))
    read = bodies.where(code.isNull()).select("source_id", F.col("url").alias("source"), F.from_json("body", schema).alias("d"))
    rows = (
        read.select("source_id", "source", F.col("d.meta.lastUpdated").alias("at"), F.posexplode("d.locations").alias("i", "l"))
        .select("source_id", "source", "at", "i", "l", F.posexplode("l.groups").alias("j", "g"))
        .select("source_id", "source", "at", "i", "j", "l", "g", F.posexplode("g.bids").alias("k", "b"))
    )
    name, unit = _text(F.col("g.displayName")), _text(F.col("g.bidPriceUoM"))
    unit_name = F.when(unit == "", F.lit("unit unstated")).otherwise(unit)
    rows = rows.select(
        "source_id",
        "source",
        F.struct("i", "j", "k").alias("seq"),
        F.col("l.id").alias("location_id"),
        _text(F.col("l.name")).alias("location"),
        name.alias("_name"),
        F.when(F.lower(unit) == "bu", name).otherwise(F.concat(name, F.lit(" ("), unit_name, F.lit(")"))).alias("commodity"),
        _text(F.col("b.description")).alias("delivery"),
        loose_number(F.col("b.bidPrice")).alias("cash"),
        loose_number(F.col("b.basisPrice")).alias("basis"),
        F.nullif(_text(F.col("b.futuresSymbol")), F.lit("")).alias("futures"),
        round_to(loose_number(F.col("b.futuresPrice")) * 100, 4).alias("futures_price"),
        round_to(loose_number(F.col("b.futuresChange")) * 100, 4).alias("change"),
        F.col("at").alias("futures_at"),
    ).where("cash is not null and basis is not null and futures_price is not null and delivery <> '' and location <> '' and _name <> ''")
    bids = _finish(_numbered(rows))
    return Feed(bids, _refused(bodies, code, bids))


def grouped_offers(bodies: DataFrame) -> Feed:
    """commodity groups of offers; cents as given; the period is appended to a comment."""
    schema = """array<struct<commodity:struct<name:string>,offers:array<struct<destination:string,deliveryPeriod:string,comments:string,futuresMonth:string,
      futuresPrice:string,basisPrice:string,standardCashPrice:string>>>>"""
    unnamed = F.exists(F.from_json("body", schema), lambda g: F.trim(F.coalesce(g["commodity"]["name"], F.lit(""))) == "")
    code = F.coalesce(_shape(F.col("body"), "ARRAY"), F.when(F.size(F.from_json("body", "array<string>")) == 0, "empty"), F.when(unnamed, "unnamed_group"))
    read = bodies.where(code.isNull()).select("source_id", F.col("url").alias("source"), F.posexplode(F.from_json("body", schema)).alias("i", "g"))
    rows = read.select("source_id", "source", "i", "g", F.posexplode("g.offers").alias("k", "o"))
    period, comment = _text(F.col("o.deliveryPeriod")), _text(F.col("o.comments"))
    place = _text(F.col("o.destination"))
    rows = rows.select(
        "source_id",
        "source",
        F.struct("i", "k").alias("seq"),
        place.alias("location_id"),
        place.alias("location"),
        _text(F.col("g.commodity.name")).alias("commodity"),
        period.alias("_period"),
        F.when(comment != "", F.concat(comment, F.lit(" ("), period, F.lit(")"))).otherwise(period).alias("delivery"),
        strict_decimal(F.col("o.standardCashPrice")).alias("cash"),
        strict_decimal(F.col("o.basisPrice")).alias("basis"),
        F.nullif(_text(F.col("o.futuresMonth")), F.lit("")).alias("futures"),
        strict_decimal(F.col("o.futuresPrice")).alias("futures_price"),
    ).where("location <> '' and _period <> '' and cash is not null and basis is not null and futures_price is not null")
    bids = _finish(_numbered(rows))
    return Feed(bids, _refused(bodies, code, bids))


def widget_list(bodies: DataFrame) -> Feed:
    """A flat list, bare or wrapped; a second pair of prices has to agree or the row is refused."""
    row = """struct<location:struct<id:string,name:string>,commodityDisplayName:string,contractDeliveryLabel:string,cashPrice:string,basisPrice:string,
      primaryPrice:struct<cashPrice:string,basisPrice:string,unitOfMeasure:string>,futuresQuote:string,futuresChange:string,symbol:string,unitOfMeasure:string,
      conversionUsed:string,convertedPrice:string,realTime:boolean>"""
    bare, wrapped = _shape(F.col("body"), "ARRAY"), _shape(F.col("body"), "ARRAY", "$.cashBids")
    listed = F.when(bare.isNull(), F.from_json("body", f"array<{row}>")).when(wrapped.isNull(), F.from_json("body", f"struct<cashBids:array<{row}>>")["cashBids"])
    code = F.coalesce(F.when(bare.isNotNull() & wrapped.isNotNull(), bare), F.when(F.size(listed) == 0, "empty"))
    read = bodies.where(code.isNull()).select("source_id", F.col("url").alias("source"), F.posexplode(listed).alias("seq", "b"))
    number = lambda c: loose_number(F.col(c))
    unit = _text(F.coalesce("b.unitOfMeasure", "b.primaryPrice.unitOfMeasure"))
    converted = F.col("b.convertedPrice").isNotNull() | F.coalesce(F.col("b.conversionUsed").isNotNull() & ~F.coalesce(number("b.conversionUsed") == 0, F.lit(False)), F.lit(False))
    name = _text(F.col("b.commodityDisplayName"))
    unit_name = F.when(unit == "", F.lit("unit unstated")).otherwise(unit)
    odd = F.concat(name, F.lit(" ("), unit_name, F.when(converted, ", converted").otherwise(""), F.lit(")"))
    differs = lambda a, b: F.coalesce(F.abs(number(a) - number(b)) > 1e-9, F.lit(False))
    rows = read.select(
        "source_id",
        "source",
        "seq",
        F.col("b.location.id").alias("location_id"),
        _text(F.col("b.location.name")).alias("location"),
        name.alias("_name"),
        F.when((F.lower(unit) == "bushels") & ~converted, name).otherwise(odd).alias("commodity"),
        _text(F.col("b.contractDeliveryLabel")).alias("delivery"),
        number("b.cashPrice").alias("cash"),
        number("b.basisPrice").alias("basis"),
        F.nullif(_text(F.col("b.symbol")), F.lit("")).alias("futures"),
        parse_ticks(F.col("b.futuresQuote")).alias("futures_price"),
        F.when(~F.col("b.realTime"), "delayed").alias("futures_flag"),
        parse_ticks(F.col("b.futuresChange")).alias("change"),
        (differs("b.primaryPrice.cashPrice", "b.cashPrice") | differs("b.primaryPrice.basisPrice", "b.basisPrice")).alias("_differs"),
    ).where("location <> '' and location_id is not null and _name <> '' and delivery <> '' and cash is not null and basis is not null and futures_price is not null")
    bids = _finish(_numbered(rows.where("not _differs")))
    refused = rows.where("_differs").select("source_id", "location", F.col("_name").alias("commodity"), "delivery", F.lit("price pair differs").alias("why"))
    return Feed(bids, _refused(bodies, code, bids), refused)


def first_party(bodies: DataFrame) -> Feed:
    """{"bids": [...]} in the engine's own columns; anything else is an empty board."""
    own = """array<struct<seq:int,source:string,locationId:string,location:string,commodity:string,delivery:string,cash:double,basis:double,basisCents:int,
      futures:string,futuresPrice:double,futuresAt:string,futuresFlag:string,change:double>>"""
    read = bodies.select("source_id", F.explode(F.from_json("body", f"struct<bids:{own}>")["bids"]).alias("b")).select("source_id", "b.*")
    names = {"locationId": "location_id", "basisCents": "basis_cents", "futuresPrice": "futures_price", "futuresAt": "futures_at", "futuresFlag": "futures_flag"}
    bids = read.withColumnsRenamed(names).select(*BIDS)
    return Feed(bids, _refused(bodies, F.lit(None).cast("string"), bids))


def _numbered(rows: DataFrame) -> DataFrame:
    """Page order from 0 by the place in the body; a source's rows are those of one page."""
    from pyspark.sql import Window

    return rows.withColumn("seq", (F.row_number().over(Window.partitionBy("source_id").orderBy("seq")) - 1).cast("int"))


def registry() -> dict[str, Callable[[DataFrame], Feed]]:
    from tallyboard.sources import layouts

    return {
        "cashbidssingle": layouts.list_and_table,
        "aghost": layouts.grid,
        "fragment": layouts.fragment,
        "graindesk": grouped_offers,
        "dtn-cs": widget_list,
        "bushel": nested_board,
        "first-party": first_party,
    }


def extract(bodies: DataFrame, platforms: tuple[str, ...] | None = None) -> Feed:
    """All bodies (source_id, platform, url, body), each by its platform's transform; `platforms` names those that can occur."""
    parts = [adapter(bodies.where(F.col("platform") == name).drop("platform")) for name, adapter in registry().items() if platforms is None or name in platforms]
    known = list(registry())
    unknown = bodies.where(~F.col("platform").isin(known)).select("source_id", F.lit("no_adapter").alias("code"))
    refused_rows = [p.unreconciled for p in parts if p.unreconciled is not None]
    return Feed(
        reduce(DataFrame.unionByName, (p.bids for p in parts)),
        reduce(DataFrame.unionByName, (p.refusals for p in parts), unknown),
        reduce(DataFrame.unionByName, refused_rows) if refused_rows else None,
    )


# ---------------------------------------------------------------- looking at unknown JSON

CONTAINERS = ["data", "bids", "results", "items"]
PLACE_KEYS = ["location", "site", "locationName", "deliveryLocation", "elevator"]


def _list_path(body: Column) -> Column:
    """Where the rows of an unknown body are: at the root or under the first container key that is there."""
    kind = lambda p: F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), p, "variant"))
    root = F.when(kind("$").startswith("ARRAY"), "$")
    return F.coalesce(root, *(F.when(kind(f"$.{k}").isNotNull() & (kind(f"$.{k}") != "VOID"), f"$.{k}") for k in CONTAINERS))


def _rows(body: Column) -> Column:
    path = _list_path(body)
    read = lambda p: F.from_json(F.get_json_object(body, p), "array<string>")
    return F.coalesce(*(F.when(path == p, read(p)) for p in ["$", *(f"$.{k}" for k in CONTAINERS)]))


def roster(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """Distinct locations (place_id, name) of each unknown body, under the first key that every row has."""
    rows = bodies.select(key, F.posexplode(_rows(F.col(body))).alias("n", "row"))
    value = lambda k: F.get_json_object("row", f"$.{k}")
    whole = rows.groupBy(key).agg(*(F.count_if(value(k).isNull()).alias(f"_{k}") for k in PLACE_KEYS))
    chosen = whole.select(key, F.coalesce(*(F.when(F.col(f"_{k}") == 0, F.lit(k)) for k in PLACE_KEYS)).alias("_key")).where("_key is not null")
    picked = rows.join(chosen, key).withColumn("v", F.coalesce(*(F.when(F.col("_key") == k, value(k)) for k in PLACE_KEYS)))
    part = lambda k: F.get_json_object("v", f"$.{k}")
    is_object = F.schema_of_variant(F.try_parse_json("v")).startswith("OBJECT")
    place = F.when(F.coalesce(is_object, F.lit(False)), F.coalesce(part("id"), part("name"))).otherwise(F.col("v"))
    name = F.when(F.coalesce(is_object, F.lit(False)), F.coalesce(part("name"), part("id"), F.lit(""))).otherwise(F.col("v"))
    return picked.groupBy(key, place.alias("place_id")).agg(F.min_by(name, "n").alias("name"))


def count_locations(bodies: DataFrame, key: str, body: str) -> DataFrame:
    return roster(bodies, key, body).groupBy(key).agg(F.count("*").alias("locations"))


def response_verdict(status: Column, body: Column) -> Column:
    """What an answer to a candidate key says."""
    kind = F.schema_of_variant(F.try_parse_json(body))
    return (
        F.when(status.isNull() | (status == 0), "fetch failed")
        .when(status == 401, "no such token")
        .when((status < 200) | (status >= 300), F.concat(F.lit("HTTP "), status.cast("string")))
        .when(kind.isNull(), "200 but not JSON")
        .when(~kind.startswith("ARRAY"), "200 but not an array")
        .otherwise("HIT")
    )


def shape(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """The schema of each body that is an object or an array, first elements merged."""
    kind = F.schema_of_variant(F.try_parse_json(body))
    return bodies.select(key, F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), kind).alias("shape"))


def origin(url: Column) -> Column:
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), host(url))
