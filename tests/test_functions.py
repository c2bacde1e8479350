"""Scalar readers against tables of what they have to give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import numbers, places, text, times


def one(spark, f, *values, kinds=None):
    kinds = kinds or ["string"] * len(values)
    df = spark.createDataFrame([values], ", ".join(f"c{k} {t}" for k, t in enumerate(kinds)))
    return df.select(f(*(F.col(f"c{k}") for k in range(len(values)))).alias("x")).head()[0]


def many(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, c string")
    return [r[1] for r in sorted(df.select("k", f(F.col("c")).alias("x")).collect())]


@pytest.mark.parametrize(
    ("f", "table"),
    [
        (numbers.parse_num, {"$4.32": 4.32, "-.35": -0.35, "(0.35)": -0.35, "+0.02": 0.02, "1,234.5": 1234.5, "- .35": -0.35, "4.7875s": 4.7875, "513-6s": 513.0, "N/A": None, "—": None, "": None, None: None}),
        (numbers.parse_ticks, {"459-4": 459.5, "478'6": 478.75, "478’6": 478.75, "513-6s": 513.75, "+0-4": 0.5, "-0-4": -0.5, "459-8": None, "459-12": None, "459-4 x": None, "4.7875s": 4.7875, "3.9500": 3.95}),
        (numbers.parse_eighths, {"473'0": 473.0, "1222'2s": 1222.25, "473'": None, "473.5": 473.5, "473'9": 474.125, "-3'4": None}),
        (numbers.tick_flag, {"473-0s": "s", "4.7875s": "s", "478'6": None, "513": None, "Closed": None}),
        (numbers.strict_decimal, {"1.5": 1.5, "+2": 2.0, "1.0d": None, "": None, "1,000": None}),
        (numbers.strict_money, {"$1,234.50": 1234.5, "-0.35": -0.35, "1.": None}),
        (numbers.loose_number, {" 4.10 ": 4.1, "": None, "1e2": 100.0, "0x10": 16.0, "1.0d": None, ".5": 0.5}),
        (text.title_case, {"YELLOW CORN": "Yellow Corn", "RED-WING": "Red-Wing"}),
        (text.decode_entities, {"&#8211;&#x2013;": "––", "&amp;lt;": "&lt;", "a&nbsp;b": "a b", "5&CENT;": "5c", "&bogus;": "&bogus;", "&#1114112;": "&#1114112;"}),
        (text.strip_tags, {"<p>a</p><script>x</script><br/>b&amp;c": "a b&c", " x﻿ y ": "x y", "<style>p{}</style>": ""}),
        (text.slug, {"Ag Partners!": "agpartners", None: ""}),
    ],
    ids=lambda v: getattr(v, "__name__", ""),
)
def test_table(spark, f, table):
    assert many(spark, f, list(table)) == list(table.values())


@pytest.mark.parametrize(("v", "raw", "cents"), [(-0.52, "-0.52", -52), (-52.0, "-52", -52), (-3.0, "-3.00", -300), (-3.0, "-3", -3), (-2.99, None, -299), (-3.0, None, -3), (None, "x", None), (-0.495, "-0.495", -49)])
def test_basis_to_cents(spark, v, raw, cents):
    f = numbers.basis_to_cents if raw is not None else lambda c, _: numbers.basis_to_cents(c)
    assert one(spark, f, v, raw, kinds=["double", "string"]) == cents


def test_split_postal(spark):
    got = many(spark, text.split_postal, ["Goodhue, MN 55027", "Cylon, WI", "FALL CREEK", "X, Minnesota", None])
    assert [tuple(g) for g in got] == [("Goodhue", "MN", "55027"), ("Cylon", "WI", None), ("FALL CREEK", None, None), ("X", None, None), ("", None, None)]


def test_places(spark):
    got = many(spark, places.destination_kind, ["Main", "Green Plains Elgin", "Elgin Ethanol", "Farmers Co-op", "Albert Lea/Austin", "Goodhue", "", None, "Soyland"])
    assert [tuple(g) for g in got] == [("placeholder", "main"), ("buyer", "green plains"), ("facility", "ethanol"), ("suffix", "farmers"), ("joined", None), (None, None), (None, None), (None, None), (None, None)]
    assert one(spark, places.id_for, "Ag Partners", "Red Wing") == "agpartners-redwing" and one(spark, places.id_for, "SET THIS", "Elgin") is None
    assert one(spark, places.slug_variants, "Sunrise Co-op, Inc.") == ["sunrisecoop", "sunriseCoop", "sunrise-coop", "sunrise", "sunrisecooperative", "sunriseCooperative", "sunrise-cooperative"]
    assert one(spark, places.slug_variants, "The Co.") == ["theco", "theCo", "the-co"]
    assert one(spark, places.slug_variants, "A & B Co.op Grain/Farms LLC") == ["aandbcoopgrainfarms", "aAndBCoopGrainFarms", "a-and-b-coop-grain-farms", "aandb", "aandbcooperativegrainfarms", "aAndBCooperativeGrainFarms", "a-and-b-cooperative-grain-farms"]
    assert one(spark, places.slug_variants, "Big Co-Operative") == ["bigcooperative", "bigCooperative", "big-cooperative", "bigcoop", "bigCoop", "big-coop"]


@pytest.mark.parametrize(
    ("health", "hours", "state"),
    [("live", 0, "live"), ("live", 6, "late"), ("live", 14, "down"), ("live", -0.2, "live"), ("live", -1, "down"), ("broken", 1, "late"), ("refused", -5, "late"), ("broken", 14, "down"), ("live", None, "down")],
)
def test_state_of(spark, health, hours, state):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp")
    at = F.lit(None).cast("timestamp") if hours is None else F.timestamp_micros(F.unix_micros(now) - F.lit(int(hours * 3.6e9)))
    assert spark.range(1).select(times.state_of(F.lit(health), at, now)).head()[0] == state


@pytest.mark.parametrize(
    ("crons", "at", "fires"),
    [
        (["3,13 * * * *"], "2024-01-01 00:03:00", "2024-01-01 00:13:00"),
        (["0 0 1 * *"], "2024-01-01 00:00:00", None),
        (["0 12 * * 1-5", "30 9 * * 6"], "2024-01-05 12:00:00", "2024-01-06 09:30:00"),
        (["5 4 15 * 0"], "2024-01-08 00:00:00", "2024-01-14 04:05:00"),
        (["bad"], "2024-01-01 00:00:00", None),
        (["*/0 * * * *"], "2024-01-01 00:00:00", None),
    ],
)
def test_next_fire(spark, crons, at, fires):
    got = spark.range(1).select(times.next_fire(F.array(*map(F.lit, crons)), F.lit(at).cast("timestamp")).cast("string")).head()[0]
    assert got == fires


def test_local_time_follows_summer(spark):
    at = lambda t: tuple(spark.range(1).select(times.local_parts(F.lit(t).cast("timestamp"))).head()[0])
    assert at("2024-01-01 12:00:00") == ("2024-01-01", "06:00:00", "CST") and at("2024-07-01 03:00:00") == ("2024-06-30", "22:00:00", "CDT")
