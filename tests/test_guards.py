"""The guard matrix: constructed sources, each with the refusal that has to win, and what is published or withheld."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyboard.operators import changes, guards

ROW = "source_id string, seq int, location_id string, location string, commodity string, delivery string, cash double, basis double, basis_cents int, futures string, futures_at string, futures_price double"
SOURCE = "source_id string, location_id string, has_location_key boolean, bands map<string,array<double>>, floor double, ceiling double, cash_rounding string, cash_rounding_cents double, futures_units string"


def row(source, seq, cash=4.10, basis=-0.35, futures=None, cents=None, crop="Corn", place="T", place_id="1", when="Oct"):
    quote = round((cash - basis) * 100, 4) if futures is None and cash is not None and basis is not None else futures
    return (source, seq, place_id, place, crop, when, cash, basis, round(basis * 100) if cents is None and basis is not None else cents, "Dec corn", None, quote)


def source(name, **k):
    own = {"location_id": "1", "has_location_key": True, "bands": None, "floor": None, "ceiling": None, "cash_rounding": None, "cash_rounding_cents": None, "futures_units": None} | k
    return (name, *(own[c.split()[0]] for c in SOURCE.split(", ")[1:]))


CASES = {
    "no_rows": ([], {}),
    "no_location_key": ([{}], {"has_location_key": False}),
    "bad_futures_unit": ([{}], {"futures_units": "pesos"}),
    "location_absent": ([{"place_id": "9"}], {}),
    "null_id_many_places": ([{"place_id": ""}, {"place_id": None, "place": "U"}], {"location_id": None}),
    "all_zero_quote": ([{"futures": 0.0}], {}),
    "bad_rounding_mode": ([{}], {"cash_rounding": "banker"}),
    "identity_unexplained": ([{"futures": 446.0}, {}, {}], {}),
    "identity_unproven": ([{"futures": 445.25}, {"futures": 445.25}, {}], {}),
    "none_testable": ([{"basis": None, "futures": 445.0}], {}),
    "basis_units": ([{"cents": -3500}], {}),
    "null_cash": ([{}, {"cash": None, "futures": 445.0}], {}),
    "one_out_of_band": ([{}, {"cash": 41.0, "basis": -0.35}], {}),
    "bad_band": ([{}], {"bands": {"corn": [9.0, 2.0]}}),
    "nothing_publishable": ([{"crop": "Feed Meal"}], {}),
    "ok": ([{}, {}], {}),
    "ok_lagging": ([{"futures": 445.25}, {}, {}], {}),
    "ok_floor": ([{"futures": 445.75}], {"cash_rounding": "floor-cent"}),
    "ok_dollars": ([{"futures": 4.45}], {"futures_units": "dollars"}),
    "ok_null_quote": ([{"basis": None, "futures": None}, {}], {}),
    "ok_withheld": ([{}, {"crop": "Milo", "cash": 50.0}, {"crop": "Straw"}, {"futures": 0.0}], {}),
    "ok_own_band": ([{"crop": "Soft Straw"}], {"bands": {"straw": [1.0, 9.0], "soft straw": [2.0, 9.0]}}),
}


def outcome(spark):
    rows = [row(name, k, **r) for name, (own, _) in CASES.items() for k, r in enumerate(own)]
    return guards.run_guards(spark.createDataFrame(rows, ROW), spark.createDataFrame([source(n, **s) for n, (_, s) in CASES.items()], SOURCE))


def test_first_refusal_wins(spark):
    out = outcome(spark)
    refused = {r.source_id: r.code for r in out.refusals.collect()}
    assert refused == {n: n for n in CASES if not n.startswith("ok")}
    published = {r.source_id for r in out.published.collect()}
    assert published == {n for n in CASES if n.startswith("ok")}


def test_published_and_withheld_account_for_all_located_rows(spark):
    out = outcome(spark)
    withheld = sorted((r.source_id, r.commodity, r.rows, r.why) for r in out.withheld.collect())
    assert withheld == [("ok_withheld", "Corn", 1, "zero_quote"), ("ok_withheld", "Milo", 1, "all_out_of_band"), ("ok_withheld", "Straw", 1, "no_band")]
    counts = {r[0]: r[1] for r in out.published.groupBy("source_id").count().collect()}
    assert counts["ok_withheld"] == 1 and counts["ok_null_quote"] == 2 and counts["ok_lagging"] == 3
    assert {r.futures_month for r in out.published.collect()} == {"Dec"}
    assert {r.futures_price_cents for r in out.published.where("source_id = 'ok_dollars'").collect()} == {445.0}


def test_first_or_better_is_a_fold(spark):
    rows = spark.createDataFrame([(1, "a", None, None), (2, "a", 1.0, None), (3, "a", 2.0, None), (4, "a", None, 5.0), (5, "b", 1.0, 1.0), (6, "b", 2.0, 2.0)], "seq int, k string, cash double, basis double")
    got = sorted(tuple(r) for r in changes.first_or_better(rows, ["k"], "seq", ["cash", "basis"]).collect())
    assert got == [("a", 1, 4, None, 5.0), ("b", 5, 5, 1.0, 1.0)]


def test_heartbeat_clock_errors(spark):
    rows = spark.createDataFrame([("s", 1, "2024-01-01 00:00:00", 1), ("s", 2, "2024-01-01 05:59:00", 1), ("s", 3, "2024-01-01 06:00:00", 1), ("s", 4, "2024-01-01 06:30:00", 2), ("t", 5, None, 1), ("t", 6, "2024-01-01 00:00:00", 1)], "k string, n int, at string, price int")
    polls = rows.withColumn("at", F.col("at").cast("timestamp"))
    got = {r.n: (r.write, r.changed, r.reason) for r in changes.decide(polls, "k", "at", "price", "n").collect()}
    assert got == {1: (True, True, "first run"), 2: (False, False, "no change"), 3: (True, False, "heartbeat"), 4: (True, True, "price moved"), 5: (True, True, "first run"), 6: (True, False, "heartbeat: no readable clock")}
