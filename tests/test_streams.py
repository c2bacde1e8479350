"""The write rule over many polls and over silence, feeds seen again, publications that no poll confirms."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import changes
from tallyboard.streaming.confirmations import confirmations, first_responses
from tallyboard.streaming.replay import replay
from tallyboard.streaming.silence import decide_with_silence

START = dt.datetime(2024, 1, 1)
hour = lambda h: START + dt.timedelta(hours=h)


def fold(polls, heartbeat=6, stale=336):
    out, checked, priced, price, seen = [], None, None, None, False
    for at, tie, cost in sorted(polls, key=lambda p: (p[0] is not None, p[0] or START, p[1])):
        moved = seen and cost != price
        hours = None if at is None or checked is None else (at - checked).total_seconds() / 3600
        skip = seen and not moved and hours is not None and hours < heartbeat
        changed = not seen or moved
        if changed:
            priced = at
        priced = priced or at
        old = not changed and at is not None and (at - priced).total_seconds() / 3600 > stale
        reason = "first run" if not seen else "price moved" if moved else "no change" if skip else "heartbeat: no readable clock" if hours is None else "heartbeat"
        out.append((tie, not skip, changed, reason, priced, old))
        checked, price, seen = checked if skip else at, cost, True
    return sorted(out)


@pytest.mark.parametrize("batch", [3, 10000])
def test_the_write_rule_is_the_fold(spark, batch):
    import random

    rng = random.Random(batch)
    polls = {k: [(None if rng.random() < 0.1 and k % 2 else hour(rng.choice([0.5, 3, 7]) * rng.randint(0, 40)), n, rng.choice([1, 1, 1, 2, None])) for n in range(60)] for k in range(6)}
    df = spark.createDataFrame([(k, at, n, p) for k, own in polls.items() for at, n, p in own], "k int, at timestamp, n long, price int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = changes.decide(df, "k", "at", "price", "n", stale=48.0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, own in polls.items():
        assert sorted((r.n, r.write, r.changed, r.reason, r.priced_at, r.stale) for r in got if r.k == k) == fold(own, stale=48)


def test_a_million_polls_of_one_source(spark):
    polls = spark.range(1_000_000).select(F.lit("s").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"), F.col("id").alias("n"), F.lit(1).alias("price"))
    began = time.time()
    got = changes.decide(polls, "k", "at", "price", "n").where("write").agg(F.count("*").alias("n"), F.count_if(F.col("n") % 360 == 0).alias("beats")).first()
    assert tuple(got) == (2778, 2778) and time.time() - began < 60


def test_a_quiet_weekend_costs_a_heartbeat_every_six_hours(spark):
    polls = spark.createDataFrame([("s", hour(h), h, 4) for h in range(64)], "k string, at timestamp, n long, price int")
    got = changes.decide(polls, "k", "at", "price", "n").where("write").collect()
    assert [r.n for r in got] == list(range(0, 64, 6)) and {r.priced_at for r in got} == {START}


SILENT = [
    [("a", hour(0), 1, 5), ("b", hour(0), 2, 7)],
    [("a", hour(2), 3, 5)],
    [("b", hour(40), 4, 7)],
    [("a", hour(41), 5, 6), ("b", hour(90), 6, 7)],
]
SAID = {
    ("a", 0, 1, "first run"), ("a", 2, 3, "no change"), ("a", 8, None, "heartbeat: no poll"), ("a", 30, None, "stale: no poll"), ("a", 41, 5, "price moved"), ("a", 47, None, "heartbeat: no poll"), ("a", 71, None, "stale: no poll"),
    ("b", 0, 2, "first run"), ("b", 6, None, "heartbeat: no poll"), ("b", 30, None, "stale: no poll"), ("b", 40, 4, "heartbeat"), ("b", 46, None, "heartbeat: no poll"), ("b", 90, 6, "heartbeat"),
}


@pytest.mark.parametrize("cuts", [(0, 1, 2, 3, 4), (0, 4)])
def test_silence_is_said_by_timers_wherever_batches_end(spark, cuts):
    rows = [spark.createDataFrame(sum(SILENT[a:b], []), "k string, at timestamp, n long, price long") for a, b in zip(cuts, cuts[1:])]
    got = replay(spark, [{"polls": r} for r in rows], lambda s: decide_with_silence(s["polls"], "k", "at", "price", "n", stale=30.0)).collect()
    assert {(r.k, (r.at - START).total_seconds() / 3600, r.n, r.reason) for r in got} == SAID and len(got) == len(SAID)


def test_feeds_come_once(spark):
    one = [("p", "https://api.dtn.com/markets/sites/E1/cash-bids", hour(0)), ("p", "https://api.dtn.com/markets/sites/E2/cash-bids", hour(1)), ("q", "https://other.org/", hour(1))]
    two = [("p", "https://api.dtn.com/markets/sites/E2/cash-bids?again", hour(2)), ("q", "https://api.dtn.com/markets/sites/E1/cash-bids", hour(2))]
    parts = [{"r": spark.createDataFrame(x, "page string, url string, at timestamp")} for x in (one, two)]
    got = replay(spark, parts, lambda s: first_responses(s["r"], "page", "at", "1 day").select("page", "platform", "ident")).collect()
    assert sorted(map(tuple, got)) == [("p", "dtn-cs", "E1"), ("p", "dtn-cs", "E2"), ("q", "dtn-cs", "E1")]


def test_a_publication_without_a_poll_in_time_is_withdrawn(spark):
    published = [[(1, 1, hour(0)), (2, 2, hour(0))], [(1, 3, hour(60))], [(1, 4, hour(1)), (1, 5, hour(120))]]
    seen = [[(1, hour(14)), (2, hour(-1))], [(9, hour(60)), (2, hour(15))], [(1, hour(121)), (9, hour(121))]]
    parts = [
        {"p": spark.createDataFrame(a, "k int, n int, at timestamp"), "q": spark.createDataFrame(b, "k int, at timestamp")} for a, b in zip(published, seen)
    ]
    got = replay(spark, parts, lambda s: confirmations(s["p"], s["q"], "k", "at")).collect()
    # The fourth comes too late; of the fifth the stream knows that it is confirmed, of the third that no poll can come.
    assert sorted((r.n, r.withdrawn) for r in got) == [(1, False), (2, True), (3, True), (5, False)]
    table = confirmations(parts[0]["p"], parts[0]["q"], "k", "at")
    assert sorted((r.n, r.withdrawn) for r in table.collect()) == [(1, False), (2, True)]
