"""Silence decided by buckets of sources: the fold of every source, nulls and large numbers, forgotten sources, and many sources."""

from __future__ import annotations

import datetime as dt
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyboard.streaming import silence
from tallyboard.streaming.replay import replay

START = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
BIG = 1 << 60


def fold(polls, upto, beat=6 * HOUR, stale=30 * HOUR):
    """Rows of one source, poll by poll."""
    out, s = [], None

    def silent(until):
        due = [(s["polled"] + beat, "heartbeat: no poll")] + [(s["priced"] + stale, "stale: no poll")] * (s["priced"] + stale > s["polled"])
        return [(at, None, s["price"], True, False, why, s["priced"], at - s["priced"] >= stale) for at, why in due if at <= until]

    for at, tie, price in sorted(polls, key=lambda p: (p[0], p[1] is None, p[1] or 0)):
        out += silent(at) if s else []
        moved = s is not None and price != s["price"]
        skip = s is not None and not moved and at - s["checked"] < beat
        why = "first run" if s is None else "price moved" if moved else "no change" if skip else "heartbeat"
        s = s or {"checked": None}
        s |= {"priced": at, "price": price} if why in ("first run", "price moved") else {}
        s |= {"polled": at, "checked": s["checked"] if skip else at}
        out.append((at, tie, price, not skip, why in ("first run", "price moved"), why, s["priced"], why not in ("first run", "price moved") and at - s["priced"] > stale))
    return out + silent(upto)


@pytest.mark.parametrize(("buckets", "zone"), [(1, "UTC"), (3, "Asia/Kolkata"), (64, "UTC")])
def test_buckets_are_the_fold_of_every_source(spark, buckets, zone):
    rng = random.Random(buckets)
    rows = [(k, START + rng.choice([0.5, 2, 3, 7]) * rng.randint(0, 30) * HOUR, n, rng.choice([BIG, BIG, BIG, BIG + 1, None])) for n, k in enumerate([None, *range(BIG, BIG + 12)] * 30)]
    rows = [(k, at + dt.timedelta(seconds=n % 7), None if n % 9 == 0 else BIG + n, p) if n % 9 == 0 else (k, at, BIG + n, p) for k, at, n, p in rows]
    # No source has two polls without a number at one time.
    rows = list({(k, at, n): (k, at, n, p) for k, at, n, p in rows}.values()) + [(BIG, START + 300.25 * HOUR, 1, BIG)]
    upto, cuts = max(r[1] for r in rows), [START, START + 20.1 * HOUR, START + 90.1 * HOUR, START + 1000 * HOUR]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = lambda t: (t - START) // dt.timedelta(microseconds=1)
        at = F.timestamp_micros(F.lit(micros(START) + 1704067200000000) + F.col("m"))
        parts = [spark.createDataFrame([(k, micros(t), n, p) for k, t, n, p in rows if a <= t < b], "k long, m long, n long, price long").select("k", at.alias("at"), "n", "price") for a, b in zip(cuts, cuts[1:])]
        found = replay(spark, [{"p": p} for p in parts], lambda s: silence.decide_with_silence(s["p"], "k", "at", "price", "n", stale=30.0, buckets=buckets))
        got = found.withColumns({c: F.unix_micros(c) - 1704067200000000 for c in ("at", "priced_at")}).select("k", "at", "n", "price", "write", "changed", "reason", "priced_at", "stale").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = [(k, micros(r[0]), *r[1:6], micros(r[6]), r[7]) for k in {r[0] for r in rows} for r in fold([r[1:] for r in rows if r[0] == k], upto)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_six_thousand_sources_take_seconds(spark):
    polls = spark.range(18_000).select((F.col("id") % 6000).cast("string").alias("k"), F.timestamp_seconds(F.lit(1704067200) + 7 * 3600 * F.floor(F.col("id") / 6000)).alias("at"), F.col("id").alias("n"), F.lit(1).alias("price"))
    began = time.time()
    got = replay(spark, [{"p": polls.where("n < 6000")}, {"p": polls.where("n >= 6000")}], lambda s: silence.decide_with_silence(s["p"], "k", "at", "price", "n", stale=13.0))
    assert {r.reason: r["count"] for r in got.groupBy("reason").count().collect()} == {"first run": 6000, "heartbeat": 12000, "heartbeat: no poll": 12000, "stale: no poll": 6000}
    assert time.time() - began < 60


class Values:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = self.getCurrentWatermarkInMs = lambda: now


class Handle:
    """The state of one bucket, with a list of what was asked of it."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def polls_of(names, hour):
    n = len(names)
    return pd.DataFrame({"bucket": [0] * n, "source": names, "event_at": [pd.Timestamp(0)] * n, "micros": np.full(n, hour * 3_600_000_000), "tie": range(n), "price": [1] * n, "flags": [0] * n})


def test_a_bucket_asks_its_state_once_and_forgets(spark):
    handle, rule = Handle(), silence._Rule("string", 6, 336, 10, True)
    rule.init(handle)
    ms = lambda h: int(h * 3_600_000)
    names = [str(k) for k in range(1000)]
    assert len(next(rule.handleInputRows((0,), iter([polls_of(names[:600], 0), polls_of(names[600:], 0)]), Values(ms(0))))) == 1000
    assert handle.calls == ["update", "timer"][::-1] and handle.timers == {ms(6)}
    out = next(rule.handleInputRows((0,), iter([polls_of(["7"], 1)]), Values(ms(1))))
    assert out["reason"].tolist() == [silence.REASONS.index("no change")] and handle.timers == {ms(6)}

    class Fired:
        getExpiryTimeInMs = staticmethod(lambda: ms(6))

    handle.timers.clear()
    assert len(next(rule.handleExpiredTimer((0,), Values(ms(6)), Fired))) == 999 and handle.timers == {ms(7)}
    # The seventh was last heard of at one o'clock, the others when their silence was said at six; ten hours later they are new again.
    out = next(rule.handleInputRows((0,), iter([polls_of(["7", "8"], 15.5)]), Values(ms(15.5))))
    assert sorted(silence.REASONS[r] for r in out["reason"]) == ["first run", "heartbeat"]
    out = next(rule.handleInputRows((0,), iter([polls_of(["9"], 16)]), Values(ms(16))))
    assert [silence.REASONS[r] for r in out["reason"]] == ["first run"] and sorted(handle.value[0]) == ["7", "8", "9"]
