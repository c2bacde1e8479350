"""The write-or-skip rule as keyed state with timers: a source that falls silent writes its heartbeat and turns stale without a poll.

State per source is the time of its last poll, its last written check, the time of its price and the price. What it will say if no poll
comes is due a heartbeat after its last poll and, once, when its price turns stale; a poll that comes earlier takes the first back.
What would have been said is said before a later poll is looked at as well, so the rows do not depend on where batches end.

Sources are kept together in buckets by the hash of their key. A bucket is one entry of the state with one timer, set to what is due next in it, and
its polls of a batch are decided together over arrays: calls to the state and frames go by buckets and not by sources.

In event time a timer fires when the watermark passes it, which a replay needs. In processing time it fires by the
clock, and the state of a source of which nothing comes for `forget` is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyboard.functions.times import HEARTBEAT_H, STALE_H

#: Lists with one item a source, times in microseconds; `told` is what has been said since the last poll, `flags` has `_UNNAMED` and `_FREE`. `timer`, in
#: milliseconds, is the one that is set, or -1.
STATE = "source array<{}>, flags array<int>, polled array<long>, checked array<long>, priced array<long>, price array<long>, told array<int>, touched array<long>, timer long"
FIELDS = ("source", "flags", "polled", "checked", "priced", "price", "told", "touched")
#: The state store that timers and times to live need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Enough for hundreds of thousands of sources; the state of a stream that has begun keeps its number.
BUCKETS = 512


_BEAT, _STALE = 1, 2
#: A row's key, tie or price that is null: pandas would turn whole numbers beside a null into floats.
_UNNAMED, _UNTIED, _FREE = 1, 2, 4
REASONS = ["first run", "price moved", "no change", "heartbeat: clock ahead", "heartbeat", "heartbeat: no poll", "stale: no poll"]
_NEVER = np.iinfo(np.int64).max


def _followed(at: np.ndarray, write: np.ndarray, edges: np.ndarray, checked: np.ndarray, beat: int) -> None:
    """Sets `write` for the rows of stretches that begin at `edges` and whose last check is `checked` there: a row is written a heartbeat after the last one."""
    ends = np.append(edges[1:], len(at))
    for k in np.flatnonzero(at[ends - 1] - checked >= beat).tolist():
        spot, end, last = int(edges[k]), int(ends[k]), int(checked[k])
        while spot < end and (spot := spot + int(np.searchsorted(at[spot:end], last + beat))) < end:
            write[spot], last, spot = True, int(at[spot]), spot + 1


class _Rule(StatefulProcessor):
    def __init__(self, kind: str, heartbeat: float, stale: float, forget: float | None, by_clock: bool):
        self.kind, self.by_clock = kind, by_clock
        self.beat, self.stale = round(heartbeat * 3.6e9), round(stale * 3.6e9)
        self.forget = None if forget is None else round(forget * 3.6e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", STATE.format(self.kind))

    def _now(self, values) -> int:
        return values.getCurrentProcessingTimeInMs() if self.by_clock else values.getCurrentWatermarkInMs()

    def _held(self, now: int) -> tuple[dict[str, np.ndarray], int]:
        """The bucket's sources, without those that are forgotten, and the timer that is set."""
        held = self.state.get() or ([],) * len(FIELDS) + (-1,)
        s = {"source": np.empty(len(held[0]), dtype=object)}
        s["source"][:] = held[0]
        s |= {f: np.array(v, dtype=np.int64) for f, v in zip(FIELDS[1:], held[1:])}
        if self.forget is not None:
            kept = s["touched"] + self.forget > now
            s = {f: v[kept] for f, v in s.items()}
        return s, held[-1]

    def _keep(self, s: dict[str, np.ndarray], timer: int) -> None:
        """Writes the state and sets its timer to what comes next."""
        beat, stale = self._due(s)
        after = [np.minimum(beat, stale) // 1000] + ([] if self.forget is None else [s["touched"] + self.forget])
        coming = min((int(a.min()) for a in after if len(a)), default=_NEVER)
        coming = -1 if coming >= _NEVER // 1000 else coming
        if coming != timer:
            if timer != -1:
                self.handle.deleteTimer(timer)
            if coming != -1:
                self.handle.registerTimer(coming)
        if len(s["source"]):
            self.state.update((*(s[f].tolist() for f in FIELDS), coming))
        else:
            self.state.clear()

    def _due(self, s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """When every source will say that no poll came and that its price is stale, if no poll comes."""
        beat = np.where(s["told"] & _BEAT, _NEVER, s["polled"] + self.beat)
        return beat, np.where((s["told"] & _STALE == 0) & (s["priced"] + self.stale > s["polled"]), s["priced"] + self.stale, _NEVER)

    def _silence(self, s: dict[str, np.ndarray], said: np.ndarray, due: np.ndarray, reason: str) -> tuple:
        """Rows of sources that are silent."""
        n = len(s["source"][said])
        told = np.full(n, REASONS.index(reason))
        return s["source"][said], due[said], np.zeros(n, np.int64), s["price"][said], s["flags"][said] | _UNTIED, np.ones(n, bool), np.zeros(n, bool), told, s["priced"][said], due[said] - s["priced"][said] >= self.stale

    def _frame(self, parts: list[tuple]) -> pd.DataFrame:
        names = ("source", "micros", "tie", "price", "flags", "write", "changed", "reason", "priced", "stale")
        out = {n: np.concatenate(c) for n, c in zip(names, zip(*parts))}
        return pd.DataFrame(out | {"flags": out["flags"].astype(np.int32), "reason": out["reason"].astype(np.int32)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        polls = pd.concat(list(rows), ignore_index=True)
        now = self._now(timerValues)
        s, timer = self._held(now)
        flags = polls["flags"].to_numpy(np.int64)
        code, names = pd.factorize(polls["source"], use_na_sentinel=False)
        used, code = np.unique(code * 2 + (flags & _UNNAMED), return_inverse=True)
        own, held = names[used // 2].tolist(), s["source"].tolist()
        # A number that is none equals itself here.
        known = {(n if n == n else None, f): k for k, (n, f) in enumerate(zip(held, (s["flags"] & _UNNAMED).tolist()))}
        places = np.array([known.setdefault((n if n == n else None, f), len(known)) for n, f in zip(own, (used % 2).tolist())])
        seen, more = places < len(held), len(known) - len(held)
        fresh = np.empty(more, dtype=object)
        fresh[:] = [n for n, k in zip(own, places.tolist()) if k >= len(held)]
        s = {f: np.concatenate([v, fresh if f == "source" else np.zeros(more, np.int64)]) for f, v in s.items()}

        at, tie, price = (polls[c].to_numpy(np.int64) for c in ("micros", "tie", "price"))
        order = np.lexsort((tie, flags & _UNTIED, at, code))
        code, at, tie, price, flags = code[order], at[order], tie[order], price[order], flags[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        # What a source was before each of its polls, its state before the first.
        was = {f: np.empty(len(at), v.dtype) for f, v in s.items()}
        was["source"], was["told"][:] = s["source"][places[code]], 0
        for f, v in (("polled", at), ("price", price), ("flags", flags)):
            was[f][1:] = v[:-1]
        before = np.ones(len(at), bool)
        before[first] = seen
        for f in ("polled", "price", "flags", "told"):
            was[f][first] = s[f][places]
        same = (was["price"] == price) & (was["flags"] & _FREE == flags & _FREE)
        changed = ~(before & same)
        index = np.arange(len(at))
        run = np.maximum.accumulate(np.where(changed, index, -1))
        start = first[code]
        priced = np.where(run >= start, at[run], s["priced"][places][code])
        was["priced"][1:] = priced[:-1]
        was["priced"][first] = s["priced"][places]

        checked, back = s["checked"][places], np.zeros(len(at), bool)
        back[first] = seen & (at[first] < checked)
        write = changed | back | (at - was["polled"] >= self.beat)
        edges = np.union1d(first, np.flatnonzero(write))
        _followed(at, write, edges, np.where(write[edges], at[edges], checked[code[edges]]), self.beat)
        wrote = np.maximum.accumulate(np.where(write, index, -1))
        reason = np.select([~before, changed, ~write, back], [0, 1, 2, 3], 4)
        rows_ = [(was["source"], at, tie, price, flags, write, changed, reason, priced, ~changed & (at - priced > self.stale))]
        for due, why in zip(self._due(was), REASONS[-2:]):
            if len(said := np.flatnonzero(before & (due <= at))):
                rows_.append(self._silence(was, said, due, why))

        s["polled"][places], s["price"][places], s["flags"][places] = at[last], price[last], flags[last] & ~_UNTIED
        s["priced"][places], s["told"][places], s["touched"][places] = priced[last], 0, now
        s["checked"][places] = np.where(wrote[last] >= first, at[wrote[last]], checked)
        self._keep(s, timer)
        yield self._frame(rows_)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, fired = self._now(timerValues), expiredTimerInfo.getExpiryTimeInMs()
        s, _ = self._held(now)
        parts = []
        for due, why, bit in zip(self._due(s), REASONS[-2:], (_BEAT, _STALE)):
            if len(said := np.flatnonzero((due // 1000 < now) | (due // 1000 <= fired))):
                parts.append(self._silence(s, said, due, why))
                s["told"][said] |= bit
                s["touched"][said] = now
        # The timer that fired is taken back by Spark.
        self._keep(s, -1)
        if parts:
            yield self._frame(parts)

    def close(self) -> None:
        pass


def decide_with_silence(
    polls: DataFrame, key: str, at: str, price: str, tie: str, heartbeat: float = HEARTBEAT_H, stale: float = STALE_H, forget: float | None = None, late: str | None = "0 seconds", buckets: int = BUCKETS
) -> DataFrame:
    """A stream of polls with write, changed, reason, priced_at and stale as `operators.changes.decide` has them, and the rows of silence.

    A source without a poll for `heartbeat` hours after its last one gets a row `heartbeat: no poll` at that time, and `stale: no poll` when its
    price has stood for `stale` hours and no poll has come since; both have no tie number. `late` is the watermark of event time, by
    which timers fire; None takes processing time, in which `forget` hours without a poll drop a source's state. Rows without a time are no polls.
    A task holds the state of one of the `buckets` and its polls of one batch at a time.
    """
    if late is not None and forget is not None:
        raise ValueError("a time to live needs processing time")
    kind = {f.name: f.dataType.simpleString() for f in polls.schema}[key]
    name, number, cost = F.col(f"`{key}`"), F.col(f"`{tie}`").cast("long"), F.col(f"`{price}`").cast("long")
    ready = polls.select(
        F.pmod(F.hash(name), F.lit(buckets)).alias("bucket"),
        F.coalesce(name, F.lit("0").try_cast(kind)).alias("source"),
        F.col(f"`{at}`").cast("timestamp").alias("event_at"),
        F.unix_micros(F.col(f"`{at}`").cast("timestamp")).alias("micros"),
        F.coalesce(number, F.lit(0)).alias("tie"),
        F.coalesce(cost, F.lit(0)).alias("price"),
        (F.when(name.isNull(), _UNNAMED).otherwise(0) + F.when(number.isNull(), _UNTIED).otherwise(0) + F.when(cost.isNull(), _FREE).otherwise(0)).alias("flags"),
    ).where("event_at IS NOT NULL")
    if late is not None:
        ready = ready.withWatermark("event_at", late)
    rule = _Rule(kind, heartbeat, stale, forget, late is None)
    output = f"source {kind}, micros long, tie long, price long, flags int, write boolean, changed boolean, reason int, priced long, stale boolean"
    found = ready.groupBy("bucket").transformWithStateInPandas(rule, output, "append", "processingTime" if late is None else "eventTime")
    known = lambda c, flag: F.when(F.col("flags").bitwiseAND(F.lit(flag)) == 0, F.col(c))
    return found.select(
        known("source", _UNNAMED).alias(key), F.timestamp_micros("micros").alias(at), known("tie", _UNTIED).alias(tie), known("price", _FREE).alias(price), "write", "changed",
        F.element_at(F.array(*map(F.lit, REASONS)), F.col("reason") + 1).alias("reason"), F.timestamp_micros("priced").alias("priced_at"), "stale",
    )
