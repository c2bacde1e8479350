"""Streams of polls: the write-or-skip rule as keyed state, quiet periods, and an idempotent sink."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyboard.functions.times import HEARTBEAT_H

STATE = "checked timestamp, priced timestamp, price long"


def decide_stream(polls: DataFrame, key: str, at: str, price: str, tie: str, heartbeat: float = HEARTBEAT_H) -> DataFrame:
    """A streaming DataFrame of polls with write, changed, reason and priced_at, as `operators.changes.decide` gives for a table.

    State per key is the last written check, the time of its price and the price. Rows of a batch are
    taken in time order; batches are taken as they come.
    """
    kinds = {f.name: f.dataType.simpleString() for f in polls.schema}
    output = f"`{key}` {kinds[key]}, `{at}` timestamp, `{tie}` {kinds[tie]}, `{price}` long, write boolean, changed boolean, reason string, priced_at timestamp"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values([at, tie], kind="stable")
        checked, priced, last = state.get if state.exists else (None, None, None)
        seen, out = state.exists, []
        for when, number, cost in zip(rows[at], rows[tie], rows[price]):
            cost = None if pd.isna(cost) else int(cost)
            moved = seen and cost != last
            hours = None if not seen or pd.isna(checked) or pd.isna(when) else (when - checked).total_seconds() / 3600
            skip = seen and not moved and hours is not None and 0 <= hours < heartbeat
            changed = not seen or moved
            reason = "first run" if not seen else "price moved" if moved else "no change" if skip else "heartbeat: no readable clock" if hours is None else "heartbeat: clock ahead" if hours < 0 else "heartbeat"
            if changed:
                priced, last = when, cost
            if not skip:
                checked = when
            seen = True
            out.append((group[0], when, number, cost, not skip, changed, reason, priced))
        state.update((checked, priced, last))
        found = pd.DataFrame(out, columns=[key, at, tie, price, "write", "changed", "reason", "priced_at"])
        found[price] = found[price].astype("Int64")
        yield found

    ready = polls.select(key, F.col(at).cast("timestamp").alias(at), tie, F.col(price).cast("long").alias(price))
    return ready.groupBy(key).applyInPandasWithState(step, output, STATE, "append", GroupStateTimeout.NoTimeout)


def quiet_sessions(responses: DataFrame, key: str, at: str, gap: str = "2500 milliseconds", watermark: str | None = None) -> DataFrame:
    """Runs of responses that end when nothing comes for the gap; on a stream, late ones are dropped after the watermark."""
    own = responses.withWatermark(at, watermark) if watermark else responses
    return own.groupBy(key, F.session_window(at, gap)).agg(F.count("*").alias("n_responses")).select(
        key, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("quiet_at"), "n_responses"
    )


def captures(responses: DataFrame, key: str, at: str, opened: str, quiet: float = 2.5, cap: float = 45.0) -> DataFrame:
    """One capture a page, from when it was `opened`: key, n_responses, last, ended, quiet.

    It ends when nothing comes for `quiet` seconds, or `cap` seconds after the page was opened, whichever is first; what comes
    later is not in it. `quiet` tells how it ended. The responses of a page are those of one visit.
    """
    seconds = lambda c: F.unix_micros(c) / F.lit(1e6)
    w = Window.partitionBy(key).orderBy(at)
    wait = seconds(F.col(at)) - seconds(F.coalesce(F.lag(at).over(w), F.col(opened)))
    late = F.sum((F.col("_wait") >= quiet).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    own = responses.withColumn("_wait", wait).withColumn("_late", late).withColumn("_in", (F.col("_late") == 0) & (seconds(F.col(at)) - seconds(F.col(opened)) < cap))
    found = own.groupBy(key).agg(F.count_if("_in").alias("n_responses"), F.max(F.when(F.col("_in"), F.col(at))).alias("last"), F.min(opened).alias("_opened"))
    after = lambda c, s: F.timestamp_micros((F.unix_micros(c) + F.lit(int(s * 1e6))).cast("long"))
    silent, limit = after(F.coalesce("last", "_opened"), quiet), after(F.col("_opened"), cap)
    return found.select(key, "n_responses", "last", F.least(silent, limit).alias("ended"), (silent <= limit).alias("quiet"))


def commit_batches(folder: str, key: str):
    """A foreachBatch sink: the written polls of a batch in a folder of that batch, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.where("write").repartition(key).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write
