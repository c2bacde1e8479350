"""Change between polls: de-duplication, moves, islands of equal prices, heartbeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tallyboard.functions.times import HEARTBEAT_H, STALE_H, hours_between

MAX_MOVE = 0.75


def first_or_better(rows: DataFrame, keys: list[str], order: str, needs: list[str]) -> DataFrame:
    """One row per key: the first, replaced by a later one that has a needed value the current one lacks.

    A fold, not a ranking: each row is compared with the holder of that moment. Rows of a
    key are folded by one aggregate, and a key's rows are those of one page.
    """
    others = [c for c in rows.columns if c not in keys and c != order]
    row = F.struct(F.col(order), *others)

    def better(held: Column, new: Column) -> Column:
        lacks = F.lit(False)
        for c in needs:
            lacks = lacks | (held[c].isNull() & new[c].isNotNull())
        return lacks

    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    rest = F.slice("_rows", 2, 1 << 30)
    held = F.aggregate(rest, F.get("_rows", F.lit(0)), lambda a, x: F.when(better(a, x), x).otherwise(a))
    return listed.withColumn("_held", held).select(*keys, F.get("_rows", F.lit(0))[order].alias("place"), F.col(f"_held.{order}").alias(order), *(F.col(f"_held.{c}").alias(c) for c in others))


def moves(before: DataFrame, after: DataFrame, max_move: float = MAX_MOVE) -> DataFrame:
    """Rows whose cash moved by more than the rail since the last committed board; unseen keys are skipped."""
    keys = ["source_id", "commodity", "delivery"]
    last = before.groupBy(*keys).agg(F.max_by("cash", "seq").alias("from"))
    joined = after.select(*keys, F.col("cash").alias("to")).join(last, keys)
    return joined.withColumn("move", F.col("to") - F.col("from")).where(F.abs("move") > max_move)


def _runs(polls: DataFrame, key: str, at: str, price: str, tie: str) -> DataFrame:
    """Each poll with `changed`, null-safe against the one before, and the number of its run of equal prices."""
    w = Window.partitionBy(key).orderBy(at, tie)
    changed = (F.row_number().over(w) == 1) | ~F.col(price).eqNullSafe(F.lag(price).over(w))
    return polls.withColumn("changed", changed).withColumn("_run", F.sum(F.col("changed").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def islands(polls: DataFrame, key: str, at: str, price: str, tie: str) -> DataFrame:
    """Each poll with `changed` and `priced_at`, the first time of its run of equal prices."""
    return _runs(polls, key, at, price, tie).withColumn("priced_at", F.min(at).over(Window.partitionBy(key, "_run"))).drop("_run")


def _followed(heartbeat: float):
    """Adds `write` to rows sorted by source and time, in one pass that keeps one time between batches.

    A row that is `_sure` writes whatever the last written check was; between such rows the next write is found by
    binary search over the clock, so the pass takes steps by writes and not by polls.
    """
    beat = heartbeat * 3.6e9

    def run(batches):
        checked = 0
        for batch in batches:
            t = pc.fill_null(batch.column("_micros"), 0).to_numpy(zero_copy_only=False)
            write = batch.column("_sure").to_numpy(zero_copy_only=False).copy()
            edges = np.unique([0, *np.flatnonzero(write).tolist(), len(t)]).tolist()
            for low, high in zip(edges, edges[1:]):
                spot = low
                if write[low]:
                    checked, spot = t[low], low + 1
                while spot < high and (spot := spot + int(np.searchsorted(t[spot:high], checked + beat))) < high:
                    write[spot], checked, spot = True, t[spot], spot + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(write)], names=[*batch.schema.names, "write"])

    return run


def decide(polls: DataFrame, key: str, at: str, price: str, tie: str, heartbeat: float = HEARTBEAT_H, stale: float = STALE_H) -> DataFrame:
    """Each poll with what the write-or-skip rule decides, replayed in time order; polls without a time come first.

    A poll is written if it is the first, if its price moved, or if the last written check is `heartbeat`
    hours old or has no time. The rule compares with the last write, so no window function gives it: windows over sources sorted by time
    tell the moves and the rows that write in any case, and one pass over the sorted rows follows the writes between these.
    The pass holds a batch of rows, however many polls a source has.
    """
    sorted_ = polls.select(key, at, tie, price).repartition(key).sortWithinPartitions(key, at, tie)
    w = Window.partitionBy(key).orderBy(at, tie)
    before = F.lag(at).over(w)
    unread = F.col(at).isNull() | before.isNull()
    dated = F.last(F.when(F.col("changed") | before.isNull(), F.col(at)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = _runs(sorted_, key, at, price, tie).withColumns(
        {"priced_at": dated, "_unread": unread, "_micros": F.unix_micros(F.col(at).cast("timestamp")), "_sure": F.col("changed") | unread | (hours_between(F.col(at), before) >= heartbeat)}
    )
    followed = runs.mapInArrow(_followed(heartbeat), StructType([*runs.schema.fields, StructField("write", BooleanType())]))
    reason = (
        F.when(F.col("changed") & (F.col("_run") == 1), "first run").when(F.col("changed"), "price moved").when(~F.col("write"), "no change").when(F.col("_unread"), "heartbeat: no readable clock").otherwise("heartbeat")
    )
    old = ~F.col("changed") & F.coalesce(hours_between(F.col(at), F.col("priced_at")) > stale, F.lit(False))
    return followed.select(key, at, tie, price, "write", "changed", reason.alias("reason"), "priced_at", old.alias("stale"))


def moved_sources(decided: DataFrame, key: str) -> DataFrame:
    return decided.where("write and changed").select(key).distinct()


def write_moved(decided: DataFrame, key: str, folder: str) -> None:
    """The ids of the moved sources as text, one a line, in order through the files of `folder`; written in every run, so that none moved is an empty list."""
    moved_sources(decided, key).select(F.col(key).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(folder)


def poll_message(decided: DataFrame, key: str) -> DataFrame:
    """One line per source: rows written and why."""
    return decided.groupBy(key).agg(F.count_if("write").alias("writes"), F.count_if("changed").alias("changes")).withColumn(
        "message", F.concat(F.col(key).cast("string"), F.lit(": "), F.col("changes").cast("string"), F.lit(" moved, "), (F.col("writes") - F.col("changes")).cast("string"), F.lit(" heartbeat"))
    )


def shared_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both periods have."""
    return after.select(*keys).intersect(before.select(*keys))
