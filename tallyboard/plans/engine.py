"""One run over all sources: manifests, bodies and the last snapshots to what is published and written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyboard.functions.times import HEARTBEAT_H, STALE_H, hours_between
from tallyboard.operators.guards import run_guards
from tallyboard.sources import feeds
from tallyboard.sources.folders import write_lines
from tallyboard.sources.manifests import to_config
from tallyboard.sources.scratch import written


@dataclass
class Run:
    published: DataFrame
    withheld: DataFrame
    refusals: DataFrame
    diagnostics: DataFrame
    snapshots: DataFrame
    index: DataFrame


def snapshot(published: DataFrame, now: Column) -> DataFrame:
    """One row per published source: its bids in page order, their number and a hash of them for comparison."""
    bid = F.struct("seq", "commodity", "delivery", "futures_month", "cash", "basis_dollars", "basis_cents", "futures_price_cents")
    out = published.groupBy("source_id").agg(F.array_sort(F.collect_list(bid)).alias("bids"), F.count("*").alias("count"))
    return out.withColumns({"bids_hash": F.sha2(F.to_json("bids"), 256), "checked_at": now, "priced_at": now, "status": F.lit("ok")})


def decide_against(snapshots: DataFrame, previous: DataFrame, heartbeat: float = HEARTBEAT_H, stale: float = STALE_H) -> DataFrame:
    """Snapshots with write, changed, reason and carried clocks; `previous` has source_id, bids_hash, count, priced_at, checked_at."""
    was = previous.select("source_id", F.struct("bids_hash", "count", "priced_at", "checked_at").alias("_was"))
    joined = snapshots.join(was, "source_id", "left")
    first = F.col("_was").isNull()
    moved = ~first & (~F.col("bids_hash").eqNullSafe(F.col("_was.bids_hash")) | (F.col("count") != F.col("_was.count")))
    same = ~first & ~moved
    hours = hours_between(F.col("checked_at"), F.col("_was.checked_at"))
    skip = same & F.coalesce((hours >= 0) & (hours < heartbeat), F.lit(False))
    priced = F.when(same, F.coalesce("_was.priced_at", "priced_at")).otherwise(F.col("priced_at"))
    old = same & F.coalesce(hours_between(F.col("checked_at"), priced) > stale, F.lit(False))
    reason = F.when(first, "first run").when(moved, "price moved").when(skip, "no change").when(hours.isNull(), "heartbeat: no readable clock").when(hours < 0, "heartbeat: clock ahead").otherwise("heartbeat")
    return joined.withColumns({"write": ~skip, "changed": ~same, "reason": reason, "priced_at": priced, "status": F.when(old, "stale").otherwise("ok")}).drop("_was")


def run(loaded: DataFrame, bodies: DataFrame, previous: DataFrame, now: Column, platforms: tuple[str, ...] | None = None, only: str | None = None) -> Run:
    """`loaded` from `sources.manifests.load`, `bodies` (source_id, platform, url, body). A refused source keeps its last snapshot: it is not in `snapshots`.
    `only` names the one source to run; it is an error if no accepted source has that id.

    The bids are written once: all outputs start from them, and no page is parsed twice.
    """
    accepted = to_config(loaded)
    config = written(accepted if only is None else accepted.where(F.col("source_id") == only))
    if only is not None and config.isEmpty():
        raise ValueError(f"no enabled source matches {only}")
    read = feeds.extract(bodies.join(config.select("source_id"), "source_id", "left_semi"), platforms)
    out = run_guards(written(read.bids), config)
    shape = written(read.refusals).select("source_id", F.col("code").alias("_shape"))
    refusals = out.refusals.join(shape, "source_id", "left").select("source_id", "rank", F.coalesce("_shape", "code").alias("code"))
    decided = decide_against(snapshot(out.published, now), previous)
    held = out.withheld.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("commodity", "rows", "why"))).alias("withheld"))
    crops = out.published.groupBy("source_id").agg(F.array_sort(F.collect_set("commodity")).alias("commodities"))
    index = (
        config.select("source_id", "operator", "location", "platform")
        .join(decided.select("source_id", "count", "write", "changed", "reason", "priced_at", "checked_at"), "source_id", "left")
        .join(refusals.select("source_id", "code"), "source_id", "left")
        .join(held, "source_id", "left")
        .join(crops, "source_id", "left")
        .withColumn("health", F.when(F.col("code").isNotNull(), "refused").otherwise("live"))
    )
    return Run(out.published, out.withheld, refusals, out.diagnostics, decided, index)


def counts(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("total"), *(F.count_if(F.col("health") == h).alias(h) for h in ("live", "refused", "broken")))


def outcome(index: DataFrame) -> DataFrame:
    """One row: total, live, refused, broken, and `failed`, which a run is only if no source at all came through."""
    return counts(index).withColumn("failed", F.col("live") == 0)


def require_live(index: DataFrame) -> None:
    """Raises if every source was refused; one that was not is enough."""
    if outcome(index).first().failed:
        raise RuntimeError("every source was refused")


def write_snapshots(decided: DataFrame, folder: str) -> dict[str, int]:
    """The written snapshots as JSON, one folder per source. Only the folders of sources written now are replaced: all others, of sources
    skipped, refused or not in this run, keep their last good snapshot. New files are staged beside and moved in when all are complete
    (`sources.folders`).

    Returns how many sources were decided, written and changed, counted as they passed by.
    """
    seen = Observation()
    changed = F.col("changed") if "changed" in decided.columns else F.lit(None)
    rows = decided.observe(seen, F.count(F.lit(1)).alias("decided"), F.count_if("write").alias("written"), F.count_if(F.col("write") & changed).alias("changed"))
    snapshot = F.to_json(F.struct(*(F.col(f"`{c}`") for c in decided.columns if c != "source_id")))
    write_lines(rows.where("write").select(F.col("source_id").cast("string").alias("source_id"), snapshot.alias("value")), folder, "json")
    return seen.get


def write_index(index: DataFrame, folder: str) -> dict[str, int]:
    """The index as JSON. Returns total, live, refused and broken, which are counted on the way into the files: the index is computed once."""
    seen = Observation()
    health = [F.count_if(F.col("health") == h).alias(h) for h in ("live", "refused", "broken")]
    index.observe(seen, F.count(F.lit(1)).alias("total"), *health).drop("write").write.mode("overwrite").json(folder)
    return seen.get
