"""Local clocks of any time zone, with the abbreviation in force: an as-of join with the zones' changes of offset."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The abbreviations that readers of American English are shown; all other zones by their distance to GMT.
AMERICAN = {"EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT", "AKST", "AKDT", "HST"}
#: Two changes of a zone are further apart than this.
_STRIDE = timedelta(days=7)


def abbreviation(zone: str, at: datetime) -> str:
    """The short name of a zone at a time of UTC."""
    local = at.astimezone(ZoneInfo(zone))
    minutes = int(local.utcoffset().total_seconds() // 60)
    if local.tzname() in AMERICAN and zone.split("/")[0] in ("America", "US", "Pacific"):
        return local.tzname()
    if zone in ("UTC", "Etc/UTC"):
        return "UTC"
    if not minutes:
        return "GMT"
    hours, rest = divmod(abs(minutes), 60)
    return f"GMT{'+' if minutes > 0 else '-'}{hours}" + (f":{rest:02}" if rest else "")


def _changes(zone: str, first: datetime, last: datetime) -> list[tuple[datetime, int, str]]:
    """Times of UTC from which on a zone has an offset in seconds and a name."""
    of = lambda t: (int(t.astimezone(ZoneInfo(zone)).utcoffset().total_seconds()), abbreviation(zone, t))
    out, at = [(first, *of(first))], first
    while at < last:
        step = min(at + _STRIDE, last)
        if of(step) != of(at):
            low, high = at, step
            while high - low > timedelta(seconds=1):
                middle = low + timedelta(seconds=int((high - low).total_seconds()) // 2)
                low, high = (low, middle) if of(middle) != of(at) else (middle, high)
            out.append((high, *of(high)))
        at = step
    return out


def zone_changes(spark: SparkSession, zones: list[str], first: int = 1970, last: int = 2100) -> DataFrame:
    """zone, year and `changes`: what holds at the start of each year of UTC and from when on what holds within it, in order.

    A few rows a zone and year, made on the driver from the zones' rules; years outside are not in it.
    """
    rows = []
    for zone in zones:
        all_ = _changes(zone, datetime(first, 1, 1, tzinfo=timezone.utc), datetime(last + 1, 1, 1, tzinfo=timezone.utc))
        for year in range(first, last + 1):
            start = datetime(year, 1, 1, tzinfo=timezone.utc)
            before = [c for c in all_ if c[0] <= start][-1]
            own = [(start, *before[1:]), *(c for c in all_ if start < c[0] and c[0].year == year)]
            rows.append((zone, year, own))
    return spark.createDataFrame(rows, "zone string, year int, changes array<struct<since:timestamp,offset:int,name:string>>")


def local_clocks(rows: DataFrame, at: str, zone: str, changes: DataFrame) -> DataFrame:
    """`rows` with local_day, local_time and local_zone of the UTC time in column `at` in the zone of column `zone`.

    Rows meet their zone and year by an equi-join with the small side broadcast, and there the last change that is not after them. A
    zone or year that `changes` does not have, and a null, give nulls.
    """
    known = F.broadcast(changes.select(F.col("zone").alias("_zone"), F.col("year").alias("_year"), F.col("changes").alias("_changes")))
    when = F.col(at).cast("timestamp_ltz")
    year = F.year(F.convert_timezone(F.current_timezone(), F.lit("UTC"), when.cast("timestamp_ntz")))
    joined = rows.join(known, (F.col(zone) == F.col("_zone")) & (year == F.col("_year")), "left")
    past = F.filter("_changes", lambda c: c.since <= when)
    found = joined.withColumn("_held", F.element_at(past, -1))
    shown = F.timestamp_micros(F.unix_micros(when) + F.col("_held.offset").cast("long") * 1_000_000)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), shown.cast("timestamp_ntz"))
    return found.withColumns({"local_day": F.date_format(utc, "yyyy-MM-dd"), "local_time": F.date_format(utc, "HH:mm:ss"), "local_zone": F.col("_held.name")}).drop("_zone", "_year", "_changes", "_held")
