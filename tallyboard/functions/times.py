"""Clocks, freshness and schedules."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values, in hours.
LATE_H, WITHDRAW_H, SKEW_H, HEARTBEAT_H, STALE_H = 6.0, 14.0, 0.25, 6.0, 336.0


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(3.6e9)


def age_hours(at: Column, now: Column) -> Column:
    """Infinite where there is no readable time."""
    return F.coalesce(hours_between(now, at), F.lit(float("inf")))


def state_of(health: Column, checked_at: Column, now: Column) -> Column:
    age = age_hours(checked_at, now)
    failed = health.isin("broken", "refused")
    return (
        F.when(failed, F.when(age >= WITHDRAW_H, "down").otherwise("late"))
        .when((age < -SKEW_H) | (age >= WITHDRAW_H), "down")
        .when(age >= LATE_H, "late")
        .otherwise("live")
    )


def cron_values(field: Column, low: int, high: int) -> Column:
    """All values of one schedule field: `*`, values, ranges and steps, comma-separated."""

    def part_values(part: Column) -> Column:
        span, step = F.get(F.split(part, "/"), F.lit(0)), F.coalesce(F.get(F.split(part, "/"), F.lit(1)).try_cast("int"), F.lit(1))
        start = F.when(span == "*", F.lit(low)).otherwise(F.get(F.split(span, "-"), F.lit(0)).try_cast("int"))
        stop = F.when(span == "*", F.lit(high)).when(span.contains("-"), F.get(F.split(span, "-"), F.lit(1)).try_cast("int")).otherwise(start)
        readable = start.isNotNull() & stop.isNotNull() & (step >= 1) & (start <= stop)
        return F.when(readable, F.sequence(start, stop, F.greatest(step, F.lit(1)))).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(field, ","), part_values))))


def cron_matches(cron: Column, at: Column) -> Column:
    """Whether a five-field schedule fires in the minute of a UTC time; day fields join by OR where both are set."""
    f = F.split(F.trim(cron), r"\s+")
    part = lambda k: F.get(f, F.lit(k))
    has = lambda k, value, low, high: F.array_contains(cron_values(part(k), low, high), value)
    weekday = (F.dayofweek(at) - 1).cast("int")
    dom = has(2, F.dayofmonth(at), 1, 31)
    dow = has(4, weekday, 0, 7) | ((weekday == 0) & has(4, F.lit(7), 0, 7))
    both = (part(2) != "*") & (part(4) != "*")
    day = F.when(both, dom | dow).when(part(2) != "*", dom).when(part(4) != "*", dow).otherwise(F.lit(True))
    return (F.size(f) == 5) & has(0, F.minute(at), 0, 59) & has(1, F.hour(at), 0, 23) & has(3, F.month(at), 1, 12) & day


def _parsed(cron: Column) -> Column:
    """The values of a schedule's fields, and whether each day field is set; null for a text of another shape."""
    f = F.split(F.trim(cron), r"\s+")
    part = lambda k: F.get(f, F.lit(k))
    fields = F.struct(
        cron_values(part(0), 0, 59).alias("minutes"),
        cron_values(part(1), 0, 23).alias("hours"),
        cron_values(part(2), 1, 31).alias("dom"),
        cron_values(part(3), 1, 12).alias("months"),
        cron_values(part(4), 0, 7).alias("dow"),
        (part(2) != "*").alias("by_dom"),
        (part(4) != "*").alias("by_dow"),
    )
    return F.when(F.size(f) == 5, fields)


def schedules(spark: SparkSession, crons: list[str]) -> list[Column]:
    """Schedules of a program's own, read once by a query of one row and given as literals; what is none is left out."""
    read = spark.range(1).select(*(_parsed(F.lit(c)).alias(f"c{k}") for k, c in enumerate(crons))).first() if crons else ()
    value = lambda x: F.array(*(F.lit(v) for v in x)).cast("array<int>") if isinstance(x, list) else F.lit(x)
    return [F.struct(*(value(x).alias(name) for name, x in r.asDict().items())) for r in read if r is not None]


def next_fire(crons: Column | list[Column], after: Column, days: int = 8) -> Column:
    """The first minute after a time at which one of an array of schedules fires, within some days.

    A column of schedules is parsed once per row; a list comes from `schedules`, already read. On the day of the time the rest of the hour and the later hours are
    looked at; on a later day that fires, its first hour and minute are the answer.
    """
    first = F.date_trunc("minute", after) + F.expr("interval 1 minute")
    today, limit = F.date_trunc("day", first), F.date_trunc("minute", after) + F.expr(f"interval {days} days")

    def of(p: Column) -> Column:
        def fires(day: Column) -> Column:
            weekday = (F.dayofweek(day) - 1).cast("int")
            dom = F.array_contains(p["dom"], F.dayofmonth(day))
            dow = F.array_contains(p["dow"], weekday) | ((weekday == 0) & F.array_contains(p["dow"], 7))
            on = F.when(p["by_dom"] & p["by_dow"], dom | dow).when(p["by_dom"], dom).when(p["by_dow"], dow).otherwise(F.lit(True))
            return on & F.array_contains(p["months"], F.month(day))

        at = lambda day, h, m: day + F.make_dt_interval(F.lit(0), h, m)
        this_hour = F.when(F.array_contains(p["hours"], F.hour(first)), F.array_min(F.filter(p["minutes"], lambda m: m >= F.minute(first))))
        next_hour = F.array_min(F.filter(p["hours"], lambda h: h > F.hour(first)))
        rest = F.coalesce(at(today, F.hour(first), this_hour), at(today, next_hour, F.array_min(p["minutes"])))
        later = F.get(F.filter(F.sequence(today + F.expr("interval 1 day"), today + F.expr(f"interval {days} days"), F.expr("interval 1 day")), fires), F.lit(0))
        found = F.coalesce(F.when(fires(today), rest), at(later, F.array_min(p["hours"]), F.array_min(p["minutes"])))
        return F.when(found <= limit, found)

    if isinstance(crons, list):
        return F.array_min(F.array(*(of(p) for p in crons)))
    return F.array_min(F.transform(F.transform(crons, _parsed), of))


def ago_words(minutes: Column) -> Column:
    m = F.greatest(F.lit(0), F.floor(minutes + 0.5)).cast("long")
    return (
        F.when(minutes.isNull(), "at an unknown time")
        .when(m < 1, "just now")
        .when(m == 1, "1 minute ago")
        .when(m < 90, F.concat(m.cast("string"), F.lit(" minutes ago")))
        .otherwise(F.concat(F.floor(m / 60).cast("string"), F.lit("h "), F.lpad((m % 60).cast("string"), 2, "0"), F.lit("m ago")))
    )


def due_words(minutes: Column) -> Column:
    m = F.floor(minutes + 0.5).cast("long")
    late = F.abs(m)
    return (
        F.when(minutes.isNull(), "next run: no schedule found")
        .when(m > 1, F.concat(F.lit("next run due in "), m.cast("string"), F.lit(" minutes")))
        .when(m == 1, "next run due in a minute")
        .when(m == 0, "next run due now")
        .when(late == 1, "next run was due 1 minute ago")
        .when(late < 90, F.concat(F.lit("next run was due "), late.cast("string"), F.lit(" minutes ago")))
        .otherwise(F.concat(F.lit("next run was due "), F.floor(late / 60).cast("string"), F.lit("h "), F.lpad((late % 60).cast("string"), 2, "0"), F.lit("m ago")))
    )


def local_parts(at: Column, zone: str = "America/Chicago") -> Column:
    """struct(day, time, abbreviation) of a UTC time in a zone; the abbreviation from its distance to UTC."""
    there = F.from_utc_timestamp(at, zone)
    offset = F.round(hours_between(there, at)).cast("int")
    names = F.when(offset == -5, "CDT").when(offset == -6, "CST")
    return F.struct(F.date_format(there, "yyyy-MM-dd").alias("day"), F.date_format(there, "HH:mm:ss").alias("time"), names.alias("zone"))


def clock(at: Column, reference_day: Column, zone: str = "America/Chicago") -> Column:
    """The local time on the reference day; month, day and minute on another; `never` without a time."""
    p = local_parts(at, zone)
    other = F.concat(F.substring(p["day"], 6, 5), F.lit(" "), F.substring(p["time"], 1, 5))
    return F.when(at.isNull(), "never").when(p["day"] == reference_day, p["time"]).otherwise(other)
