"""What a status page and a sweep's report count and in which order they show it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyboard.operators.ranking import numbered

#: States, the worst first.
STATES = ["down", "late", "live"]


def state_rank(state: Column) -> Column:
    return F.coalesce(*(F.when(state == s, F.lit(n)) for n, s in enumerate(STATES, 1)), F.lit(len(STATES)))


def state_counts(states: DataFrame) -> DataFrame:
    """One row: how many sources, how many in each state, and the worst state that occurs; no source at all is down."""
    found = states.agg(F.count("*").alias("total"), *(F.count_if(F.col("state") == s).alias(s) for s in reversed(STATES)))
    return found.withColumn("verdict", F.when((F.col("down") > 0) | (F.col("total") == 0), "down").when(F.col("late") > 0, "late").otherwise("live"))


def ordered(states: DataFrame, then: list[str], collation: str = "UNICODE") -> DataFrame:
    """`states` with `place` from 1: what is wrong first, then by the columns named, texts as readers order them.

    Texts (null is empty) are compared by a collation: accents and case tell apart only what is otherwise equal. Its sort keys are what the ranges are cut
    by, so the order is whole over any number of partitions. Texts that no collation tells apart go by code points.
    """
    texts = [c for c in then if isinstance(states.schema[c].dataType, StringType)]
    keys = [F.collate(F.coalesce(c, F.lit("")), collation) if c in texts else F.col(c) for c in then]
    return numbered(states, [state_rank(F.col("state")), *keys, *texts], "place").withColumn("place", F.col("place") + 1)


def gaps(rows: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """`rows` with `minutes`, whole ones to the next of the same key; null for the last."""
    w = Window.partitionBy(key).orderBy(at, tie)
    return rows.withColumn("minutes", F.floor((F.unix_micros(F.lead(at).over(w)) - F.unix_micros(at)) / 60_000_000))


def tally(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values with their number `n` and `place` by it.

    Places follow from how many values have each number. Of these numbers there are few, at most the root of twice the rows, however many values there
    are: only they stand in one window, and the values meet them by a join.
    """
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    before = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    numbers = counted.groupBy("n").agg(F.count("*").alias("_values")).select("n", (F.coalesce(F.sum("_values").over(before), F.lit(0)) + 1).cast("long").alias("place"))
    return counted.join(numbers, "n").select(column, "n", "place")


def sweep_summary(offers: DataFrame, token: str, destination: str) -> DataFrame:
    """By token its offers and the distinct destinations, in order, that they name."""
    found = offers.groupBy(token).agg(F.count("*").alias("offers"), F.array_sort(F.collect_set(destination)).alias("names"))
    return found.select(token, "offers", F.size("names").cast("long").alias("destinations"), "names")


def leads(results: DataFrame) -> DataFrame:
    """Answers worth a look that are no hits: any but 401, which a key that does not exist gets too."""
    return results.where(~F.col("status").eqNullSafe(401) & ~F.col("verdict").eqNullSafe("HIT"))


def with_controls(tokens: DataFrame, controls: list[str]) -> DataFrame:
    """Distinct tokens and controls; `added` marks controls that were not among the tokens. Null tokens go."""
    known = tokens.sparkSession.createDataFrame([(c,) for c in controls], "token string")
    both = tokens.where("token is not null").select("token", F.lit(False).alias("added")).unionAll(known.withColumn("added", F.lit(True)))
    return both.groupBy("token").agg(F.bool_and("added").alias("added"))
