"""Lines that many documents share, kept only in the last of them (operator 6, native).

Levelled sorted runs. The documents come in batches of falling ids. A batch's lines are
reduced to (hash of the key, documents, largest id) and anti-joined with the runs written so
far: a key that no run holds has its last document in this batch and enters with that id,
one that a run holds enters with its count alone. A run is written in buckets by the hash of the
key, each sorted, so the anti-join and the compaction are merges that move and sort no run again. `FANOUT`
runs of a level are compacted into one of the next level, counts summed, and at the end all into one. Keys
in `min_docs` documents or more lose their lines everywhere but in the last document.

Everything is DataFrame expressions. Line texts never travel: rows of 16 hash bytes, an
id, the hash of the text and the line's place do, pre-aggregated by key; a document's text moves once, to meet the
places of its own lost lines, which are taken out by one pass over the lines. A key in a third of the documents is one
row after the partial aggregation, and its rows in the last join are on the side that adaptive execution splits.

Defined results: a null or empty text is one empty line; a null id is no document, its
row keeps all lines and counts for none; rows that share an id are one document and keep or
lose a line alike; ids of any ordered type will do; an empty table gives an empty result. Keys equal in two 64-bit hashes
of different seeds count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.llm.names import free
from tallyboard.sources.scratch import bucketed, discard, ordered_buckets, written

FANOUT = 2
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["_ld_a", "_ld_b"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """Stripped, A-Z in lower case; `lower` alone would also change other letters."""
    key = F.btrim(line, F.lit(_WHITE))
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def _hashes(line: Column, min_chars: int) -> Column:
    """The two hashes of a line's key, null for a short one."""
    long = F.length(F.btrim(line, F.lit(_WHITE))) >= min_chars
    return F.when(long, F.struct(F.xxhash64(_key(line)).alias(_KEY[0]), F.xxhash64(F.lit(7), _key(line)).alias(_KEY[1])))


def _rank(lines: DataFrame) -> Column:
    """A number that never falls where the id rises: the id, or the first bytes of one that is no number."""
    id_ = F.col("_ld_id")
    if isinstance(lines.schema["_ld_id"].dataType, T.NumericType):
        return id_
    return F.conv(F.rpad(F.hex(F.substring(id_.cast("string").cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("long")


def _batches(lines: DataFrame, n: int) -> list:
    """Ranks that cut the lines into n parts of about the same size; few enough for the driver."""
    found = lines.agg(F.percentile_approx(_rank(lines), [i / n for i in range(1, n)], 1000)).head()[0]
    return sorted(set(found or []))


def _merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two runs as one, by a merge: counts summed, and the last id of the one that has it."""
    there = other.select(*_KEY, F.col("_ld_n").alias("_ld_n2"), F.col("_ld_last").alias("_ld_last2"))
    n = F.coalesce("_ld_n", F.lit(0)) + F.coalesce("_ld_n2", F.lit(0))
    return one.join(there, _KEY, "full_outer").select(*_KEY, n.alias("_ld_n"), F.greatest("_ld_last", "_ld_last2").alias("_ld_last"))


class _Runs:
    """The runs by level; `add` merge-anti-joins a batch's keys with them, adds its own run and compacts full levels."""

    def __init__(self, buckets: int):
        self.buckets, self.runs = buckets, []

    def add(self, own: DataFrame) -> None:
        for k, (_, run) in enumerate(self.runs):
            held = run.where("_ld_last is not null").select(*_KEY, F.lit(True).alias(f"_ld_held{k}"))
            own = own.join(held, _KEY, "left")
        if self.runs:
            new = F.coalesce(*(F.col(f"_ld_held{k}") for k in range(len(self.runs)))).isNull()
            own = own.select(*_KEY, "_ld_n", F.when(new, F.col("_ld_last")).alias("_ld_last"))
        self.runs.append((0, bucketed(own, _KEY, self.buckets)))
        while [k for k, _ in self.runs[-FANOUT:]] == [self.runs[-1][0]] * FANOUT:
            self.compact(FANOUT)

    def compact(self, n: int) -> None:
        """The last n runs as one of the next level."""
        level = max(k for k, _ in self.runs[-n:]) + 1
        while n > 1:
            (_, one), (_, other) = self.runs[-2:]
            self.runs[-2:] = [(level, bucketed(_merged(one, other), _KEY, self.buckets))]
            discard(one)
            discard(other)
            n -= 1


def common_lines(lines: DataFrame, cuts: list, min_docs: int) -> DataFrame:
    """Keys in `min_docs` documents or more, and the largest id of each, written; `lines` has a row per key, document and place."""
    spark = lines.sparkSession
    runs, edges, rank = _Runs(int(spark.conf.get("spark.sql.shuffle.partitions"))), [None, *cuts, None], _rank(lines)
    with ordered_buckets(spark):
        for low, high in reversed(list(zip(edges, edges[1:]))):
            batch = lines
            if low is not None:
                batch = batch.where(rank > low)
            if high is not None:
                batch = batch.where(rank <= high)
            runs.add(batch.select(*_KEY, "_ld_id").distinct().groupBy(*_KEY).agg(F.count("*").alias("_ld_n"), F.max("_ld_id").alias("_ld_last")))
        runs.compact(len(runs.runs))
        # Written, so that its size is known to the join: a small list is broadcast by Spark's own threshold, and
        # a large one meets the lines in a shuffle whose skewed partitions adaptive execution can split.
        out = written(runs.runs[0][1].where(F.col("_ld_n") >= min_docs).select(*_KEY, "_ld_last"))
    discard(runs.runs[0][1])
    return out


def drop_common_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str = "_ld_lines",
    dropped_col: str = "_ld_dropped",
) -> DataFrame:
    """`docs` without the dropped lines, and two more columns: the lines before, and those dropped. Columns of these names are replaced."""
    text, key = F.col(text_col), F.col(id_col)
    hashed = F.transform(lines_of(text), lambda x, k: F.struct(_hashes(x, min_chars).alias("key"), k.alias("_ld_at")))
    each = F.explode(F.filter(hashed, lambda x: x["key"].isNotNull())).alias("line")
    lines = written(
        docs.where(key.isNotNull() & (F.length(text) >= min_chars))
        .select(key.alias("_ld_id"), F.xxhash64(text).alias("_ld_text"), each)
        .select(*(f"line.key.{k}" for k in _KEY), "_ld_id", "_ld_text", "line._ld_at")
    )
    common = common_lines(lines, _batches(lines, batches), min_docs)
    own_id, own_text, lost = (free(docs, x) for x in ("_ld_id", "_ld_text", "_ld_lost"))
    places = lines.join(common, _KEY).where("_ld_id < _ld_last").groupBy(F.col("_ld_id").alias(own_id), F.col("_ld_text").alias(own_text)).agg(F.collect_set("_ld_at").alias(lost))
    joined = docs.join(places, (key == F.col(own_id)) & (F.xxhash64(text) == F.col(own_text)), "left")
    before = (F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(0)) + 1).cast("long")
    # One struct, so that the text is split once for all its lines.
    parts = F.array(F.struct(lines_of(text).alias("lines"), F.array_except(F.sequence(F.lit(0), before.cast("int") - 1), F.col(lost)).alias("kept")))
    kept = F.get(F.transform(parts, lambda s: F.array_join(F.transform(s["kept"], lambda p: F.get(s["lines"], p)), "\n")), F.lit(0))
    counted = joined.withColumns({lines_col: before, dropped_col: F.when(F.col(lost).isNull(), F.lit(0)).otherwise(F.size(lost)).cast("long")})
    return counted.withColumn(text_col, F.when(F.col(lost).isNull(), text).otherwise(kept)).drop(own_id, own_text, lost)
