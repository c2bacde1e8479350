"""Places in one order over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.sources.scratch import written


def numbered(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """`rows` with their number from 0 in a total order.

    Sorted by ranges, numbered in each, and moved by the rows of the ranges before: no task sees more than a range. The ranges are
    written, so that counting and numbering see the same ones. What goes to the driver is one number a range.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Positions within a partition are the low 33 bits of this id, the partition's number is above.
    ranged = written(sorted_.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), 33)
    before, offsets = 0, []
    for p, count in sorted(map(tuple, ranged.groupBy(part.alias("p")).count().collect())):
        offsets.append((p, before))
        before += count
    # As many rows as ranges: broadcast, and met by one look into a hash table.
    known = F.broadcast(rows.sparkSession.createDataFrame(offsets, "_range long, _before long"))
    joined = ranged.join(known, part == F.col("_range"))
    return joined.withColumn(name, (F.col("_before") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).select(*ranged.columns)
