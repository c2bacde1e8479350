"""Ids of any type as whole numbers in the same order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tallyboard.operators.ranking import numbered


def with_places(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """`df` with a long column `name` that orders and parts rows as `id_col` does; null stays null.

    Whole numbers stand for themselves. Other ids get their place among all distinct ids, which are sorted by ranges and joined back.
    """
    if isinstance(df.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return df.withColumn(name, F.col(id_col).cast("long"))
    ids = df.select(F.col(id_col).alias("_place_of")).where(F.col(id_col).isNotNull()).distinct()
    places = numbered(ids, ["_place_of"], name)
    return df.join(places, F.col(id_col) == F.col("_place_of"), "left").drop("_place_of")
