"""Names for columns that an operator adds to a caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, name: str) -> str:
    """`name`, or the first of `name_`, `name__` ... that is no column of `df`, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
