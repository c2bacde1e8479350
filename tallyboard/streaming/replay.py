"""Tables replayed through a stream, part by part, as batches that came one after the other."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyboard.sources.scratch import new_path
from tallyboard.streaming.silence import STORE


@contextmanager
def timer_store(spark: SparkSession):
    """Streams started within keep their state in the store that timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def replay(spark: SparkSession, parts: list[dict[str, DataFrame]], transform: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """What `transform` of the named streams has written after all parts.

    A part is appended to its streams' folders, then the query runs on from its checkpoint until all that is there is read, with one more batch
    for what the watermark has let go. Each part so is the data of one batch, of any number of files.
    """
    root = new_path(spark)
    found = None
    for part in parts:
        for name, rows in part.items():
            rows.write.mode("append").parquet(f"{root}/in/{name}")
        streams = {name: spark.readStream.schema(rows.schema).parquet(f"{root}/in/{name}") for name, rows in part.items()}
        found = transform(streams)
        with timer_store(spark):
            run = found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
            run.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{root}/out")
