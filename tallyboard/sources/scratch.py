"""The shared folder for written intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Scratch tables are written and read a few times: they take less room at little more time.
CODEC = "zstd"


def root(spark: SparkSession) -> str:
    """What the session names in `spark.checkpoint.dir`. Only on one machine, as in tests, a temporary folder stands in where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyboard-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{root(spark)}/tallyboard-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    return f"{folder(spark)}/{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _release(spark: SparkSession) -> None:
    """Lets the driver find out that the job just done is over: shuffle files stay on the executors until it collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder, read again: what comes after neither repeats its work nor carries its plan."""
    path = new_path(df.sparkSession)
    df.write.option("compression", CODEC).parquet(path)
    _release(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def bucketed(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """`df` as a table in the shared folder in n buckets by the hash of its keys, each sorted by them and read as such.

    `df` should come in partitions by that hash, so that a bucket is one file: Spark knows the order of such buckets only
    (and while `ordered_buckets` holds).
    """
    spark, path = df.sparkSession, new_path(df.sparkSession)
    name = f"tallyboard_{uuid.uuid4().hex}"
    df.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).option("compression", CODEC).saveAsTable(name, format="parquet")
    _release(spark)
    out = spark.table(name)
    out._scratch_path, out._scratch_name = path, name
    return out


@contextmanager
def ordered_buckets(spark: SparkSession):
    """Plans made within read sorted buckets of one file each as sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Deletes a table of `written` or `bucketed` that no plan still to run reads."""
    if name := getattr(df, "_scratch_name", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    _delete(df.sparkSession, df._scratch_path)


def clear(spark: SparkSession) -> None:
    """Deletes all tables that this application has written, once their readers are done."""
    _delete(spark, folder(spark))
