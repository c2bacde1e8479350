"""A small table of which one writer at a time makes the next version, and a writer that comes late decides anew.

A version is a folder of rows and a marker file named by its number, which names the folder. The rows are complete before the marker is made; the
marker is written under another name and gets its own in one step, which fails where there is one, so of two writers
that read one version only the first commits, and a writer that stops anywhere leaves nothing that a reader takes for a version.
A marker that names no complete rows, as other writers may leave, is skipped, and its number is not used again.
The step is a hard link on a local file system and a rename without overwriting elsewhere, as HDFS has it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """Another writer committed after this one had read."""


class _Folder:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.jvm = spark, folder, spark.sparkContext._jvm
        self.place = self.path(f"{folder}/_commits")
        self.files = self.place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        """Numbers of all markers, the last first."""
        if not self.files.exists(self.place):
            return []
        names = (f.getPath().getName() for f in self.files.listStatus(self.place))
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def rows(self, number: int) -> str | None:
        """The complete folder of rows that a marker names."""
        at = self.path(f"{self.folder}/_commits/{number}")
        if not 0 < self.files.getFileStatus(at).getLen() < 1024:
            return None
        stream = self.files.open(at)
        try:
            name = bytes(stream.readAllBytes()).decode(errors="replace")
        finally:
            stream.close()
        return name if self.files.exists(self.path(f"{self.folder}/{name}/_SUCCESS")) else None

    def publish(self, number: int, name: str) -> bool:
        """Makes the marker with its content, or tells that there is one."""
        self.files.mkdirs(self.place)
        staged, final = self.path(f"{self.folder}/_commits/.{name}"), self.path(f"{self.folder}/_commits/{number}")
        out = self.files.create(staged, False)
        out.write(bytearray(name.encode()))
        out.close()
        try:
            if self.files.getScheme() == "file":
                local = self.jvm.java.nio.file.Paths
                at = lambda p: local.get(self.files.makeQualified(p).toUri())
                self.jvm.java.nio.file.Files.createLink(at(final), at(staged))
                self.files.delete(staged, False)
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                options = self.spark.sparkContext._gateway.new_array(getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
                context.rename(staged, final, options)
        except Py4JJavaError as e:
            self.files.delete(staged, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True


def version(spark: SparkSession, folder: str) -> int:
    """The number of the last version that is complete; 0 before the first."""
    at = _Folder(spark, folder)
    return next((n for n in at.numbers() if at.rows(n)), 0)


def read(spark: SparkSession, folder: str, number: int) -> DataFrame | None:
    """The rows of a committed version; none of version 0."""
    return spark.read.parquet(f"{folder}/{_Folder(spark, folder).rows(number)}") if number else None


def commit(rows: DataFrame, folder: str, expected: int) -> int:
    """Writes `rows` as the next version and gives its number. Raises `Conflict`, and leaves the table as it is, where `expected` is not the last."""
    spark, name = rows.sparkSession, f"rows-{uuid.uuid4().hex}"
    at = _Folder(spark, folder)
    if version(spark, folder) != expected:
        raise Conflict(f"{folder}: version {expected} is no longer the last")
    number = max(at.numbers(), default=0) + 1
    rows.write.parquet(f"{folder}/{name}")
    made = False
    try:
        made = at.publish(number, name)
    finally:
        if not made:
            at.files.delete(at.path(f"{folder}/{name}"), True)
    if not made:
        raise Conflict(f"{folder}: version {number} is there")
    return number


def update(spark: SparkSession, folder: str, decide: Callable[[DataFrame | None], DataFrame | None], tries: int = 2) -> tuple[int, bool]:
    """Reads, decides and commits; after a conflict all three again, `tries` times in all. `decide` gives none where nothing is to be written.

    Returns the version that holds afterwards and whether it was done more than once; the last conflict is raised.
    """
    for n in range(tries):
        last = version(spark, folder)
        rows = decide(read(spark, folder, last))
        if rows is None:
            return last, n > 0
        try:
            return commit(rows, folder, last), n > 0
        except Conflict:
            if n == tries - 1:
                raise
    raise ValueError("at least one try")
