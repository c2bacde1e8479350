"""Lines in one folder a source (`source_id=<id>`, as `partitionBy` names it): written by tasks and read again as the data source `source_lines`.

On a local or mounted file system Spark's own writer starts a process for every folder and file that it makes, and moves folders one after
the other on the driver; tens of thousands of sources take it many minutes. Here tasks make the files and tasks move them in.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyboard.sources.scratch import _delete, discard, written

#: What `partitionBy` escapes in a folder's name, and its name for no value.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def name_of(source_id: str | None) -> str:
    return f"source_id={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', source_id) if source_id else NO_VALUE}"


def files_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def by_source(files: fs.FileSystem, path: str) -> dict[str | None, str]:
    """The folder of every source below a path."""
    found = [i for i in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if i.type == fs.FileType.Directory and i.base_name.startswith("source_id=")]
    names = [unquote(i.base_name.removeprefix("source_id=")) for i in found]
    return {None if n == NO_VALUE else n: i.path for n, i in zip(names, found)}


def lines_of(files: fs.FileSystem, folder: str) -> Iterator[bytes]:
    """Lines of the data files of a folder, one at a time."""
    for info in sorted(files.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
        if info.is_file and not info.base_name.startswith(("_", ".")):
            with files.open_input_stream(info.path) as stream:
                rest = b""
                while block := stream.read(1 << 20):
                    *lines, rest = (rest + block).split(b"\n")
                    yield from lines
                if rest:
                    yield rest


def _local(spark: SparkSession, folder: str) -> str | None:
    """The folder's path where it is on a local file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(place).toUri().getPath() if system.getScheme() == "file" else None


def _staged(folder: str):
    """Writes the lines of sorted sources into files of the staging folder, one a source, and tells which is whose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names, paths = f"{folder}/{uuid.uuid4().hex}", [], []
        out = None
        for batch in batches:
            for name, lines in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: r[0]):
                if not names or names[-1] != name_of(name):
                    os.makedirs(own, exist_ok=True)
                    if out:
                        out.close()
                    names.append(name_of(name))
                    paths.append(f"{own}/{len(paths)}")
                    out = open(paths[-1], "wb")
                out.writelines(line.encode() + b"\n" for _, line in lines if line is not None)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(paths)], ["name", "path"])

    return run


def _moved(folder: str, file: str):
    """Moves staged files into their sources' folders. The new file replaces the last one in one step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = f"{folder}/{name}"
                os.makedirs(own, exist_ok=True)
                # A staged file that is gone was moved by an earlier attempt of this task.
                if os.path.exists(path):
                    os.replace(path, f"{own}/{file}")
                for other in os.listdir(own):
                    if other != file:
                        os.remove(f"{own}/{other}")
            yield batch.slice(0, 0)

    return run


def write_lines(lines: DataFrame, folder: str, suffix: str = "txt") -> None:
    """`lines` (source_id string, value string) into the folders of their sources. What was in these is replaced; other sources' folders stay as they are.

    New files are staged beside and moved in when all are complete.
    """
    spark = lines.sparkSession
    own = _local(spark, folder)
    if own is None:
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").text(folder)
        return
    staging = f"{own}/_staged-{uuid.uuid4().hex}"
    os.makedirs(own, exist_ok=True)
    try:
        staged = written(lines.select("source_id", "value").repartition("source_id").sortWithinPartitions("source_id").mapInArrow(_staged(staging), "name string, path string"))
        moving = staged.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_moved(own, f"part-0.{suffix}"), staged.schema)
        moving.write.format("noop").mode("overwrite").save()
        discard(staged)
    finally:
        _delete(spark, staging)


class _Share(InputPartition):
    def __init__(self, folders: list[tuple[str | None, str]]):
        super().__init__(None)
        self.folders = folders


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("partitions", 64))

    def partitions(self) -> list[_Share]:
        folders = sorted(by_source(*files_of(self.path)).items(), key=lambda f: f[1])
        n = max(1, min(self.most, len(folders)))
        return [_Share(folders[k::n]) for k in range(n)]

    def read(self, partition: _Share) -> Iterator[tuple]:
        files, _ = files_of(self.path)
        for source_id, folder in partition.folders:
            for line in lines_of(files, folder):
                yield source_id, line.decode("utf-8", "replace")


class SourceLines(DataSource):
    """`spark.read.format("source_lines").load(folder)`: every line with its source."""

    @classmethod
    def name(cls) -> str:
        return "source_lines"

    def schema(self) -> str:
        return "source_id string, value string"

    def reader(self, schema) -> _Reader:
        if "path" not in self.options:
            raise ValueError("source_lines needs the option path")
        return _Reader(dict(self.options))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(SourceLines)
    return spark.read.format("source_lines").load(folder)
