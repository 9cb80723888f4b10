"""Preprocessing that takes up where it stopped: only new or changed input files are processed.

Each update lists the input files and compares path, length and time with the manifest of
the update before. Rows of the output carry the file they come from and the update that
made them; the manifest says which update holds the rows of each file, so a changed or
removed file takes its old rows along. An update counts once its manifest is whole; one
that failed leaves rows that no manifest names.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.sinks import filesystem_of

_FILE, _UPDATE = "_file", "_update"
_MANIFEST = f"{_FILE} string, length bigint, modified timestamp, {_UPDATE} bigint"


class Updated(NamedTuple):
    number: int
    files: int
    processed: int
    removed: int


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, length, modified)`` of the Parquet files below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select(
        F.col("path").alias(_FILE), "length", F.col("modificationTime").alias("modified")
    )


class IncrementalTable:
    """The output of ``process`` over all files below ``source``.

    ``process`` turns rows of the source into rows of the output, each from one row alone
    or from rows of one file; it must keep the column ``_file``. What it does is not part
    of the manifest: change ``path`` with it.
    """

    def __init__(self, spark: SparkSession, source: str, path: str, process: Callable[[DataFrame], DataFrame]):
        self.spark, self.source, self.path, self.process = spark, source, path, process

    def _last(self) -> int:
        filesystem, folder = filesystem_of(self.spark, f"{self.path}/manifest")
        if not filesystem.exists(folder):
            return 0
        done = [status.getPath() for status in filesystem.listStatus(folder)]
        success = [p for p in done if filesystem.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return max((int(p.getName().partition("=")[2]) for p in success), default=0)

    def manifest(self, number: int | None = None) -> DataFrame:
        number = self._last() if number is None else number
        if not number:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/update={number}")

    def update(self) -> Updated:
        """Process what is new. The names of new files come to the driver, as for any read."""
        last = self._last()
        number, known = last + 1, self.manifest(last)
        files = input_files(self.spark, self.source)
        same = ["_file", "length", "modified"]
        new = [row[_FILE] for row in files.join(known, same, "left_anti").select(_FILE).collect()]
        removed = known.join(files, _FILE, "left_anti").count()
        if new:
            rows = self.spark.read.parquet(*new).withColumn(_FILE, F.col("_metadata.file_path"))
            self.process(rows).write.mode("overwrite").parquet(f"{self.path}/rows/{_UPDATE}={number}")
        if new or removed or not last:
            kept = files.join(known, same, "left").withColumn(_UPDATE, F.coalesce(_UPDATE, F.lit(number)).cast("bigint"))
            kept.select(*same, _UPDATE).write.mode("overwrite").parquet(f"{self.path}/manifest/update={number}")
        else:
            number = last
        return Updated(number, self.manifest(number).count(), len(new), removed)

    def read(self) -> DataFrame:
        """The rows of the files as they were at the last update."""
        rows = self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        current = self.manifest().select(_FILE, _UPDATE)
        return rows.join(current, [_FILE, _UPDATE], "left_semi").drop(_FILE, _UPDATE)
