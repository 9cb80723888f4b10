"""Files of other formats than Spark's in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import ensure_checkpoint_dir


_recorded: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder name of this run below ``spark.checkpoint.dir``; it is made by its first writer."""
    base = re.sub(r"^file:/+", "file:///", ensure_checkpoint_dir(spark))
    folder = f"{base}/{name}-{uuid.uuid4().hex}"
    if (made := _recorded.get()) is not None:
        made.append(folder)
    return folder


@contextmanager
def deleted_folders(spark: SparkSession) -> Iterator[None]:
    """What is written to shared folders inside is deleted at the end; results must be written elsewhere by then."""
    made: list[str] = []
    token = _recorded.set(made)
    try:
        yield
    finally:
        _recorded.reset(token)
        for folder in made:
            drop_folder(spark, folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results that no later job reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and go on from the written table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_file(uri: str, chunks: Iterable[bytes]) -> None:
    """Write under a name of this attempt, then rename: a file is whole or absent.

    A task that runs again replaces the file by an equal one.
    """
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(attempt, path)


def open_file(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of about ``size``."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_memory() -> None:
    """Give back to the system what this Python worker has kept from earlier tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after which the Python worker keeps no memory: workers wait for later stages."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return over
