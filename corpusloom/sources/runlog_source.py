"""Run logs as a data source of Spark: ``spark.read.format("runlog").load(path)`` and the like.

A log is a folder of CSV parts in which every write is one *commit*. The header is a part of
its own that the first commit writes, so ``cat path/*.csv`` is one CSV file with one header
line. Tasks write parts under hidden names; the commit renames them and then writes its mark,
which readers go by: they see whole commits only, in their order, and a failed write leaves
nothing that is read. A streaming write marks its commits with the id of the micro-batch and
the option ``writer``, so a micro-batch that runs again after a failure adds nothing. Offsets
of a streaming read are numbers of commits; a start with the trigger ``availableNow`` reads
one micro-batch. One writer at a time may append to a log.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from corpusloom.sources.sinks import RUN_LOG_SCHEMA

_COMMIT = re.compile(r"(\d{12})\.([\w-]*)\.done")
_PART = re.compile(r"(\d{12})-\d{6}\.csv")
_HEADER = "000000000000-header.csv"
#: Bytes of CSV that a reader holds at a time.
BLOCK_BYTES = 4 << 20


def _place(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _names(path: str) -> list[str]:
    system, folder = _place(path)
    return sorted(f.base_name for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)))


def commits(path: str) -> dict[int, str]:
    """The number and the label of every commit of a log."""
    found = (_COMMIT.fullmatch(name) for name in _names(path))
    return {int(m[1]): m[2] for m in found if m}


def _arrow_type(kind: str) -> pa.DataType:
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    types["timestamp"] = pa.timestamp("us", "UTC")
    if kind not in types:
        raise ValueError(f"a run log holds no column of type {kind}")
    return types[kind]


def _arrow_schema(schema: StructType) -> pa.Schema:
    return pa.schema([(f.name, _arrow_type(f.dataType.simpleString())) for f in schema.fields])


@dataclass
class LogPart(InputPartition):
    name: str


@dataclass
class WrittenPart(WriterCommitMessage):
    name: str
    rows: int


class _Parts:
    """Reading parts; what the batch and the stream reader share."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def parts(self, after: int, upto: int) -> list[LogPart]:
        numbers = {n for n in commits(self.path) if after < n <= upto}
        found = (_PART.fullmatch(name) for name in _names(self.path))
        return [LogPart(m[0]) for m in found if m and int(m[1]) in numbers]

    def read(self, partition: LogPart | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads where there are no parts
            return
        system, folder = _place(self.path)
        columns = _arrow_schema(self.schema)
        header = csv.read_csv(system.open_input_stream(f"{folder}/{_HEADER}"))
        with system.open_input_stream(f"{folder}/{partition.name}") as stream:
            batches = csv.open_csv(
                stream,
                read_options=csv.ReadOptions(column_names=header.column_names, block_size=BLOCK_BYTES),
                parse_options=csv.ParseOptions(newlines_in_values=True),
                convert_options=csv.ConvertOptions(
                    column_types=columns,
                    include_columns=columns.names,
                    include_missing_columns=True,
                    null_values=[""],
                    strings_can_be_null=True,
                    quoted_strings_can_be_null=False,
                ),
            )
            yield from (pa.RecordBatch.from_arrays(b.columns, schema=columns) for b in batches if b.num_rows)


class RunLogReader(_Parts, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.parts(0, max(commits(self.path), default=0))


class RunLogStreamReader(_Parts, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"commit": 0}

    def latestOffset(self) -> dict:
        return {"commit": max(commits(self.path), default=0)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.parts(start["commit"], end["commit"])

    def commit(self, end: dict) -> None:
        """Commits stay: a log is kept whole."""


class _Appending:
    """Writing parts and committing them; what the batch and the stream writer share."""

    def __init__(self, path: str, schema: StructType, label: str = ""):
        self.path, self.schema, self.label = path, schema, label
        _arrow_schema(schema)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenPart:
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        columns, name, rows = _arrow_schema(self.schema), f".{uuid.uuid4().hex}.attempt", 0
        with system.open_output_stream(f"{folder}/{name}") as stream:
            with csv.CSVWriter(stream, columns, write_options=csv.WriteOptions(include_header=False)) as out:
                for batch in iterator:
                    out.write_batch(batch.cast(columns))
                    rows += batch.num_rows
        return WrittenPart(name, rows)

    def append(self, messages: Sequence[WrittenPart | None], label: str) -> None:
        system, folder = _place(self.path)
        known = commits(self.path)
        if label and label in known.values():
            self.abort(messages)
            return
        number = max(known, default=0) + 1
        system.create_dir(folder, recursive=True)
        header = f"{folder}/{_HEADER}"
        if system.get_file_info(header).type == fs.FileType.NotFound:
            with system.open_output_stream(header) as stream:
                csv.write_csv(_arrow_schema(self.schema).empty_table(), stream)
        # Parts of this number without its mark are left by a driver that failed between the two.
        for name in _names(self.path):
            if name.startswith(f"{number:012}-"):
                system.delete_file(f"{folder}/{name}")
        written = [m for m in messages if m is not None and m.rows]
        for i, message in enumerate(written):
            system.move(f"{folder}/{message.name}", f"{folder}/{number:012}-{i:06}.csv")
        self.abort([m for m in messages if m is not None and not m.rows])
        with system.open_output_stream(f"{folder}/{number:012}.{label}.done"):
            pass

    def abort(self, messages: Sequence[WrittenPart | None]) -> None:
        system, folder = _place(self.path)
        for message in messages:
            if message is not None and system.get_file_info(f"{folder}/{message.name}").type == fs.FileType.File:
                system.delete_file(f"{folder}/{message.name}")


class RunLogWriter(_Appending, DataSourceArrowWriter):
    def commit(self, messages: list[WrittenPart | None]) -> None:
        self.append(messages, self.label)


class RunLogStreamWriter(_Appending, DataSourceStreamArrowWriter):
    def commit(self, messages: list[WrittenPart | None], batchId: int) -> None:
        self.append(messages, f"{self.label}-{batchId}")

    def abort(self, messages: list[WrittenPart | None], batchId: int | None = None) -> None:
        _Appending.abort(self, messages)


class RunLogSource(DataSource):
    """Columns are those of a run log unless the reader or the rows bring others."""

    @classmethod
    def name(cls) -> str:
        return "runlog"

    def schema(self) -> str:
        return RUN_LOG_SCHEMA

    def _path(self) -> str:
        if "path" not in self.options:
            raise ValueError("a run log needs a path")
        return self.options["path"]

    def reader(self, schema: StructType) -> RunLogReader:
        return RunLogReader(self._path(), schema)

    def streamReader(self, schema: StructType) -> RunLogStreamReader:
        return RunLogStreamReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> RunLogWriter:
        if overwrite:
            raise ValueError("a run log is only appended to")
        return RunLogWriter(self._path(), schema, self.options.get("writer", ""))

    def streamWriter(self, schema: StructType, overwrite: bool) -> RunLogStreamWriter:
        return RunLogStreamWriter(self._path(), schema, self.options.get("writer", "stream"))


def register(spark: SparkSession) -> None:
    """Make the format ``runlog`` known to a session."""
    spark.dataSource.register(RunLogSource)
