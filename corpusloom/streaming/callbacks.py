"""Event callbacks: user code that sees every micro-batch of a stream once.

Several callbacks share one stream, and each micro-batch is computed once for all of them.
What a callback has finished is recorded by the id of the micro-batch. After a failure
Spark runs the last micro-batch again under the same id: callbacks that finished it are
left out, the others get it again, and a :class:`BatchTable` replaces what an unfinished
attempt has left. Readers see finished micro-batches only, so every row counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom.sources.sinks import filesystem_of

Callback = Callable[[DataFrame, int], None]
BATCH = "batch_id"


class BatchRecord:
    """Which micro-batches are finished: one empty file for each, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> int:
        """The id of the last finished micro-batch, -1 before the first one."""
        filesystem, folder = filesystem_of(self.spark, self.path)
        if not filesystem.exists(folder):
            return -1
        names = [status.getPath().getName() for status in filesystem.listStatus(folder)]
        return max((int(name) for name in names if name.isdigit()), default=-1)

    def finish(self, batch_id: int) -> None:
        filesystem, mark = filesystem_of(self.spark, f"{self.path}/{batch_id}")
        filesystem.create(mark, True).close()


class BatchTable:
    """A callback that adds each micro-batch to a table, in a folder of its own."""

    def __init__(self, path: str, schema: StructType | str, source: str = "parquet", **options: str):
        self.path, self.source, self.options = path, source, options
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self.schema.names)
        rows.write.format(self.source).options(**self.options).mode("overwrite").save(f"{self.path}/{BATCH}={batch_id}")

    def read(self, record: BatchRecord) -> DataFrame:
        """The rows of finished micro-batches; unfinished folders are not opened."""
        last = record.last()
        if last < 0:
            return record.spark.createDataFrame([], self.schema)
        rows = record.spark.read.format(self.source).options(**self.options)
        rows = rows.schema(StructType([*self.schema.fields]).add(BATCH, "long")).load(self.path)
        return rows.where(F.col(BATCH) <= last).drop(BATCH)


def record_of(spark: SparkSession, folder: str, name: str) -> BatchRecord:
    """The record of one callback of a stream whose state is in ``folder``."""
    return BatchRecord(spark, f"{folder}/finished/{name}")


def run_callbacks(stream: DataFrame, callbacks: Mapping[str, Callback], folder: str) -> StreamingQuery:
    """Hand every micro-batch of what has arrived to all callbacks, and stop.

    Names of callbacks are kept from start to start: a new one sees the micro-batches from
    then on. ``folder`` keeps the checkpoint of the stream and the records.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        records = {name: record_of(batch.sparkSession, folder, name) for name in callbacks}
        due = [name for name, record in records.items() if record.last() < batch_id]
        shared = batch.persist() if len(due) > 1 else batch
        try:
            for name in due:
                callbacks[name](shared, batch_id)
                records[name].finish(batch_id)
        finally:
            if len(due) > 1:
                shared.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(availableNow=True).start()


def replay_last_batch(spark: SparkSession, folder: str) -> int:
    """Make the next start run the last micro-batch again, as after a crash; returns its id."""
    done = BatchRecord(spark, f"{folder}/checkpoint/commits")
    last = done.last()
    if last >= 0:
        filesystem, mark = filesystem_of(spark, f"{done.path}/{last}")
        filesystem.delete(mark, False)
    return last
