"""Continuous corpus preparation with published vocabularies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import ArrayType, IntegerType, StructType

from corpusloom.functions import whitespace_tokens
from corpusloom.operators.tokens import (
    DEFAULT_MAX_LENGTH,
    VOCABULARY_SIZE,
    TokenCodec,
    Tokenizer,
    encode,
    tokenize,
)
from corpusloom.sources.sinks import filesystem_of
from corpusloom.streaming.callbacks import BATCH, BatchRecord, BatchTable, record_of, run_callbacks

#: The name of the callback that prepares documents, and of its column.
PREPARED = "prepared"
VERSION = "vocabulary_version"


def prepare(
    documents: DataFrame,
    codec: TokenCodec,
    *,
    keep: Sequence[str],
    tokenizer: Tokenizer = whitespace_tokens,
    max_length: int | None = DEFAULT_MAX_LENGTH,
) -> DataFrame:
    """Blank filter, tokens and ids of new documents; stateless, the same on a batch."""
    return encode(tokenize(documents, tokenizer, max_length=max_length, keep=keep), codec)


def write_prepared_stream(prepared: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all documents that have arrived, each once, and stop."""
    return (
        prepared.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class VocabularyStore:
    """Published vocabularies ``(token, id, freq)`` by version, from 1; a version never changes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._published = BatchRecord(spark, f"{path}/published")

    def latest(self) -> int:
        """The newest published version, -1 before the first one."""
        return self._published.last()

    def publish(self, vocabulary: DataFrame) -> int:
        """Write a vocabulary as the next version; readers see it when it is whole."""
        version = max(self.latest(), 0) + 1
        vocabulary.select("token", "id", "freq").write.mode("overwrite").parquet(f"{self.path}/version={version}")
        self._published.finish(version)
        return version

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("token string, id int, freq bigint").parquet(f"{self.path}/version={version}")


class _Versions:
    """Which version each micro-batch was prepared with, so that a repeated one takes the same."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def of(self, batch_id: int, newest: int) -> int:
        filesystem, folder = filesystem_of(self.spark, f"{self.path}/{batch_id}")
        if filesystem.exists(folder):
            marks = BatchRecord(self.spark, f"{self.path}/{batch_id}")
            if marks.last() > 0:
                return marks.last()
        BatchRecord(self.spark, f"{self.path}/{batch_id}").finish(newest)
        return newest


def prepare_continuously(
    documents: DataFrame,
    store: VocabularyStore,
    folder: str,
    *,
    keep: Sequence[str],
    tokenizer: Tokenizer = whitespace_tokens,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    vocabulary_limit: int = VOCABULARY_SIZE,
) -> StreamingQuery:
    """Prepare all documents that have arrived with the vocabulary that is newest then, and stop.

    A running stream takes up a new version with the next micro-batch. Rows tell the version
    in ``vocabulary_version``. A micro-batch that runs again after a failure takes the
    version it began with and writes nothing twice.
    """
    kept = [documents.schema[name] for name in keep]
    ids = ArrayType(IntegerType())
    schema = StructType(kept).add("input_ids", ids).add("attention_mask", ids).add(VERSION, "long")
    table = BatchTable(f"{folder}/{PREPARED}", schema)
    versions = _Versions(store.spark, f"{folder}/versions")
    codecs: dict[int, TokenCodec] = {}

    def callback(batch: DataFrame, batch_id: int) -> None:
        version = versions.of(batch_id, store.latest())
        if version not in codecs:
            codecs.clear()
            codecs[version] = TokenCodec(store.read(version), vocabulary_limit)
        rows = prepare(batch, codecs[version], keep=keep, tokenizer=tokenizer, max_length=max_length)
        table(rows.withColumn(VERSION, F.lit(version).cast("bigint")), batch_id)

    if store.latest() < 1:
        raise ValueError(f"no vocabulary is published in {store.path}")
    return run_callbacks(documents, {PREPARED: callback}, folder)


def prepared_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that a continuous preparation has finished."""
    path = f"{folder}/{PREPARED}"
    schema = spark.read.parquet(path).drop(BATCH).schema
    return BatchTable(path, schema).read(record_of(spark, folder, PREPARED))
