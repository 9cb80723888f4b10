"""Queries whose rows arrive in parts: streams that stop, start again and fail in between.

Every query deals the rows of a given table into parts, lets one part after the other
arrive in a folder and starts its stream anew for each, from the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions import array_digest
from corpusloom.operators import runlog, tokens
from corpusloom.plans.queries import (
    EVAL_EVERY,
    EVENTS,
    LOG_EVERY,
    PATIENCE,
    SAVE_EVERY,
    TRUNCATED,
    VOCABULARY,
    WARMUP,
    Query,
    _lower_tokens,
    texts,
    vocabulary_topk,
)
from corpusloom.session import materialize, work_folder
from corpusloom.streaming import callbacks
from corpusloom.streaming import corpus as corpus_stream
from corpusloom.streaming import runlog as runlog_stream

PARTS = 4
STEPS_PER_EPOCH = 20
PLANNED_STEPS = 100
#: Microseconds between the end of all first sessions and the start of the resumed ones.
PAUSE = 3_600_000_000
LOG = (
    "run_id BIGINT, step BIGINT, epoch DOUBLE, train_loss DOUBLE, learning_rate DOUBLE, "
    "eval_loss DOUBLE, eval_perplexity DOUBLE, timestamp STRING"
)


def timed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, step, loss, timestamp)``: the metric events of all runs."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("loss")
    )
    steps = runlog.numbered_steps(events, "run_id", ["ts", "event_id"])
    return materialize(steps.select("run_id", "step", "loss", F.col("ts").cast("timestamp").alias("timestamp")))


def arrivals(rows: DataFrame, part: Column, folder: str, parts: int = PARTS) -> Iterator[int]:
    """Let the rows of one part after the other arrive in ``folder``."""
    staged = f"{folder}-staged"
    rows.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(staged)
    dealt = rows.sparkSession.read.schema(StructType([*rows.schema.fields]).add("part", "integer")).parquet(staged)
    for i in range(parts):
        dealt.where(F.col("part") == i).select(*rows.columns).write.mode("append").parquet(folder)
        yield i


def _span(log: DataFrame) -> tuple[int, int]:
    """The first time of the log and how long it lasts, in microseconds."""
    at = F.unix_micros("timestamp")
    row = log.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    first, last = row["first"] or 0, row["last"] or 0
    return first, last - first + 1


def metric_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, two sinks; the last micro-batch of every start is run again by the next one."""
    log = timed_log(spark, sf_dir)
    folder = work_folder(spark, "metric-log")
    sinks = {
        "table": callbacks.BatchTable(f"{folder}/table", LOG),
        "csv": callbacks.BatchTable(f"{folder}/csv", LOG, "csv", header="true", nullValue=""),
    }
    first, span = _span(log)
    part = F.floor((F.unix_micros("timestamp") - first) * PARTS / span)
    for _ in arrivals(log, part, f"{folder}/in"):
        callbacks.replay_last_batch(spark, f"{folder}/stream")
        stream = spark.readStream.schema(log.schema).parquet(f"{folder}/in")
        rows = runlog.metric_log(
            stream,
            total_steps=PLANNED_STEPS,
            steps_per_epoch=STEPS_PER_EPOCH,
            logging_steps=LOG_EVERY,
            eval_steps=EVAL_EVERY,
            warmup_steps=WARMUP,
        )
        rows = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        callbacks.run_callbacks(rows, sinks, f"{folder}/stream").awaitTermination()
    found = [
        sink.read(callbacks.record_of(spark, f"{folder}/stream", name)).withColumn("sink", F.lit(name))
        for name, sink in sinks.items()
    ]
    seven_digits = F.format_string("%.6e", "eval_perplexity").cast("double")
    return (
        found[0]
        .unionByName(found[1])
        .withColumn("epoch", F.round("epoch", 6))
        .withColumn("learning_rate", F.round("learning_rate", 10))
        .withColumn("eval_perplexity", F.when(F.col("eval_perplexity").isNotNull(), seven_digits))
    )


def resumed_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run breaks off after two thirds of its steps and is resumed from its last checkpoint."""
    log = timed_log(spark, sf_dir)
    folder = work_folder(spark, "resumed-log")
    _, span = _span(log)
    broken = log.groupBy("run_id").agg((F.max("step") * 2 / 3).cast("bigint").alias("_broken"))
    both = log.join(materialize(broken), "run_id")
    saved = F.floor(F.col("_broken") / SAVE_EVERY) * SAVE_EVERY
    later = F.timestamp_micros(F.unix_micros("timestamp") + span + PAUSE)
    first = both.where(F.col("step") <= F.col("_broken")).select(*log.columns, F.lit(0).alias("session"))
    resumed = both.where(F.col("step") > saved).select(
        "run_id", "step", (F.col("loss") * 1.5).alias("loss"), later.alias("timestamp"), F.lit(1).alias("session")
    )
    rows = first.unionByName(resumed)
    part = 2 * F.col("session") + F.pmod(F.xxhash64("run_id", "step"), F.lit(2))
    sink, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    for _ in arrivals(rows, part, f"{folder}/in"):
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        kept = runlog_stream.without_repeated_steps(stream, "timestamp", f"{2 * (span + PAUSE)} microseconds")
        runlog_stream.write_log_stream(kept, sink, checkpoint).awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink).select("run_id", "step", "loss")


def early_stop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other event arrives one part late; a last event moves the watermark past all others."""
    log = timed_log(spark, sf_dir).withColumnRenamed("loss", "eval_loss")
    folder = work_folder(spark, "early-stop")
    first, span = _span(log)
    slices = PARTS - 1
    width = -(-span // slices)
    late = F.pmod(F.xxhash64("run_id", "step"), F.lit(2))
    place = F.floor((F.unix_micros("timestamp") - first) / width) + late
    closing = spark.range(1).select(
        F.lit(None).cast("bigint").alias("run_id"),
        F.lit(0).cast("bigint").alias("step"),
        F.lit(0.0).alias("eval_loss"),
        F.timestamp_micros(F.lit(first + span + 3 * width)).alias("timestamp"),
        F.lit(slices).cast("bigint").alias("place"),
    )
    rows = materialize(log.withColumn("place", place).unionByName(closing))
    own = runlog_stream.with_state_store(spark)
    sink, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    for _ in arrivals(rows, F.col("place"), f"{folder}/in"):
        stream = own.readStream.schema(rows.schema).parquet(f"{folder}/in")
        stops = runlog_stream.early_stop_stream(
            stream, time="timestamp", delay=f"{2 * width} microseconds", patience=PATIENCE
        )
        runlog_stream.write_log_stream(stops, sink, checkpoint).awaitTermination()
    stops = spark.read.schema("run_id bigint, stop_step bigint").parquet(sink)
    return log.select("run_id").distinct().join(stops, "run_id", "left")


def prepared_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in four parts; a smaller vocabulary is published after the second one."""
    docs = texts(spark, sf_dir).drop("split")
    folder = work_folder(spark, "prepared")
    vocabulary = materialize(vocabulary_topk(spark, sf_dir))
    store = corpus_stream.VocabularyStore(spark, f"{folder}/vocabulary")
    store.publish(vocabulary)
    for i in arrivals(docs, F.pmod(F.col("doc_id"), F.lit(PARTS)), f"{folder}/in"):
        if i == 2:
            store.publish(vocabulary.where(F.col("id") < VOCABULARY // 5))
        stream = spark.readStream.schema(docs.schema).parquet(f"{folder}/in")
        run = corpus_stream.prepare_continuously(
            stream, store, f"{folder}/stream", keep=["doc_id"], tokenizer=_lower_tokens, max_length=TRUNCATED
        )
        run.awaitTermination()
        callbacks.replay_last_batch(spark, f"{folder}/stream")
    found = corpus_stream.prepared_rows(spark, f"{folder}/stream")
    return found.select(
        "doc_id", F.size("input_ids").alias("n_tokens"), array_digest("input_ids").alias("ids_md5"), "vocabulary_version"
    )


QUERIES: dict[str, Query] = {
    "metric_log_stream": metric_log_stream,
    "resumed_log_stream": resumed_log_stream,
    "early_stop_stream": early_stop_stream,
    "prepared_stream": prepared_stream,
}
