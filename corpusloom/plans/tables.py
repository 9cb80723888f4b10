"""Queries over tables that are written first: logs, corpora, subsets, and losses of a scorer."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import whitespace_tokens
from corpusloom.operators import ngram, runlog, scoring, selection, tokens
from corpusloom.plans.queries import (
    EVAL_EVERY,
    HELD_OUT,
    LOG_EVERY,
    ORDER,
    WARMUP,
    Query,
    _lower_tokens,
    documents,
    texts,
    vocabulary_topk,
)
from corpusloom.plans.streams import PLANNED_STEPS, STEPS_PER_EPOCH, timed_log
from corpusloom.session import materialize, work_folder
from corpusloom.sources import read_named_split, runlog_source, write_corpus, write_subset
from corpusloom.sources.incremental import IncrementalTable

SUBSET = 100
#: Ids of the small vocabulary of the scorer: its model is a matrix of their pairs.
SCORED_IDS = 1000


def run_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in two appends, copied to another one by a stream that starts twice, read from there."""
    runlog_source.register(spark)
    log = runlog.metric_log(
        timed_log(spark, sf_dir),
        total_steps=PLANNED_STEPS,
        steps_per_epoch=STEPS_PER_EPOCH,
        logging_steps=LOG_EVERY,
        eval_steps=EVAL_EVERY,
        warmup_steps=WARMUP,
    )
    log = log.withColumn("run_id", F.col("run_id").cast("string"))
    folder = work_folder(spark, "run-log")
    source = spark.readStream.format("runlog").load(f"{folder}/log")
    copy = source.writeStream.format("runlog").option("path", f"{folder}/copy")
    copy = copy.option("checkpointLocation", f"{folder}/copying/checkpoint").trigger(availableNow=True)
    for part in ("step % 2 = 0", "step % 2 = 1"):
        log.where(part).write.format("runlog").mode("append").save(f"{folder}/log")
        copy.start().awaitTermination()
    found = spark.read.format("runlog").load(f"{folder}/copy")
    seven_digits = F.format_string("%.6e", "eval_perplexity").cast("double")
    return (
        found.withColumn("run_id", F.col("run_id").cast("bigint"))
        .withColumn("epoch", F.round("epoch", 6))
        .withColumn("learning_rate", F.round("learning_rate", 10))
        .withColumn("eval_perplexity", F.when(F.col("eval_perplexity").isNotNull(), seven_digits))
        .withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    )


def written_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is written of the first rows, as observed while writing."""
    subset = selection.head(documents(spark, sf_dir).select("doc_id", "text"), SUBSET, ORDER)
    measures = {"text_bytes": F.sum(F.octet_length("text")), "last_id": F.max("doc_id")}
    report = write_subset(subset, f"{work_folder(spark, 'subset')}/rows", measures)
    return spark.range(1).select(
        F.lit(report.rows).cast("bigint").alias("subset_rows"),
        F.lit(report.measures["text_bytes"]).cast("bigint").alias("text_bytes"),
        F.lit(report.measures["last_id"]).cast("bigint").alias("last_id"),
        F.lit(report.bytes > 0).alias("on_disk"),
    )


def named_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus of three splits, one of them replaced later; two are read by name."""
    folder = work_folder(spark, "corpus")
    docs = texts(spark, sf_dir)
    write_corpus(docs, folder)
    marked = docs.where("split = 'validation'").withColumn("text", F.concat("text", F.lit(" (second edition)")))
    write_corpus(marked, folder)
    read = [read_named_split(spark, {"docs": folder}, "docs", split) for split in HELD_OUT]
    return read[0].unionByName(read[1]).select("split", "doc_id", F.md5("text").alias("text_md5"))


def incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of documents in three parts: two at first, then one more, and one of the first anew."""
    folder = work_folder(spark, "incremental")
    docs = materialize(documents(spark, sf_dir).select("doc_id", "text"))
    parts = [docs.where(F.pmod(F.col("doc_id"), F.lit(3)) == i) for i in range(3)]

    def count(rows: DataFrame) -> DataFrame:
        rows = selection.drop_blank(rows)
        return rows.select("_file", "doc_id", F.size(whitespace_tokens("text")).cast("bigint").alias("n_tokens"))

    table = IncrementalTable(spark, f"{folder}/in", f"{folder}/out", count)
    for i in (0, 1):
        parts[i].withColumn("text", F.concat("text", F.lit(" draft") if i else F.lit(""))).write.parquet(f"{folder}/in/{i}")
    table.update()
    parts[2].write.parquet(f"{folder}/in/2")
    parts[1].write.mode("overwrite").parquet(f"{folder}/in/1")
    table.update()
    return table.read()


def scored_window_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window perplexity of a scorer that only knows ids: pairs of a small vocabulary, smoothed by one."""
    codec = tokens.TokenCodec(vocabulary_topk(spark, sf_dir).where(F.col("id") < SCORED_IDS), SCORED_IDS)
    lower = tokens.tokenize(texts(spark, sf_dir), _lower_tokens, max_length=None, keep=["doc_id", "split"])
    encoded = materialize(tokens.encode(lower, codec).drop("attention_mask"))
    train = encoded.where("split = 'train'")
    shifted = F.arrays_zip(
        F.slice("input_ids", F.lit(1), F.size("input_ids") - 1).alias("a"),
        F.slice("input_ids", F.lit(2), F.size("input_ids") - 1).alias("b"),
    )
    pairs = train.select(F.inline(shifted)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.ones((SCORED_IDS, SCORED_IDS))
    counts[pairs["a"].to_numpy(), pairs["b"].to_numpy()] += pairs["n"].to_numpy()
    shared = spark.sparkContext.broadcast(-np.log(counts / counts.sum(axis=1, keepdims=True)))

    def score(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        losses = np.full(len(ids), np.nan)
        losses[1:] = shared.value[ids[:-1], ids[1:]]
        if len(before):
            losses[0] = shared.value[before[-1], ids[0]]
        return losses

    losses = scoring.scored_losses(encoded.where(F.col("split").isin(*HELD_OUT)), score, ORDER, context=1)
    found = ngram.window_perplexity_of_losses(losses)
    return found.select("split", "n_tokens", F.round("perplexity", 4).alias("perplexity"))


QUERIES: dict[str, Query] = {
    "run_log_source": run_log_source,
    "written_subset": written_subset,
    "named_corpus": named_corpus,
    "incremental_counts": incremental_counts,
    "scored_window_perplexity": scored_window_perplexity,
}
