"""The query catalogue over the given tables.

Order key of ``documents`` is ``doc_id``; its split comes from a hash of that key. A run
of ``events`` is a user, its steps are the user's events in time order and the loss is
``value``. Digests and rounding make results comparable across engines.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import array_digest, sentence_count, whitespace_tokens
from corpusloom.operators import (
    batching,
    ngram,
    packing,
    runlog,
    selection,
    statistics,
    tokens,
    windows,
)
from corpusloom.session import materialize
from corpusloom.sources import alias_split, read_named_split, read_text_parquet

# The parameters of the catalogue.
VOCABULARY = 5000
TRUNCATED = 512
PREVIEW_IDS = 100
PACK_ROWS = 100
BLOCK = 512
BATCH = 4
RANKS = 2
ACCUMULATION = 8
PLANNED_EPOCHS = 2
SENTENCE_SAMPLE = 500
PATIENCE = 5
SAVE_EVERY = 10
LOG_EVERY = 5
EVAL_EVERY = 10
STEP_CAP = 40
WARMUP = 10
KEEP = 3
HELD_OUT = ("validation", "test")

Query = Callable[[SparkSession, str], DataFrame]
ORDER = ["doc_id"]
# The columns of the given tables.
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CONVERSATIONS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def split_of_document() -> Column:
    """Eight of ten hash values are train, one validation, one test."""
    leading = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 2)
    h = F.conv(leading, 16, 10).cast("int") % 10
    return F.when(h < 8, "train").when(h == 8, "validation").otherwise("test")


def _lower_tokens(text: Column) -> Column:
    return whitespace_tokens(F.lower(text))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_text_parquet(spark, f"{sf_dir}/documents.parquet", label="documents", schema=DOCUMENTS)
    return df.withColumn("split", split_of_document())


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what text work needs."""
    return documents(spark, sf_dir).select("doc_id", "split", "text")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("eval_loss")
    )
    steps = runlog.numbered_steps(events, "run_id", ["ts", "event_id"])
    return steps.select("run_id", "step", "eval_loss")


def written_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a table, for work that reads it several times."""
    return materialize(run_log(spark, sf_dir))


def _whole_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untruncated tokens of the text as it is."""
    return tokens.tokenize(texts(spark, sf_dir), max_length=None, keep=["doc_id", "split"])


def _lower_whole_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = texts(spark, sf_dir)
    return tokens.tokenize(df, _lower_tokens, max_length=None, keep=["doc_id", "split"])


def _codec(spark: SparkSession, sf_dir: str) -> tokens.TokenCodec:
    return tokens.TokenCodec(vocabulary_topk(spark, sf_dir), VOCABULARY)


def _encoded(
    spark: SparkSession, sf_dir: str, codec: tokens.TokenCodec | None = None, max_length: int | None = None
) -> DataFrame:
    """Ids of whole texts, unless truncating is what a query shows."""
    tokenized = tokens.tokenize(texts(spark, sf_dir), _lower_tokens, max_length=max_length, keep=["doc_id", "split"])
    return tokens.encode(tokenized, codec or _codec(spark, sf_dir))


def _split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(ngram.split_pair_counts(_lower_whole_tokens(spark, sf_dir), ["train", *HELD_OUT]))


def _checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.at_interval(written_run_log(spark, sf_dir), SAVE_EVERY)


# Scans and selection


def scan_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("num_rows"))


def named_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = {"documents": f"{sf_dir}/documents.parquet"}
    df = read_named_split(spark, registry, "documents", "validation", split_by=split_of_document(), schema=DOCUMENTS)
    return df.select("doc_id", "n_chars")


def split_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alias_split(documents(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("num_rows"))


def nonblank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.drop_blank(documents(spark, sf_dir)).select("doc_id", F.md5("text").alias("text_md5"))


#: Runs of what strip() keeps, for Arrow's expressions: all Unicode white space is left out.
VISIBLE = (
    r"[^\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _count_tokens(batch: pa.RecordBatch) -> pa.RecordBatch:
    """User code for a batch map: counts in Arrow, with no Python call per row."""
    n = pc.count_substring_regex(batch["text"], VISIBLE).cast(pa.int64())
    return pa.RecordBatch.from_arrays([batch["doc_id"], n], ["doc_id", "n_tokens"])


def mapped_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.map_batches(
        texts(spark, sf_dir),
        _count_tokens,
        "doc_id bigint, n_tokens bigint",
        columns=["doc_id", "text"],
    )


def head_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = documents(spark, sf_dir).select("doc_id", "text")
    return selection.head(df, 100, ORDER).select("doc_id", F.md5("text").alias("text_md5"))


def head_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.head_per_split(documents(spark, sf_dir).select("split", "doc_id"), 20, ORDER)


def subset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.subset_report(documents(spark, sf_dir), 100)


# Tokens


def vocabulary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.build_vocabulary(_lower_whole_tokens(spark, sf_dir), VOCABULARY)


def tokenize_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, max_length=TRUNCATED).select(
        "doc_id", F.size("input_ids").alias("n_tokens"), array_digest("input_ids").alias("ids_md5")
    )


def decode_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = _codec(spark, sf_dir)
    encoded = _encoded(spark, sf_dir, codec, PREVIEW_IDS)
    return tokens.decode_preview(encoded, codec, PREVIEW_IDS).select("doc_id", "preview")


def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", sentence_count("text").alias("n_sentences"))


def corpus_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = windows.document_lengths(_whole_tokens(spark, sf_dir), ORDER)
    return windows.corpus_positions(lengths, ORDER).select("doc_id", "row_index", "token_start")


def turn_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions under a key of two columns."""
    turns = read_text_parquet(spark, f"{sf_dir}/conversations.parquet", label="conversations", schema=CONVERSATIONS)
    order = ["conv_id", "turn"]
    lengths = windows.document_lengths(tokens.tokenize(turns, max_length=None, keep=order), order)
    return windows.corpus_positions(lengths, order).select(*order, "row_index", "token_start")


def file_order_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in a table of one column, by the order of its files."""
    df = read_text_parquet(spark, f"{sf_dir}/documents.parquet", schema="text STRING", file_order=True)
    n_tokens = F.size(whitespace_tokens("text")).cast("bigint").alias("n_tokens")
    lengths = materialize(
        df.select("file_path", F.col("row_index").alias("file_row"), F.md5("text").alias("text_md5"), n_tokens)
    )
    found = windows.corpus_positions(lengths, ["file_path", "file_row"])
    return found.select("row_index", "text_md5", "token_start")


# Packing, padding, windows


def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _encoded(spark, sf_dir)
    blocks = packing.pack_batches(encoded, ORDER, batch_rows=PACK_ROWS, block_size=BLOCK, split="split")
    return blocks.select("split", "batch", "block", *_block_values())


def pack_split_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = _lower_whole_tokens(spark, sf_dir)
    lengths = lengths.select("split", "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"))
    blocks = packing.pack_splits(_encoded(spark, sf_dir), ORDER, block_size=BLOCK, lengths=lengths)
    return blocks.select("split", "block", *_block_values())


def _block_values() -> list[Column]:
    return [
        F.size("input_ids").alias("n_tokens"),
        array_digest("input_ids").alias("ids_md5"),
        array_digest("labels").alias("labels_md5"),
    ]


def collate_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.collate(_encoded(spark, sf_dir), ORDER, batch_size=BATCH, split="split").select(
        "split",
        "batch_id",
        "doc_id",
        "width",
        "n_pad",
        array_digest("input_ids").alias("ids_md5"),
        array_digest("attention_mask").alias("mask_md5"),
        array_digest("labels").alias("labels_md5"),
    )


def mask_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = packing.mask_tokens(
        _encoded(spark, sf_dir), "doc_id", vocabulary_size=VOCABULARY, mask_id=VOCABULARY
    )

    def chosen(kind: str) -> Column:
        return F.size(F.filter("choices", lambda c: c == kind))

    return masked.select(
        "doc_id",
        (F.size("choices") - chosen("keep")).alias("n_selected"),
        chosen("mask").alias("n_mask"),
        chosen("random").alias("n_random"),
        chosen("same").alias("n_keep"),
        array_digest("input_ids").alias("ids_md5"),
        array_digest("labels").alias("labels_md5"),
    )


def _split_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = windows.document_lengths(_whole_tokens(spark, sf_dir), ["split", *ORDER])
    return windows.corpus_positions(lengths, ORDER, split="split")


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_windows(_split_positions(spark, sf_dir))


def window_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_targets(_split_positions(spark, sf_dir))


# Statistics


def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tokens.tokenize(texts(spark, sf_dir), max_length=None, keep=["split"])
    return statistics.split_metrics(df, ids="tokens").withColumn("avg_seq_length", F.round("avg_seq_length", 6))


def head_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.head_statistics(texts(spark, sf_dir), ORDER).withColumn(
        "avg_length_100", F.round("avg_length_100", 6)
    )


def sentence_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = documents(spark, sf_dir).where(F.col("split") == "train")
    df = statistics.sentence_estimate(train, ORDER, sample_size=SENTENCE_SAMPLE)
    return df.select(
        "sample_size",
        "sentences",
        F.round("avg_per_example", 6).alias("avg_per_example"),
        "total_examples",
        F.round("estimated_total", 6).alias("estimated_total"),
    )


# Epochs and batches


def _train_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).where(F.col("split") == "train").select("doc_id")


def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.epoch_order(_train_keys(spark, sf_dir), "doc_id", epochs=PLANNED_EPOCHS)


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _train_keys(spark, sf_dir)
    total = keys.agg(F.count(F.lit(1)).alias("n")).scalar()
    ordered = batching.epoch_order(keys, "doc_id", epochs=PLANNED_EPOCHS)
    plan = batching.batch_plan(ordered, total, batch_size=BATCH, ranks=RANKS, accumulation=ACCUMULATION)
    return plan.select("epoch", "doc_id", "micro_batch", "rank", "opt_step")


def batch_plan_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap on the steps that asks for more epochs than planned."""
    sizes = {"batch_size": BATCH, "ranks": RANKS, "accumulation": ACCUMULATION}
    keys = _train_keys(spark, sf_dir)
    plan = batching.job_plan(keys, "doc_id", epochs=PLANNED_EPOCHS, max_steps=STEP_CAP, **sizes)
    return plan.select("epoch", "doc_id", "micro_batch", "rank", "opt_step")


def step_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.step_totals(
        _train_keys(spark, sf_dir),
        batch_size=BATCH,
        ranks=RANKS,
        accumulation=ACCUMULATION,
        epochs=PLANNED_EPOCHS,
    )


# Bigram model


def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _lower_whole_tokens(spark, sf_dir).where(F.col("split") == "train")
    return ngram.pair_counts(ngram.token_pairs(train))


def _held_out_scores(counts: DataFrame) -> DataFrame:
    return ngram.perplexity(ngram.split_losses(counts, HELD_OUT), "split")


def bigram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.when(F.col("split") == "validation", "eval").otherwise(F.col("split"))
    return _held_out_scores(_split_counts(spark, sf_dir)).select(
        F.concat(short, F.lit("_perplexity")).alias("metric"),
        "n_pairs",
        F.round("perplexity", 4).alias("perplexity"),
    )


def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ngram.named_metrics(_held_out_scores(_split_counts(spark, sf_dir)), {"validation": "eval"})
    return metrics.select("metric", F.round("value", 4).alias("value"))


def baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _split_counts(spark, sf_dir)
    baseline = ngram.perplexity(ngram.split_unigram_losses(counts, HELD_OUT), "split")
    compared = ngram.compare_with_baseline(_held_out_scores(counts), baseline, ["split"])
    return compared.select("split", *[F.round(name, 4).alias(name) for name in compared.columns[1:]])


def window_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ngram.window_perplexity(_lower_whole_tokens(spark, sf_dir), HELD_OUT, ORDER)
    return scores.select("split", "n_tokens", F.round("perplexity", 4).alias("perplexity"))


def next_token_candidates_sharp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temperature at which plain powers of counts overflow."""
    found = ngram.next_token_candidates(bigram_counts(spark, sf_dir), temperature=0.05)
    return found.select(
        "token", "next_token", "rank", F.round("p", 6).alias("p"), F.round("cum_p", 6).alias("cum_p")
    )


def next_token_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.next_token_candidates(bigram_counts(spark, sf_dir)).select(
        "token", "next_token", "rank", F.round("p", 6).alias("p"), F.round("cum_p", 6).alias("cum_p")
    )


# Run logs


def runlog_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.at_interval(run_log(spark, sf_dir), LOG_EVERY)


def runlog_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexities span hundreds of orders of magnitude, so seven digits are compared."""
    log = runlog.with_perplexity(run_log(spark, sf_dir))
    seven_digits = F.format_string("%.6e", "eval_perplexity").cast("double")
    return log.withColumn("eval_perplexity", F.when(F.col("eval_perplexity").isNotNull(), seven_digits))


def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = runlog.lr_schedule(written_run_log(spark, sf_dir), warmup_steps=WARMUP)
    return rates.withColumn("learning_rate", F.round("learning_rate", 10))


def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.best_checkpoint(run_log(spark, sf_dir))


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.early_stop(written_run_log(spark, sf_dir), patience=PATIENCE)


def checkpoint_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.checkpoint_retention(_checkpoints(spark, sf_dir), keep=KEEP)


def last_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("run_id"))
    return runlog.last_checkpoint(runs, _checkpoints(spark, sf_dir))


def event_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.event_cadence(
        run_log(spark, sf_dir), logging_steps=LOG_EVERY, eval_steps=EVAL_EVERY, save_steps=2 * SAVE_EVERY
    )


QUERIES: dict[str, Query] = {
    "scan_split_counts": scan_split_counts,
    "named_split_scan": named_split_scan,
    "split_alias": split_alias,
    "nonblank_documents": nonblank_documents,
    "mapped_token_counts": mapped_token_counts,
    "head_subset": head_subset,
    "head_per_split": head_per_split,
    "subset_report": subset_report,
    "runlog_interval": runlog_interval,
    "vocabulary_topk": vocabulary_topk,
    "tokenize_truncate": tokenize_truncate,
    "decode_preview": decode_preview,
    "sentence_count": sentence_counts,
    "corpus_positions": corpus_positions,
    "turn_positions": turn_positions,
    "pack_blocks": pack_blocks,
    "pack_split_blocks": pack_split_blocks,
    "collate_padded": collate_padded,
    "mask_tokens": mask_tokens,
    "file_order_positions": file_order_positions,
    "batch_plan_capped": batch_plan_capped,
    "next_token_candidates_sharp": next_token_candidates_sharp,
    "sliding_windows": sliding_windows,
    "window_targets": window_targets,
    "split_metrics": split_metrics,
    "head_statistics": head_statistics,
    "sentence_estimate": sentence_estimate,
    "window_perplexity": window_perplexity,
    "epoch_shuffle": epoch_shuffle,
    "batch_plan": batch_plan,
    "step_totals": step_totals,
    "bigram_counts": bigram_counts,
    "bigram_perplexity": bigram_perplexity,
    "baseline_comparison": baseline_comparison,
    "next_token_candidates": next_token_candidates,
    "runlog_perplexity": runlog_perplexity,
    "final_metrics": final_metrics,
    "lr_schedule": lr_schedule,
    "best_checkpoint": best_checkpoint,
    "early_stop": early_stop,
    "checkpoint_retention": checkpoint_retention,
    "last_checkpoint": last_checkpoint,
    "event_cadence": event_cadence,
}
