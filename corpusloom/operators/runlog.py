"""Run-log analytics over ``(run_id, step, ...)`` for any number of runs at once.

A run may be long: nothing here gathers the rows of one run in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ordering import KeyRanges, Running, key_ranges, with_running
from corpusloom.session import materialize

# Default schedule, cadence and stopping settings.
LEARNING_RATE = 5e-4
WARMUP_STEPS = 1000
LOGGING_STEPS = 100
EVAL_STEPS = 1000
SAVE_STEPS = 2000
SAVE_TOTAL_LIMIT = 3
PATIENCE = 5


def at_interval(log: DataFrame, every: int, step: str = "step") -> DataFrame:
    return log.where(F.col(step) % every == 0)


def loss_perplexity(loss: Column | str) -> Column:
    """exp of a loss that is present and not zero; an overflow becomes NULL."""
    value = F.col(loss) if isinstance(loss, str) else loss
    result = F.exp(value)
    return F.when(value.isNotNull() & (value != 0) & (result < float("inf")), result)


def with_perplexity(log: DataFrame) -> DataFrame:
    return log.withColumn("eval_perplexity", loss_perplexity("eval_loss"))


def numbered_steps(events: DataFrame, run: str, order_by: Sequence[str]) -> DataFrame:
    """Add ``step``: the number of the row within its run, from 1, in event order."""
    order = [run, *order_by]
    steps = with_running(
        events, order, {"step": Running("sum", F.lit(1).cast("bigint"))}, group_by=[run]
    )
    return steps.withColumn("step", F.col("step") + 1)


def learning_rate(
    step: Column,
    total: Column,
    *,
    peak: float = LEARNING_RATE,
    warmup_steps: int = WARMUP_STEPS,
    warmup_ratio: float = 0.0,
) -> Column:
    """Linear warm-up, then a half cosine to 0. The ratio counts only without warm-up steps."""
    warmup = F.lit(warmup_steps) if warmup_steps > 0 else F.ceil(total * warmup_ratio)
    progress = (step - warmup) / F.greatest(F.lit(1), total - warmup)
    falling = F.greatest(F.lit(0.0), 0.5 * (1.0 + F.cos(F.lit(math.pi) * progress)))
    return F.lit(peak) * F.when(step < warmup, step / F.greatest(F.lit(1), warmup)).otherwise(falling)


def metric_log(
    metrics: DataFrame,
    *,
    total_steps: int,
    steps_per_epoch: int,
    logging_steps: int = LOGGING_STEPS,
    eval_steps: int = EVAL_STEPS,
    **schedule: float,
) -> DataFrame:
    """The columns of a run log from ``(run_id, step, loss, timestamp)``, for tables and streams.

    A step at the evaluation interval has its loss as ``eval_loss``, with perplexity; any
    other has it as ``train_loss``, with the learning rate. Steps off the logging interval
    are left out.
    """
    step = F.col("step")
    evaluates = step % eval_steps == 0
    rate = learning_rate(step, F.lit(total_steps), **schedule)
    rows = at_interval(metrics, logging_steps).select(
        "run_id",
        "step",
        (step / steps_per_epoch).alias("epoch"),
        F.when(~evaluates, F.col("loss")).alias("train_loss"),
        F.when(~evaluates, rate).alias("learning_rate"),
        F.when(evaluates, F.col("loss")).alias("eval_loss"),
        "timestamp",
    )
    log = with_perplexity(rows)
    return log.select(*log.columns[:6], "eval_perplexity", "timestamp")


def lr_schedule(log: DataFrame, **settings: float) -> DataFrame:
    """The learning rate of every logged step; a run's last step is its total.

    The totals are written, so that the join reads them from a scan and adaptive execution
    can split the partition of a long run.
    """
    totals = materialize(log.groupBy("run_id").agg(F.max("step").alias("_total")))
    rate = learning_rate(F.col("step"), F.col("_total"), **settings)
    return log.select("run_id", "step").join(totals, "run_id").select("run_id", "step", rate.alias("learning_rate"))


def best_checkpoint(
    log: DataFrame,
    *,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    saved_every: int | None = None,
) -> DataFrame:
    """The best step of each run, the earliest of equals; only saved steps if asked."""
    rows = log.where(F.col(metric).isNotNull())
    if saved_every is not None:
        rows = at_interval(rows, saved_every)
    score = -F.col(metric) if greater_is_better else F.col(metric)
    best = F.min(F.struct(score.alias("score"), "step", metric))
    return rows.groupBy("run_id").agg(best.alias("best")).select("run_id", "best.step", f"best.{metric}")


def last_checkpoint(runs: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The latest saved step of each run, NULL for a run that saved none."""
    latest = checkpoints.groupBy("run_id").agg(F.max("step").alias("step"))
    return runs.select("run_id").distinct().join(latest, "run_id", "left")


def checkpoint_retention(
    checkpoints: DataFrame,
    *,
    keep: int = SAVE_TOTAL_LIMIT,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
) -> DataFrame:
    """The checkpoints of each run that stay on disk: ``(run_id, step, is_best)``.

    The best one and the ``keep - 1`` latest others; the last one always stays. Only
    the ``keep`` latest rows of a run are needed, which Spark selects before the shuffle.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    latest = Window.partitionBy("run_id").orderBy(F.desc("step"))
    recent = checkpoints.select("run_id", "step", F.row_number().over(latest).alias("_rank"))
    recent = recent.where(F.col("_rank") <= keep).select("run_id", "step", F.lit(False).alias("is_best"))
    best = best_checkpoint(checkpoints, metric=metric, greater_is_better=greater_is_better)
    best = best.select("run_id", "step", F.lit(True).alias("is_best"))
    candidates = recent.unionByName(best).groupBy("run_id", "step").agg(F.max("is_best").alias("is_best"))
    others = Window.partitionBy("run_id", "is_best").orderBy(F.desc("step"))
    ranked = candidates.select(
        "*",
        F.row_number().over(others).alias("_rank"),
        F.max("step").over(Window.partitionBy("run_id")).alias("_last"),
    )
    kept = ranked.where(F.col("is_best") | (F.col("_rank") < keep) | (F.col("step") == F.col("_last")))
    return kept.select("run_id", "step", "is_best")


def early_stop(
    log: DataFrame,
    *,
    patience: int = PATIENCE,
    threshold: float = 0.0,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    ranges: KeyRanges | None = None,
) -> DataFrame:
    """The step at which each run stops, NULL if it does not: ``(run_id, stop_step)``.

    An evaluation improves if it is the first or beats the best so far by more than
    ``threshold``. A run stops at the ``patience``-th evaluation in a row without
    improvement; patience 0 never stops. Running values use key ranges, so one long run
    is spread over many tasks.
    """
    runs = log.select("run_id").distinct()
    if patience <= 0:
        return runs.withColumn("stop_step", F.lit(None).cast("bigint"))
    order = ["run_id", "step"]
    score = -F.col(metric) if greater_is_better else F.col(metric)
    rows = log.where(F.col(metric).isNotNull()).select(*order, score.alias("_score"))
    place = (ranges or key_ranges(rows, order)).range_of_key()
    rows = with_running(
        rows,
        order,
        {"_best": Running("min", F.col("_score")), "_index": Running("sum", F.lit(1).cast("bigint"))},
        group_by=["run_id"],
        range_of_row=place,
    )
    gain = F.col("_best") - F.col("_score")
    improved = F.col("_best").isNull() | ((gain > 0) & (gain > threshold))
    improved_at = F.when(improved, F.col("_index")).alias("_improved_at")
    rows = materialize(rows.select(*order, "_index", improved_at))
    rows = with_running(
        rows, order, {"_before": Running("max", F.col("_improved_at"))}, group_by=["run_id"], range_of_row=place
    )
    waited = F.col("_index") - F.coalesce("_improved_at", "_before")
    stops = rows.where(waited >= patience).groupBy("run_id").agg(F.min("step").alias("stop_step"))
    return runs.join(stops, "run_id", "left")


def event_cadence(
    log: DataFrame,
    *,
    logging_steps: int = LOGGING_STEPS,
    eval_steps: int = EVAL_STEPS,
    save_steps: int = SAVE_STEPS,
    log_first_step: bool = True,
) -> DataFrame:
    """Which steps of a run log, evaluate and save."""
    step = F.col("step")
    logs = step % logging_steps == 0
    if log_first_step:
        logs = logs | (step == 1)
    return log.select(
        "run_id",
        "step",
        logs.alias("logs"),
        (step % eval_steps == 0).alias("evaluates"),
        (step % save_steps == 0).alias("saves"),
    )
