"""Seeded epoch order and the assignment of rows to batches, ranks and steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import Running, range_count, with_running

# Default batch settings.
BATCH_SIZE = 4
ACCUMULATION = 8
EPOCHS = 5
SEED = 42


def epoch_order(examples: DataFrame, key: str, *, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """A seeded permutation of the rows per epoch: ``(epoch, position, key)``.

    Rows are ordered by a hash of (seed, epoch, key). Its leading digits cut that order
    into ranges of equal size, so no sampling pass is needed; how many follows the rows.
    """
    ranges = range_count(examples)
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    rows = examples.select(F.col(key), epoch.alias("epoch"))
    text = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(key).cast("string"))
    rows = rows.withColumn("_order", F.md5(text))
    leading = F.conv(F.substring("_order", 1, 7), 16, 10).cast("bigint")
    place = F.col("epoch") * ranges + F.floor(leading * ranges / 16**7)
    return with_running(
        rows,
        ["epoch", "_order", key],
        {"position": Running("sum", F.lit(1).cast("bigint"))},
        group_by=["epoch"],
        range_of_row=place.cast("bigint"),
    ).select("epoch", "position", key)


def _per_step(batch_size: int, ranks: int) -> int:
    return batch_size * ranks


def planned_epochs(
    rows: int, *, batch_size: int, ranks: int, accumulation: int, epochs: int, max_steps: int = -1
) -> int:
    """How many epochs a job runs: a positive ``max_steps`` takes the place of ``epochs``."""
    if max_steps <= 0 or not rows:
        return epochs
    steps = -(-(-(-rows // _per_step(batch_size, ranks))) // accumulation)
    return -(-max_steps // steps)


def job_plan(
    examples: DataFrame,
    key: str,
    *,
    batch_size: int = BATCH_SIZE,
    ranks: int = 1,
    accumulation: int = ACCUMULATION,
    epochs: int = EPOCHS,
    max_steps: int = -1,
    seed: int = SEED,
) -> DataFrame:
    """Epoch order and batch plan of a whole job; only epochs that run are shuffled."""
    sizes = {"batch_size": batch_size, "ranks": ranks, "accumulation": accumulation}
    rows = examples.count()
    run = planned_epochs(rows, epochs=epochs, max_steps=max_steps, **sizes)
    ordered = epoch_order(examples, key, epochs=run, seed=seed)
    return batch_plan(ordered, F.lit(rows), max_steps=max_steps, **sizes)


def batch_plan(
    ordered: DataFrame,
    total_rows: Column,
    *,
    batch_size: int = BATCH_SIZE,
    ranks: int = 1,
    accumulation: int = ACCUMULATION,
    max_steps: int = -1,
) -> DataFrame:
    """Add ``micro_batch`` (within the epoch), ``rank`` and ``opt_step`` (over all epochs).

    The last short batch is kept. A positive ``max_steps`` drops the rows after it;
    ``ordered`` must hold :func:`planned_epochs` epochs, as :func:`job_plan` sees to.
    """
    per_step = _per_step(batch_size, ranks)
    position = F.col("position")
    micro = F.floor(position / per_step).cast("bigint")
    steps = F.ceil(F.ceil(total_rows / per_step) / accumulation).cast("bigint")
    plan = ordered.select(
        "*",
        micro.alias("micro_batch"),
        (F.floor(position / batch_size) % ranks).cast("int").alias("rank"),
        (F.col("epoch") * steps + F.floor(micro / accumulation)).cast("bigint").alias("opt_step"),
    )
    return plan.where(F.col("opt_step") < max_steps) if max_steps > 0 else plan


def step_totals(
    examples: DataFrame,
    *,
    batch_size: int = BATCH_SIZE,
    ranks: int = 1,
    accumulation: int = ACCUMULATION,
    epochs: int = EPOCHS,
    max_steps: int = -1,
) -> DataFrame:
    """Effective batch size and the number of micro batches and steps of a job."""
    micro = F.ceil(F.col("n") / _per_step(batch_size, ranks)).cast("bigint")
    steps = F.ceil(F.col("micro_batches") / accumulation).cast("bigint")
    total = F.col("steps_per_epoch") * epochs
    if max_steps > 0:
        total = F.lit(max_steps).cast("bigint")
    return (
        examples.agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit(batch_size * ranks * accumulation).cast("bigint").alias("effective_batch"),
            micro.alias("micro_batches"),
        )
        .withColumn("steps_per_epoch", steps)
        .withColumn("total_steps", total)
    )
