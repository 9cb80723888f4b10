import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ordering import key_ranges
from corpusloom.operators.runlog import (
    best_checkpoint,
    checkpoint_retention,
    early_stop,
    event_cadence,
    last_checkpoint,
    learning_rate,
    numbered_steps,
    with_perplexity,
)


def stop_step(losses, patience, threshold=0.0):
    """The first step (from 1) after ``patience`` evaluations without improvement."""
    best, waited = None, 0
    for step, loss in enumerate(losses, 1):
        if best is None or (loss < best and best - loss > threshold):
            waited = 0
        else:
            waited += 1
        best = loss if best is None else min(best, loss)
        if waited >= patience:
            return step
    return None


@pytest.fixture(scope="module")
def runs():
    """One run holds a third of all rows."""
    rng = random.Random(5)
    sizes = {"long": 120, **{f"r{i}": rng.randrange(1, 40) for i in range(12)}}
    return {name: [round(rng.random() * 9 * 0.97**i, 3) for i in range(n)] for name, n in sizes.items()}


@pytest.fixture(scope="module")
def log(spark, runs):
    rows = [(name, i, x) for name, losses in runs.items() for i, x in enumerate(losses, 1)]
    random.Random(6).shuffle(rows)
    return spark.createDataFrame(rows, "run_id string, step long, eval_loss double").repartition(4)


def test_perplexity_edges(spark):
    rows = spark.createDataFrame([(0.0,), (None,), (1.0,), (710.0,), (-1.0,)], "eval_loss double")
    got = [r["eval_perplexity"] for r in with_perplexity(rows.coalesce(1)).collect()]
    assert got == [None, None, pytest.approx(math.e), None, pytest.approx(1 / math.e)]


@pytest.mark.parametrize("parts", [1, 4, 32])
@pytest.mark.parametrize("patience, threshold", [(1, 0.0), (5, 0.0), (3, 0.5)])
def test_early_stop_like_a_loop(spark, log, runs, parts, patience, threshold):
    ranges = key_ranges(log, ["run_id", "step"], parts)
    got = early_stop(log, patience=patience, threshold=threshold, ranges=ranges).collect()
    assert {r["run_id"]: r["stop_step"] for r in got} == {
        name: stop_step(losses, patience, threshold) for name, losses in runs.items()
    }


def test_early_stop_variants(log, runs):
    assert {r["stop_step"] for r in early_stop(log, patience=0).collect()} == {None}
    got = early_stop(log, patience=4, greater_is_better=True).collect()
    assert {r["run_id"]: r["stop_step"] for r in got} == {
        name: stop_step([-x for x in losses], 4) for name, losses in runs.items()
    }


def test_best_checkpoint_takes_the_earliest_of_equals(spark):
    rows = [("a", 1, 2.0), ("a", 2, 1.0), ("a", 3, 1.0), ("a", 4, None), ("b", 2, 5.0), ("b", 4, 7.0)]
    log = spark.createDataFrame(rows, "run_id string, step long, eval_loss double")

    def best(**settings):
        return {r["run_id"]: (r["step"], r["eval_loss"]) for r in best_checkpoint(log, **settings).collect()}

    assert best() == {"a": (2, 1.0), "b": (2, 5.0)}
    assert best(greater_is_better=True) == {"a": (1, 2.0), "b": (4, 7.0)}
    assert best(saved_every=3) == {"a": (3, 1.0)}


@pytest.mark.parametrize(
    "losses, keep, expected",
    [
        ([1.0, 5.0, 4.0, 3.0], 3, {1: True, 3: False, 4: False}),
        ([1.0, 5.0, 4.0, 3.0], 1, {1: True, 4: False}),
        ([5.0, 4.0, 3.0, 1.0], 1, {4: True}),
        ([5.0, 4.0, 3.0, 1.0], 2, {3: False, 4: True}),
        ([5.0, 1.0, 3.0, 4.0], 3, {2: True, 3: False, 4: False}),
        ([2.0], 3, {1: True}),
    ],
)
def test_retention_never_drops_the_best(spark, losses, keep, expected):
    rows = [("r", i, x) for i, x in enumerate(losses, 1)]
    df = spark.createDataFrame(rows, "run_id string, step long, eval_loss double")
    assert {r["step"]: r["is_best"] for r in checkpoint_retention(df, keep=keep).collect()} == expected


def test_last_checkpoint_of_a_run_without_one(log, runs):
    saved = log.where(F.col("step") % 10 == 0)
    got = {r["run_id"]: r["step"] for r in last_checkpoint(log, saved).collect()}
    assert got == {name: (len(x) // 10 * 10 or None) for name, x in runs.items()}


@pytest.mark.parametrize("settings", [{"warmup_steps": 5}, {"warmup_steps": 0, "warmup_ratio": 0.25}, {"warmup_steps": 40}])
def test_learning_rate(spark, settings):
    total, peak = 20, 0.1
    warmup = settings["warmup_steps"] or math.ceil(total * settings.get("warmup_ratio", 0))
    rate = learning_rate(F.col("id"), F.lit(total), peak=peak, **settings)
    for r in spark.range(total + 1).select("id", rate.alias("rate")).collect():
        if r["id"] < warmup:
            expected = peak * r["id"] / warmup
        else:
            expected = peak * max(0.0, 0.5 * (1 + math.cos(math.pi * (r["id"] - warmup) / max(1, total - warmup))))
        assert r["rate"] == pytest.approx(expected, abs=1e-15)


def test_steps_are_numbered_per_run(spark, log, runs):
    shifted = log.withColumnRenamed("step", "at").withColumn("at", F.col("at") * 5)
    got = numbered_steps(shifted, "run_id", ["at"]).collect()
    assert len(got) == sum(map(len, runs.values()))
    assert all(r["step"] * 5 == r["at"] for r in got)


def test_cadence(spark):
    log = spark.range(1, 13).select(F.lit("r").alias("run_id"), F.col("id").alias("step"))
    rows = event_cadence(log, logging_steps=3, eval_steps=4, save_steps=6).collect()
    assert [r["step"] for r in rows if r["logs"]] == [1, 3, 6, 9, 12]
    assert [r["step"] for r in rows if r["evaluates"]] == [4, 8, 12]
    assert [r["step"] for r in rows if r["saves"]] == [6, 12]
    rows = event_cadence(log, logging_steps=3, log_first_step=False).collect()
    assert [r["step"] for r in rows if r["logs"]] == [3, 6, 9, 12]
