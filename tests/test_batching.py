import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.batching import batch_plan, epoch_order, job_plan, step_totals


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_every_epoch_is_a_seeded_permutation(spark, parts):
    keys = spark.range(100).repartition(parts)

    def order(seed):
        rows = epoch_order(keys, "id", epochs=3, seed=seed).orderBy("epoch", "position").collect()
        assert [r["position"] for r in rows] == list(range(100)) * 3
        return [tuple(r["id"] for r in rows if r["epoch"] == e) for e in range(3)]

    orders = order(42)
    assert orders == order(42)
    assert all(sorted(o) == list(range(100)) for o in orders)
    assert len({*orders, *order(43)}) == 6


def test_plan_covers_each_row_once_per_epoch(spark):
    n, b, g, a = 101, 4, 2, 3
    ordered = epoch_order(spark.range(n), "id", epochs=2)
    plan = batch_plan(ordered, F.lit(n), batch_size=b, ranks=g, accumulation=a)
    rows = plan.collect()
    steps = math.ceil(math.ceil(n / (b * g)) / a)
    for r in rows:
        p = r["position"]
        assert (r["micro_batch"], r["rank"]) == (p // (b * g), p // b % g)
        assert r["opt_step"] == r["epoch"] * steps + p // (b * g) // a
    assert sorted((r["epoch"], r["id"]) for r in rows) == [(e, i) for e in range(2) for i in range(n)]
    assert {r["opt_step"] for r in rows} == set(range(2 * steps))
    capped = batch_plan(ordered, F.lit(n), batch_size=b, ranks=g, accumulation=a, max_steps=3)
    assert {r["opt_step"] for r in capped.collect()} == {0, 1, 2}


def test_published_step_total(spark):
    totals = step_totals(spark.range(7461630), batch_size=32, ranks=2, accumulation=2, epochs=3).first()
    assert tuple(totals) == (128, 116588, 58294, 174882)
    assert step_totals(spark.range(100), max_steps=7).first()["total_steps"] == 7


def test_a_cap_beyond_the_epochs_runs_more_of_them(spark):
    keys = spark.range(64)
    sizes = {"batch_size": 4, "ranks": 2, "accumulation": 8}
    plan = job_plan(keys, "id", epochs=1, max_steps=20, **sizes)
    assert plan.select("opt_step").distinct().count() == 20
    assert step_totals(keys, epochs=1, max_steps=20, **sizes).first()["total_steps"] == 20
    assert job_plan(keys, "id", epochs=5, max_steps=2, **sizes).agg({"epoch": "max"}).first()[0] == 1
