import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ordering import (
    Running,
    aligned_ranges,
    key_ranges,
    with_row_index,
    with_running,
)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows belongs to one group; keys have gaps and come in random order."""
    rng = random.Random(7)
    made = [(f"g{0 if i % 3 == 0 else rng.randrange(9)}", i * 7, rng.randrange(100)) for i in range(600)]
    made = [(g, k, None if v % 11 == 0 else v) for g, k, v in made]
    rng.shuffle(made)
    return made


def _expected(rows):
    out, state = {}, {}
    for g, k, v in sorted(rows):
        seen = state.setdefault(g, [])
        known = [x for x in seen if x is not None]
        out[(g, k)] = (
            len(seen),
            sum(known),
            min(known, default=None),
            max(known, default=None),
            known[-1] if known else None,
        )
        seen.append(v)
    return out


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_running_values_do_not_depend_on_partitions(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(parts)
    ranges = key_ranges(df, ["g", "k"], parts)
    assert ranges.total == len(rows)
    running = {
        "n": Running("sum", F.lit(1).cast("bigint")),
        "total": Running("sum", F.col("v")),
        "low": Running("min", F.col("v")),
        "high": Running("max", F.col("v")),
        "latest": Running("last", F.col("v")),
    }
    done = with_running(df, ["g", "k"], running, group_by=["g"], range_of_row=ranges.range_of_key())
    got = {(r["g"], r["k"]): (r["n"], r["total"], r["low"], r["high"], r["latest"]) for r in done.collect()}
    assert got == _expected(rows)


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_row_index(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(parts)
    got = with_row_index(df, ["k"], ranges=key_ranges(df, ["k"], parts)).collect()
    assert {r["k"]: r["row_index"] for r in got} == {k: i for i, k in enumerate(sorted(r[1] for r in rows))}


def test_ranges_are_balanced_although_one_group_dominates(spark, rows):
    df = spark.createDataFrame(rows, "g string, k long, v long")
    assert max(key_ranges(df, ["g", "k"], 8).rows) < 2 * len(rows) / 8


@pytest.mark.parametrize("unit", [1, 7, 100, 1000])
def test_aligned_ranges_hold_whole_units(spark, rows, unit):
    df = spark.createDataFrame(rows, "g string, k long, v long")
    ranges = aligned_ranges(df, ["k"], unit, parts=5)
    assert sum(ranges.rows) == len(rows)
    assert all(n % unit == 0 for n in ranges.rows[:-1])
    assert len(ranges.rows) <= 5
    placed = with_row_index(df, ["k"], ranges=ranges, keep_range=True)
    units = placed.groupBy(F.floor(F.col("row_index") / unit)).agg(F.count_distinct("_range").alias("n"))
    assert units.where("n > 1").count() == 0


def test_null_and_timestamp_keys(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (NULL, 1), (TIMESTAMP_NTZ'2024-03-31 02:30:00', 2), "
        "(TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', 3), (NULL, 0) AS t(ts, id)"
    )
    got = with_row_index(df, ["ts", "id"], ranges=key_ranges(df, ["ts", "id"], 4)).collect()
    assert {r["id"]: r["row_index"] for r in got} == {0: 0, 1: 1, 3: 2, 2: 3}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert with_row_index(df, ["k"]).count() == 0
    assert aligned_ranges(df, ["k"], 10).total == 0
    assert with_running(df, ["k"], {"s": Running("sum", F.col("v"))}).count() == 0
