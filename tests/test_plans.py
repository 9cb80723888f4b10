"""Properties of the plans that matter for large or skewed data."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ordering
from corpusloom.operators.ngram import bigram_losses, pair_counts, train_bigrams
from corpusloom.operators.ordering import Running, key_ranges, with_running
from corpusloom.operators.runlog import lr_schedule
from corpusloom.operators.selection import head, head_per_split
from corpusloom.operators.tokens import build_vocabulary, tokenize
from corpusloom.operators.windows import corpus_positions, document_lengths
from corpusloom.plans.queries import run_log, texts

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_context_is_split_in_the_window_join(spark, settings):
    """One token is the context of a third of all rows."""
    model = train_bigrams(spark.createDataFrame([(["hot", "x", "hot", "y"],)], "tokens array<string>"))
    settings(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    rows = spark.range(200000).repartition(16).select(
        F.lit("test").alias("split"),
        F.xxhash64("id").alias("window"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("token"),
        F.when(F.col("id") >= 0, "x").alias("next_token"),
    )
    losses = bigram_losses(pair_counts(rows, ["split", "window"]), model, ["split", "window"])
    done = losses.agg(F.sum("n_pairs"), F.sum("nll"))
    assert done.first()[0] == 200000
    done.collect()
    assert _plan(done).count("SortMergeJoin(skew=true)") == 2


def test_a_long_run_is_split_in_the_schedule_join(spark, settings):
    settings(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
    )
    run = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50000)
    log = spark.range(200000).repartition(16).select(run.alias("run_id"), F.col("id").alias("step"))
    rates = lr_schedule(log, warmup_steps=5)
    assert rates.count() == 200000
    done = rates.groupBy("step").agg(F.sum("learning_rate"))
    done.collect()
    assert "SortMergeJoin(skew=true)" in _plan(done)


def test_the_first_rows_of_a_split_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select("id", F.lit("train").alias("split"))
    assert _plan(head_per_split(df, 5, ["id"])).count("WindowGroupLimit") >= 2


def test_head_is_a_filter_on_the_scan(spark, tmp_path):
    spark.range(1000).select("id", F.lit("x").alias("text")).write.parquet(str(tmp_path / "t"))
    plan = _plan(head(spark.read.parquet(str(tmp_path / "t")), 10, ["id"]))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(id,9\)", plan)
    assert "Exchange" not in plan


def test_tokenizing_happens_once_per_scan(spark):
    tokenized = tokenize(texts(spark, SF_DIR), max_length=None)
    plan = build_vocabulary(tokenized, 50)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "regexp_extract_all" in line]
    assert all(line.count("regexp_extract_all") == 1 for line in scans)
    assert not any("Filter" in line for line in scans)


def test_positions_use_one_task_for_range_totals_only(spark):
    lengths = document_lengths(tokenize(texts(spark, SF_DIR), keep=["doc_id"]), ["doc_id"])
    df = corpus_positions(lengths, ["doc_id"])
    df.collect()
    plan = _plan(df).split("Initial Plan")[0]
    single = plan.index("Exchange SinglePartition")
    assert "HashAggregate(keys=[_range" in plan[single : single + 400]
    assert plan.count("Exchange SinglePartition") == 1


def test_a_long_run_is_spread_over_ranges(spark):
    log = run_log(spark, SF_DIR).withColumn("run_id", F.lit(1)).withColumn("step", F.monotonically_increasing_id())
    assert max(key_ranges(log, ["run_id", "step"], 8).rows) < 2 * log.count() / 8


def test_one_plan_at_all_sizes(spark, settings):
    """No plan asks how large its input is: text is read by the splits of the scan."""

    def shape():
        plan = _plan(tokenize(texts(spark, SF_DIR), max_length=None, keep=["doc_id"]))
        return re.sub(r"#\d+|\(\d+\)", "", plan)

    large = shape()
    assert "Exchange" not in large
    settings(files__maxPartitionBytes="1KB")
    assert shape() == large


def test_groups_must_lead_the_order(spark):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("user"))
    with pytest.raises(ValueError, match="must begin with the groups"):
        with_running(df, ["id"], {"n": Running("sum", F.lit(1))}, group_by=["user"])


def test_ranges_follow_the_data(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 100)
    df = spark.range(5000).select("id", F.when(F.col("id") < 10, 50_000).otherwise(1).alias("n"))
    assert len(key_ranges(df, ["id"]).rows) >= 40
    assert len(key_ranges(df, ["id"], weight=F.col("n")).rows) >= 50
