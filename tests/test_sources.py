import json
from datetime import datetime
from pathlib import Path

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.selection import (
    drop_blank,
    head,
    head_per_split,
    map_batches,
    subset_report,
)
from corpusloom.sources import (
    RUN_LOG_SCHEMA,
    append_run_log,
    read_named_split,
    read_run_log,
    read_splits,
    read_text_parquet,
    reuse_or_write,
    write_metric_json,
    write_subset,
)


@pytest.fixture
def corpus(spark, tmp_path):
    def write(name, n):
        path = str(tmp_path / name)
        spark.range(n).select("id", F.concat(F.lit(name), "id").alias("text")).write.parquet(path)
        return path

    return {"train": write("train", 5), "validation": write("validation", 3)}


def test_a_missing_input_is_named(spark, corpus, tmp_path):
    with pytest.raises(FileNotFoundError, match="validation parquet not found: .*nowhere"):
        read_splits(spark, corpus["train"], str(tmp_path / "nowhere"))


def test_a_missing_text_column_is_an_error(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no column 'text'"):
        read_text_parquet(spark, str(tmp_path / "t"))


def test_test_split_holds_the_validation_rows(spark, corpus):
    counts = {r["split"]: r["count"] for r in read_splits(spark, **corpus).groupBy("split").count().collect()}
    assert counts == {"train": 5, "validation": 3, "test": 3}
    with_test = read_splits(spark, **corpus, test=corpus["train"])
    counts = {r["split"]: r["count"] for r in with_test.groupBy("split").count().collect()}
    assert counts == {"train": 5, "validation": 3, "test": 5}


def test_a_named_split_reads_only_its_folder(spark, corpus, tmp_path):
    root = str(tmp_path / "named")
    read_splits(spark, **corpus).write.partitionBy("split").parquet(root)
    df = read_named_split(spark, {"mine": root}, "mine", "validation")
    assert df.count() == 3
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in scan
    with pytest.raises(KeyError, match="registered: mine"):
        read_named_split(spark, {"mine": root}, "other", "test")


def test_subset_round_trip(spark, corpus, tmp_path):
    df = read_text_parquet(spark, corpus["train"])
    path = str(tmp_path / "small")
    written = write_subset(head(df, 2, ["id"]), path)
    assert written.rows == 2
    assert written.bytes >= sum(f.stat().st_size for f in Path(path).glob("*.parquet")) > 0
    assert [r["id"] for r in spark.read.parquet(path).orderBy("id").collect()] == [0, 1]
    assert subset_report(df, 2).first() == (5, 2)
    assert subset_report(df, 20).first() == (5, 5)
    assert head(df, 20, ["id"]).count() == 5


def test_head_per_split_of_short_splits(spark, corpus):
    got = head_per_split(read_splits(spark, **corpus), 4, ["id"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 4, "validation": 3, "test": 3}


def test_map_batches_may_drop_rows(spark, corpus):
    df = read_text_parquet(spark, corpus["train"])
    kept = map_batches(df, lambda b: b.select(["id"]).filter(pc.equal(pc.bit_wise_and(b["id"], 1), 0)), "id long", columns=["id"])
    assert sorted(r["id"] for r in kept.collect()) == [0, 2, 4]


def test_run_log_round_trip_keeps_earlier_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    at = datetime(2024, 5, 6, 7, 8, 9)
    first = [("a", 1, 0.5, 2.0, 1e-4, None, None, at)]
    second = [("a", 2, 1.0, None, None, 1.5, 4.5, at)]
    for rows in (first, second):
        append_run_log(spark.createDataFrame(rows, RUN_LOG_SCHEMA), path)
    assert [tuple(r) for r in read_run_log(spark, path).orderBy("step").collect()] == first + second
    files = [f.read_text().splitlines() for f in Path(path).glob("*.csv")]
    assert {f[0] for f in files if f} == {
        "run_id,step,epoch,train_loss,learning_rate,eval_loss,eval_perplexity,timestamp"
    }
    lines = sorted(line for f in files for line in f[1:])
    assert lines == ["a,1,0.5,2.0,1.0E-4,,,2024-05-06 07:08:09", "a,2,1.0,,,1.5,4.5,2024-05-06 07:08:09"]


def test_metric_files(spark, tmp_path):
    rows = [("train_loss", 2.0), ("eval_loss", 1.5), ("eval_perplexity", 4.5), ("test_loss", 1.25)]
    metrics = spark.createDataFrame(rows, "metric string, value double")
    for prefix, expected in [("eval", dict(rows[1:3])), ("train", dict(rows[:1])), (None, dict(rows))]:
        path = tmp_path / str(prefix)
        write_metric_json(metrics, str(path), prefix)
        assert json.loads("".join(f.read_text() for f in path.glob("part-*"))) == expected


def test_reuse_of_finished_output_only(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert reuse_or_write(spark.range(3), path).count() == 3
    first = (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns
    assert reuse_or_write(spark.range(3), path).count() == 3
    assert (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns == first
    assert reuse_or_write(spark.range(9), path).count() == 9
    assert reuse_or_write(spark.range(9).toDF("renamed"), path).columns == ["renamed"]
    assert reuse_or_write(spark.range(9), path, parameters={"version": 2}).count() == 9
    second = (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns
    assert reuse_or_write(spark.range(9), path, overwrite=True).count() == 9
    assert (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns != second
    (tmp_path / "cache" / "_SUCCESS").unlink()
    assert reuse_or_write(spark.range(4), path).count() == 4


def test_source_columns_are_dropped_and_the_scan_is_pruned(spark, corpus):
    plan = drop_blank(read_text_parquet(spark, corpus["train"])).select("text")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in text
    assert "IsNotNull(text)" in text


def test_a_file_without_text_is_an_error_with_a_schema_too(spark, tmp_path):
    spark.range(5).select("id", F.col("id").cast("string").alias("other")).write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no column 'text'"):
        read_text_parquet(spark, f"{tmp_path}/t", schema="id long, text string")
    spark.range(5).select("id", F.col("id").cast("string").alias("text")).write.parquet(f"{tmp_path}/u")
    with pytest.raises(ValueError, match="lacks id int"):
        read_text_parquet(spark, f"{tmp_path}/u", schema="id int, text string")


def test_file_order_over_several_files(spark, tmp_path):
    rows = spark.range(100).select(F.format_string("%03d", "id").alias("text"))
    rows.repartitionByRange(5, "text").sortWithinPartitions("text").write.parquet(f"{tmp_path}/t")
    df = read_text_parquet(spark, f"{tmp_path}/t", file_order=True)
    assert [r["text"] for r in df.orderBy("file_path", "row_index").collect()] == [f"{i:03d}" for i in range(100)]
    assert read_text_parquet(spark, f"{tmp_path}/t", partitions=7).rdd.getNumPartitions() == 7
