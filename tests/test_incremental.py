from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.selection import head
from corpusloom.plans.queries import split_of_document
from corpusloom.sources import read_named_split, write_corpus, write_subset
from corpusloom.sources.incremental import IncrementalTable, Updated

SCHEMA = "k bigint, text string"


def _write(spark, folder, name, rows, mode="errorifexists"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(f"{folder}/{name}")


@pytest.fixture
def table(spark, tmp_path):
    read = []

    def process(rows):
        read.append(sorted(Path(f).parent.name for f in rows.inputFiles()))
        return rows.select("_file", "k", F.length("text").alias("n"))

    found = IncrementalTable(spark, str(tmp_path / "in"), str(tmp_path / "out"), process)
    found.files_read = read
    found.folder = str(tmp_path / "in")
    return found


def _rows(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def test_only_new_and_changed_files_are_read(spark, table):
    _write(spark, table.folder, "a", [(1, "x"), (2, "xx")])
    _write(spark, table.folder, "b", [(3, "xxx")])
    assert table.update() == Updated(1, 2, 2, 0)
    assert table.update() == Updated(1, 2, 0, 0)
    _write(spark, table.folder, "c", [(4, "xxxx"), (4, None)])
    assert table.update() == Updated(2, 3, 1, 0)
    assert _rows(table) == [(1, 1), (2, 2), (3, 3), (4, 4), (4, None)]
    _write(spark, table.folder, "a", [(1, "xxxxx")], "overwrite")
    update = table.update()
    assert (update.number, update.files, update.processed) == (3, 3, 1)
    assert table.files_read == [["a", "b"], ["c"], ["a"]]
    assert sorted(table.read().where("k < 4").collect()) == [(1, 5), (3, 3)]


def test_removed_files_take_their_rows_along(spark, table):
    for name, k in (("a", 1), ("b", 2)):
        _write(spark, table.folder, name, [(k, "x")])
    table.update()
    gone = next(Path(table.folder, "a").glob("*.parquet"))
    gone.rename(gone.with_suffix(".old"))
    assert table.update() == Updated(2, 1, 0, 1)
    assert _rows(table) == [(2, 1)]


def test_an_update_that_failed_is_done_again(spark, table):
    _write(spark, table.folder, "a", [(1, "x")])
    table.update()
    _write(spark, table.folder, "b", [(2, "xx")])
    whole, table.process = table.process, lambda rows: rows.select("_file", "k", F.raise_error(F.lit("no")).alias("n"))
    with pytest.raises(Exception, match="no"):
        table.update()
    assert _rows(table) == [(1, 1)]
    table.process = whole
    assert table.update() == Updated(2, 2, 1, 0)
    assert _rows(table) == [(1, 1), (2, 2)]


def test_splits_are_replaced_one_by_one_and_pruned(spark, tmp_path):
    path = str(tmp_path / "corpus")
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")).withColumn("split", split_of_document())
    write_corpus(docs, path)
    before = {r["split"]: r["count"] for r in spark.read.parquet(path).groupBy("split").count().collect()}
    write_corpus(docs.where("split = 'test'").limit(1).withColumn("text", F.lit("b")), path)
    test = read_named_split(spark, {"c": path}, "c", "test")
    assert [r["text"] for r in test.collect()] == ["b"]
    train = read_named_split(spark, {"c": path}, "c", "train")
    assert train.count() == before["train"] and train.where("text = 'b'").isEmpty()
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_measures_are_observed_while_writing(spark, tmp_path):
    docs = spark.range(1000).select("id", F.repeat(F.lit("é"), F.col("id").cast("int") % 5).alias("text"))
    first, read = head(docs, 10, ["id"]), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = first.coalesce(1).mapInArrow(count, first.schema)
    written = write_subset(counted, str(tmp_path / "s"), {"bytes": F.sum(F.octet_length("text")), "last": F.max("id")})
    assert (written.rows, written.measures) == (10, {"bytes": 40, "last": 9})
    assert written.bytes > 0
    # Every row was computed once: no second pass counts them.
    assert read.value == 10
    assert write_subset(docs.limit(0), str(tmp_path / "none"), {"last": F.max("id")}).measures == {"last": None}
