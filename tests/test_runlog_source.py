from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException

from corpusloom.sources import RUN_LOG_SCHEMA
from corpusloom.sources import runlog_source as source
from corpusloom.streaming.callbacks import replay_last_batch


@pytest.fixture(scope="module")
def log_spark(spark):
    source.register(spark)
    return spark


def _row(run, step, loss=None):
    return run, step, step / 3, loss, 1e-17 * step, None, None, datetime(2024, 1, 1, 2, 3, 4, 567890, timezone.utc)


def _append(spark, path, rows, **options):
    frame = spark.createDataFrame(rows, RUN_LOG_SCHEMA).repartition(2)
    frame.write.format("runlog").options(**options).mode("append").save(path)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _read(spark, path):
    return spark.read.format("runlog").load(path)


ODD = [_row('a "quoted", run\nof two lines', 1, 0.1 + 0.2), _row("", 2, 5e-324), _row(None, 3), _row("é", 4, -0.0)]


def test_rows_come_back_and_appends_add_up(log_spark, tmp_path):
    path = str(tmp_path / "log")
    _append(log_spark, path, ODD)
    _append(log_spark, path, [_row("b", 5, 1.5)])
    expected = log_spark.createDataFrame([*ODD, _row("b", 5, 1.5)], RUN_LOG_SCHEMA)
    found = _read(log_spark, path)
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert _rows(found) == _rows(expected)
    assert _read(log_spark, path).where("step > 3").select("run_id").count() == 2
    assert source.commits(path) == {1: "", 2: ""}


def test_parts_in_a_row_are_one_csv_file_with_one_header(log_spark, tmp_path):
    path = tmp_path / "log"
    for step in (1, 2, 3):
        _append(log_spark, str(path), [_row("r", step)])
    lines = "".join(p.read_text() for p in sorted(path.glob("*.csv"))).splitlines()
    assert lines[0].replace('"', "").split(",")[:3] == ["run_id", "step", "epoch"]
    assert [line.split(",")[1] for line in lines] == ['"step"', "1", "2", "3"]


def test_what_is_not_committed_is_not_read(log_spark, tmp_path):
    path = tmp_path / "log"
    _append(log_spark, str(path), [_row("r", 1)])
    part = next(p for p in path.glob("*.csv") if "header" not in p.name)
    (path / part.name.replace("000000000001-", "000000000002-")).write_bytes(part.read_bytes())
    (path / ".half.attempt").write_text("r,9")
    assert _read(log_spark, str(path)).count() == 1
    _append(log_spark, str(path), [_row("r", 2)])
    assert sorted(r["step"] for r in _read(log_spark, str(path)).collect()) == [1, 2]


def test_a_failed_write_leaves_nothing(log_spark, tmp_path):
    path = tmp_path / "log"
    _append(log_spark, str(path), [_row("r", 1)])
    bad = log_spark.createDataFrame([_row("r", 2)], RUN_LOG_SCHEMA).selectExpr(
        "run_id", "if(step = 2, raise_error('no'), step) AS step", "epoch", "train_loss", "learning_rate",
        "eval_loss", "eval_perplexity", "timestamp",
    )
    with pytest.raises(PySparkException):
        bad.write.format("runlog").mode("append").save(str(path))
    assert _read(log_spark, str(path)).count() == 1 and source.commits(str(path)) == {1: ""}


def test_empty_logs_and_unlike_uses(log_spark, tmp_path):
    path = str(tmp_path / "log")
    assert _read(log_spark, path).count() == 0
    _append(log_spark, path, [])
    assert _read(log_spark, path).count() == 0 and len(source.commits(path)) == 1
    with pytest.raises(PySparkException):
        log_spark.range(1).selectExpr("array(id) AS ids").write.format("runlog").mode("append").save(path)
    with pytest.raises(PySparkException):
        log_spark.createDataFrame(ODD, RUN_LOG_SCHEMA).write.format("runlog").mode("overwrite").save(path)


def test_stream_from_log_to_log_through_a_replay(log_spark, tmp_path):
    first, second, folder = (str(tmp_path / n) for n in ("first", "second", "stream"))

    def copy():
        stream = log_spark.readStream.format("runlog").load(first).writeStream.format("runlog")
        stream = stream.option("checkpointLocation", f"{folder}/checkpoint").option("path", second).option("writer", "copy")
        stream.trigger(availableNow=True).start().awaitTermination()

    _append(log_spark, first, ODD)
    copy()
    _append(log_spark, first, [_row("b", 5, 1.5)])
    assert replay_last_batch(log_spark, folder) == 0
    copy()
    assert _rows(_read(log_spark, second)) == _rows(log_spark.createDataFrame(ODD, RUN_LOG_SCHEMA))
    copy()
    assert _rows(_read(log_spark, second)) == _rows(_read(log_spark, first))
    assert list(source.commits(second).values()) == ["copy-0", "copy-1"]
