import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException

from corpusloom.operators.runlog import early_stop, metric_log
from corpusloom.operators.tokens import TokenCodec, build_vocabulary, tokenize
from corpusloom.plans.queries import run_log
from corpusloom.streaming.callbacks import BatchTable, record_of, replay_last_batch, run_callbacks
from corpusloom.streaming.corpus import (
    VocabularyStore,
    prepare,
    prepare_continuously,
    prepared_rows,
    write_prepared_stream,
)
from corpusloom.streaming.runlog import (
    advance,
    early_stop_stream,
    enriched_log,
    with_state_store,
    without_repeated_steps,
    write_log_stream,
)

SF_DIR = "/root/testdata/sf0.001"
LOG = "run_id bigint, step bigint, eval_loss double"


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_log_stream_equals_batch_and_restarts_without_duplicates(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    log = run_log(spark, SF_DIR)
    early, late = log.where("step <= 4"), log.where("step > 4")
    for part in (early, late):
        part.coalesce(1).write.mode("append").parquet(source)
        query = write_log_stream(enriched_log(_stream(spark, source, LOG), 3), sink, checkpoint)
        query.awaitTermination()
    write_log_stream(enriched_log(_stream(spark, source, LOG), 3), sink, checkpoint).awaitTermination()
    assert _rows(spark.read.parquet(sink)) == _rows(enriched_log(log, 3))


TIMED = "run_id bigint, step bigint, eval_loss double, at timestamp"


def _arrive(spark, path, rows, schema=TIMED):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _stops(spark, tmp_path, parts, delay="10 seconds", **settings):
    """The stops that the stream gives after each part."""
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    own, found = with_state_store(spark), []
    for rows in parts:
        _arrive(spark, source, rows)
        stream = own.readStream.schema(TIMED).parquet(source)
        stops = early_stop_stream(stream, time="at", delay=delay, **settings)
        write_log_stream(stops, sink, checkpoint).awaitTermination()
        found.append(_rows(spark.read.schema("run_id bigint, stop_step bigint").parquet(sink)))
    return found


def _row(run, step, loss):
    return run, step, loss, datetime(2024, 1, 1) + timedelta(seconds=step)


END = [(None, 0, 0.0, datetime(2025, 1, 1))]


def test_early_stop_counts_steps_in_order_however_they_arrive(spark, tmp_path):
    rng = random.Random(5)
    log = [_row(run, step, float(rng.randrange(9))) for run in range(12) for step in range(1, 30)]
    late = [r for r in log if rng.random() < 0.4 and r[1] <= 20]
    first = [r for r in log if r not in late and r[1] <= 20]
    rng.shuffle(first)
    rest = [r for r in log if r[1] > 20] + late + [(3, 5, None, datetime(2024, 1, 1))]
    found = _stops(spark, tmp_path, [first, rest, END], delay="25 seconds", patience=3, threshold=0.5)
    batch = early_stop(spark.createDataFrame(log, TIMED), patience=3, threshold=0.5)
    assert found[-1] == _rows(batch.where("stop_step IS NOT NULL"))
    assert len(found[-1]) > 5


def test_early_stop_waits_for_the_watermark_and_tells_once(spark, tmp_path):
    falling = [_row(1, 1, 5.0), _row(1, 3, 5.0), _row(1, 4, 5.0)]
    parts = [falling, [_row(1, 2, 4.0), _row(1, 5, 5.0)], [_row(1, 60, 9.0)], [_row(1, 70, 9.0)] + END]
    found = _stops(spark, tmp_path, parts, patience=3)
    # Step 2 came late, so the steps after it failed to improve on it, not on the first one.
    assert found == [[], [], [(1, 5)], [(1, 5)]]


def test_early_stop_state_does_not_grow_with_the_runs(spark, tmp_path):
    rng = random.Random(7)
    log = [_row(run, step, float(rng.randrange(5))) for run in range(600) for step in range(1, 6)]
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    own, kept = with_state_store(spark), []
    for rows in (log[::2], log[1::2] + END):
        _arrive(spark, source, rows)
        stops = early_stop_stream(own.readStream.schema(TIMED).parquet(source), time="at", delay="9 seconds", patience=2)
        query = write_log_stream(stops, sink, checkpoint)
        query.awaitTermination()
        kept += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    # One row for what runs have reached and one for what waits, for each of 256 groups; 1,202 when kept by run.
    assert 0 < max(kept) <= 256 * 3
    batch = early_stop(spark.createDataFrame(log, TIMED), patience=2)
    assert _rows(spark.read.parquet(sink)) == _rows(batch.where("stop_step IS NOT NULL"))


def test_early_stop_of_runs_beside_one_without_id(spark, tmp_path):
    log = [_row(run, step, 1.0) for run in [*range(40), None] for step in (1, 2, 3)]
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    own = with_state_store(spark)
    for rows in (log[::2], log[1::2] + [_row(0, 60, 1.0)]):
        _arrive(spark, source, rows)
        stops = early_stop_stream(own.readStream.schema(TIMED).parquet(source), time="at", delay="9 seconds", patience=2)
        write_log_stream(stops, sink, checkpoint).awaitTermination()
    found = spark.read.parquet(sink).collect()
    assert {r["run_id"]: r["stop_step"] for r in found} == dict.fromkeys([*range(40), None], 3)


@pytest.mark.parametrize(
    ("kind", "runs"),
    [
        ("bigint", [2**60 + 1, 2**60 + 2, None]),
        ("string", ['a"b\\', "", "\u00e4\n"]),
        ("binary", [b"\xff\x00", b""]),
        ("timestamp", [datetime(2024, 10, 27, 2, 30, 0, 123456), datetime(2024, 10, 27, 2, 30, 0, 123457)]),
    ],
)
def test_early_stop_keeps_run_ids_of_any_type(spark, tmp_path, kind, runs):
    schema = f"run_id {kind}, step bigint, eval_loss double, at timestamp"
    log = [_row(run, step, 1.0) for run in runs for step in (1, 2, 3)]
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    own = with_state_store(spark)
    for rows in (log, [(runs[0], 0, 0.0, datetime(2025, 1, 1))]):
        _arrive(spark, source, rows, schema)
        stream = own.readStream.schema(schema).parquet(source)
        stops = early_stop_stream(stream, time="at", delay="9 seconds", patience=2, groups=1)
        write_log_stream(stops, sink, checkpoint).awaitTermination()
    found = spark.read.parquet(sink).collect()
    assert sorted((r["run_id"], r["stop_step"]) for r in found if r["run_id"] is not None) == sorted((run, 3) for run in runs if run is not None)
    assert len(found) == len(runs)


def test_greater_is_better_in_a_stream(spark, tmp_path):
    rows = [_row(1, s, v) for s, v in enumerate([1.0, 2.0, 2.0, 1.0], 1)]
    assert _stops(spark, tmp_path, [rows, END], patience=2, greater_is_better=True)[-1] == [(1, 4)]


@given(
    st.lists(st.floats(-5, 5), max_size=30), st.integers(1, 4), st.sampled_from([0.0, 0.7]), st.lists(st.integers(0, 30))
)
def test_advance_in_pieces_equals_a_loop(scores, patience, threshold, cuts):
    best, waited, stop = None, 0, None
    for i, score in enumerate(scores):
        if best is None or (best - score > 0 and best - score > threshold):
            waited = 0
        else:
            waited += 1
        best = score if best is None else min(best, score)
        if waited >= patience:
            stop = i
            break
    got, reached, failed = None, None, 0
    edges = sorted({0, len(scores), *(c for c in cuts if c < len(scores))})
    for first, last in zip(edges, edges[1:]):
        place, reached, failed = advance(np.array(scores[first:last]), reached, failed, patience, threshold)
        if place is not None:
            got = first + place
            break
    assert got == stop


def test_resumed_runs_keep_the_first_event_of_a_step(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    sessions = [
        [_row(1, s, 1.0) for s in range(1, 8)] + [_row(2, 1, 1.0)],
        [(1, s, 2.0, datetime(2024, 1, 1, 0, 1, s)) for s in range(5, 12)],
        [(1, 11, 3.0, datetime(2024, 1, 1, 0, 2))],
    ]
    for rows in sessions:
        _arrive(spark, source, rows)
        kept = without_repeated_steps(spark.readStream.schema(TIMED).parquet(source), "at", "1 hour")
        write_log_stream(kept, sink, checkpoint).awaitTermination()
    found = _rows(spark.read.parquet(sink).select("run_id", "step", "eval_loss"))
    assert found == [(1, s, 1.0 if s < 8 else 2.0) for s in range(1, 12)] + [(2, 1, 1.0)]


class Broken(Exception):
    pass


def test_callbacks_see_every_batch_once_through_failures_and_replays(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    table = BatchTable(f"{folder}/table", TIMED)
    text = BatchTable(f"{folder}/text", TIMED, "csv", header="true")
    seen, failing = [], []

    def watch(batch, batch_id):
        if failing:
            # Half-written rows of an attempt that fails are replaced by the next one.
            text(batch.limit(1), batch_id)
            raise Broken
        text(batch, batch_id)
        seen.append((batch_id, batch.count()))

    def start():
        stream = spark.readStream.schema(TIMED).parquet(source)
        run_callbacks(stream, {"table": table, "watch": watch}, folder).awaitTermination()

    def rows(sink, name):
        return sink.read(record_of(spark, folder, name)).count()

    _arrive(spark, source, [_row(1, s, 1.0) for s in range(5)])
    start()
    _arrive(spark, source, [_row(1, s, 1.0) for s in range(5, 12)])
    failing.append(True)
    with pytest.raises(StreamingQueryException):
        start()
    # The table has finished this micro-batch, the other callback has not.
    assert (rows(table, "table"), rows(text, "watch")) == (12, 5)
    failing.clear()
    start()
    assert replay_last_batch(spark, folder) == 1
    start()
    assert seen == [(0, 5), (1, 7)]
    assert (rows(table, "table"), rows(text, "watch")) == (12, 12)
    assert _rows(table.read(record_of(spark, folder, "table"))) == _rows(text.read(record_of(spark, folder, "watch")))


def test_table_of_a_stream_that_has_not_run(spark, tmp_path):
    assert BatchTable(str(tmp_path / "t"), TIMED).read(record_of(spark, str(tmp_path), "t")).count() == 0


def test_metric_log_fills_train_and_evaluation_rows(spark):
    rows = [(1, s, float(s % 4), datetime(2024, 1, 1)) for s in range(0, 21)]
    log = metric_log(
        spark.createDataFrame(rows, "run_id int, step int, loss double, timestamp timestamp"),
        total_steps=20, steps_per_epoch=8, logging_steps=2, eval_steps=4, warmup_steps=4, peak=1.0,
    )
    found = {r["step"]: r for r in log.collect()}
    assert sorted(found) == list(range(0, 21, 2))
    assert found[2]["train_loss"] == 2.0 and found[2]["eval_loss"] is None and found[2]["learning_rate"] == 0.5
    assert found[12]["eval_loss"] == 0.0 and found[12]["eval_perplexity"] is None and found[12]["learning_rate"] is None
    assert found[6]["epoch"] == 0.75


def test_versions_of_a_vocabulary(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    kind = "doc_id bigint, text string"
    store = VocabularyStore(spark, str(tmp_path / "vocabulary"))

    def publish(*words):
        rows = [(w, i + 2, 1) for i, w in enumerate(words)]
        return store.publish(spark.createDataFrame(rows, "token string, id int, freq bigint"))

    def start(keep="doc_id"):
        stream = spark.readStream.schema(kind).parquet(source)
        prepare_continuously(stream, store, folder, keep=[keep]).awaitTermination()

    _arrive(spark, source, [(1, "a b"), (2, "b c"), (3, " "), (4, None)], kind)
    with pytest.raises(ValueError):
        start()
    assert publish("a", "b") == 1
    start()
    assert publish("b", "c") == 2
    replay_last_batch(spark, folder)
    start()
    _arrive(spark, source, [(5, "a b c")], kind)
    start()
    found = {r["doc_id"]: (r["input_ids"], r["vocabulary_version"]) for r in prepared_rows(spark, folder).collect()}
    assert found == {1: ([2, 3], 1), 2: ([3, 1], 1), 5: ([1, 2, 3], 2)}


def test_a_repeated_batch_takes_the_version_it_began_with(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    store = VocabularyStore(spark, str(tmp_path / "vocabulary"))
    vocabulary = spark.createDataFrame([("a", 2, 1)], "token string, id int, freq bigint")
    store.publish(vocabulary)
    _arrive(spark, source, [(1, "a")], "doc_id bigint, text string")
    for _ in range(2):
        stream = spark.readStream.schema("doc_id bigint, text string").parquet(source)
        prepare_continuously(stream, store, folder, keep=["doc_id"]).awaitTermination()
        # As if the driver had failed before the micro-batch was finished.
        replay_last_batch(spark, folder)
        (tmp_path / "stream" / "finished" / "prepared" / "0").unlink()
        store.publish(vocabulary)
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(source)
    prepare_continuously(stream, store, folder, keep=["doc_id"]).awaitTermination()
    assert [r["vocabulary_version"] for r in prepared_rows(spark, folder).collect()] == [1]


def test_prepared_stream_equals_batch(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    blanks = spark.createDataFrame([(10**6, " \n"), (10**6 + 1, None)], "doc_id bigint, text string")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").union(blanks)
    codec = TokenCodec(build_vocabulary(tokenize(docs, max_length=None), 500))
    docs.repartitionByRange(3, "doc_id").write.parquet(source)
    stream = prepare(_stream(spark, source, "doc_id bigint, text string"), codec, keep=["doc_id"], max_length=64)
    write_prepared_stream(stream, sink, checkpoint).awaitTermination()
    batch = prepare(docs, codec, keep=["doc_id"], max_length=64)
    assert _rows(spark.read.parquet(sink)) == _rows(batch)
    assert spark.read.parquet(sink).count() == docs.count() - 2
