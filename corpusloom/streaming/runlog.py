"""Run logs as streams: enriched log, resumed runs and early stopping while runs go on."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom.operators.runlog import (
    LOGGING_STEPS,
    PATIENCE,
    at_interval,
    with_perplexity,
)

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: An evaluation that waits for earlier ones: time in microseconds, step and score.
WAITING = {"at": "<i8", "step": "<i8", "score": "<f8"}
#: Groups of runs that share their state; every group is one task's work in a micro-batch.
GROUPS = 256
#: Run ids of any type as text and back.
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def enriched_log(events: DataFrame, every: int = LOGGING_STEPS) -> DataFrame:
    """Metric events at the logging interval, with perplexity. Also works on a batch table."""
    return with_perplexity(at_interval(events, every))


def write_log_stream(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the log to Parquet files exactly once, until the input is used up."""
    return (
        log.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_repeated_steps(events: DataFrame, time: str, delay: str) -> DataFrame:
    """The first event of each ``(run_id, step)``; a resumed run repeats steps after its checkpoint.

    A step is remembered until event time has moved on by ``delay`` from its first event,
    so state is bounded; a run must be resumed within that time. Events that come later
    than ``delay`` behind the newest one are dropped.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["run_id", "step"])


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session whose streams may use timers and lists as state; the given one is not changed."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set(_STATE_STORE, _ROCKSDB)
    return own


def advance(
    scores: np.ndarray, best: float | None, waited: int, patience: int, threshold: float
) -> tuple[int | None, float | None, int]:
    """Go through scores in order: the place of the stop or None, the best so far, and how many failed to improve."""
    if not len(scores):
        return None, best, waited
    start = np.inf if best is None else best
    before = np.minimum.accumulate(np.concatenate([[start], scores]))[:-1]
    gain = before - scores
    improved = (gain > 0) & (gain > threshold)
    improved[0] |= best is None
    place = np.arange(len(scores))
    last = np.maximum.accumulate(np.where(improved, place, -1))
    waits = np.where(last >= 0, place - last, waited + 1 + place)
    stops = np.flatnonzero(waits >= patience)
    return (int(stops[0]) if len(stops) else None), float(min(start, scores.min())), int(waits[-1])


def _packed(columns: dict) -> bytes:
    """A table as the bytes of an Arrow stream, for one value of state."""
    table, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(chunks: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(chunk).read_all() for chunk in chunks])


class _EarlyStop(StatefulProcessor):
    """Per group of runs: evaluations wait until the watermark has passed them, then count in step order.

    A call for state costs more than many rows, so runs share it: the waiting evaluations of
    a group are kept as chunks, one per frame of arrived rows, and what its runs have reached
    as one table. One timer per group stands at its earliest waiting evaluation.
    """

    def __init__(self, patience: int, threshold: float):
        self.patience, self.threshold = patience, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._reached = handle.getValueState("reached", "runs binary, timer bigint")
        self._waiting = handle.getListState("waiting", "rows binary")

    def _state(self) -> tuple[dict[str, tuple[float, int, bool]], int | None]:
        """Best score, evaluations without improvement and whether it stopped, by run; the timer."""
        packed, timer = self._reached.get() or (None, None)
        if packed is None:
            return {}, timer
        runs, *reached = (c.to_pylist() for c in _unpacked([packed]).columns)
        return dict(zip(runs, zip(*reached, strict=True), strict=True)), timer

    def _keep(self, reached: dict[str, tuple[float, int, bool]], timer: int | None) -> None:
        best, waited, stopped = zip(*reached.values(), strict=True) if reached else ((), (), ())
        columns = {
            "run": pa.array(list(reached), pa.string()),
            "best": pa.array(best, pa.float64()),
            "waited": pa.array(waited, pa.int64()),
            "stopped": pa.array(stopped, pa.bool_()),
        }
        self._reached.update((_packed(columns), timer))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reached, stands = self._state()
        over = [run for run, (_, _, stopped) in reached.items() if stopped]
        timer = stands
        for frame in rows:
            frame = frame[~frame["waiting_run"].isin(over)]
            if frame.empty:
                continue
            chunk = {name: frame[f"waiting_{name}"].to_numpy().astype(kind) for name, kind in WAITING.items()}
            self._waiting.appendValue((_packed({"run": pa.array(frame["waiting_run"], pa.string())} | chunk),))
            timer = self._timer(int(chunk["at"].min()), timer)
        if timer != stands:
            self._keep(reached, timer)
        return iter([])

    def _timer(self, at: int, timer: int | None) -> int:
        """Have the timer of the group stand at or before the time ``at``."""
        due = -(-at // 1000)
        if timer is not None and timer <= due:
            return timer
        if timer is not None:
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(due)
        return due

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached, _ = self._state()
        rows = _unpacked([chunk[0] for chunk in self._waiting.get()]).combine_chunks()
        passed = rows["at"].to_numpy() <= timerValues.getCurrentWatermarkInMs() * 1000
        later = rows.filter(pa.array(~passed))
        stops = list(self._advanced(rows.filter(pa.array(passed)), reached))
        if stops:
            over = pa.array([run for run, _ in stops], pa.string())
            later = later.filter(pc.invert(pc.is_in(later["run"], over)))
        self._waiting.clear()
        timer = None
        if len(later):
            self._waiting.appendValue((_packed(dict(zip(later.column_names, later.columns, strict=True))),))
            timer = self._timer(pc.min(later["at"]).as_py(), None)
        self._keep(reached, timer)
        if stops:
            yield pd.DataFrame(stops, columns=["run", "stop_step"])

    def _advanced(self, due: pa.Table, reached: dict[str, tuple[float, int, bool]]) -> Iterator[tuple[str, int]]:
        """Go on in ``reached`` through evaluations that have passed; the runs that stop, with the step."""
        coded = due["run"].combine_chunks().dictionary_encode()
        number = coded.indices.to_numpy()
        at, step, score = (due[name].to_numpy() for name in WAITING)
        order = np.lexsort((score, at, step, number))
        step, score = step[order], score[order]
        ends = np.cumsum(np.bincount(number, minlength=len(coded.dictionary)))
        for run, first, end in zip(coded.dictionary.to_pylist(), [0, *ends[:-1]], ends, strict=False):
            best, waited, _ = reached.get(run, (None, 0, False))
            stop, best, waited = advance(score[first:end], best, waited, self.patience, self.threshold)
            reached[run] = best, waited, stop is not None
            if stop is not None:
                yield run, int(step[first + stop])

    def close(self) -> None:
        pass


def early_stop_stream(
    events: DataFrame,
    *,
    time: str,
    delay: str,
    patience: int = PATIENCE,
    threshold: float = 0.0,
    metric: str = "eval_loss",
    greater_is_better: bool = False,
    groups: int = GROUPS,
) -> DataFrame:
    """Emit ``(run_id, stop_step)`` once per run, as soon as it is certain.

    Evaluations may arrive in any order within ``delay`` of event time; they count in step
    order once the watermark has passed them, and later ones are dropped. Steps of a run
    must not run against its time. The stream's session needs the state store of
    :func:`with_state_store`. State per run is what has arrived within ``delay``; it is kept
    for ``groups`` groups of runs, a number that must stay the same for a checkpoint. What
    waits in one group must fit a Python worker.
    """
    if patience < 1:
        raise ValueError("patience must be at least 1 for a stream")
    score = -F.col(metric) if greater_is_better else F.col(metric)
    run_type = StructType([events.schema["run_id"]])
    rows = events.withWatermark(time, delay).where(F.col(metric).isNotNull())
    rows = rows.select(
        F.pmod(F.xxhash64("run_id"), F.lit(groups)).alias("group"),
        F.to_json(F.struct("run_id"), _TIMES).alias("waiting_run"),
        F.col(time),
        F.unix_micros(time).alias("waiting_at"),
        F.col("step").cast("bigint").alias("waiting_step"),
        score.cast("double").alias("waiting_score"),
    )
    stops = rows.groupBy("group").transformWithStateInPandas(
        statefulProcessor=_EarlyStop(patience, threshold),
        outputStructType="run string, stop_step bigint",
        outputMode="append",
        timeMode="eventTime",
    )
    run = F.from_json("run", run_type, _TIMES | {"mode": "FAILFAST"})
    return stops.select(run["run_id"].alias("run_id"), "stop_step")
