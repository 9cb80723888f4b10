"""Losses of any scorer over a whole split as one sequence, with context over the borders of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import key_ranges
from corpusloom.session import materialize

#: Takes the ids before a stretch (at most ``context``) and the stretch itself; gives a loss
#: for each id of the stretch, NaN for one that it does not score.
Scorer = Callable[[np.ndarray, np.ndarray], np.ndarray]

_RANGE = "_range"


def _ids(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(np.int64) if column[row].is_valid else np.zeros(0, np.int64)


def _tails(context: int):
    """Per range and split: the last ``context`` ids and how many ids there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tail, n = None, np.zeros(0, np.int64), 0

        def row() -> pa.RecordBatch:
            made = {"split": [place[0]], _RANGE: [place[1]], "tail": [tail.tolist()], "n": [n]}
            return pa.RecordBatch.from_pydict(made, schema=_TAIL)

        for batch in batches:
            splits, ranges = batch["split"].to_pylist(), batch[_RANGE].to_pylist()
            for i, found in enumerate(zip(splits, ranges, strict=True)):
                if place is not None and found != place:
                    yield row()
                if found != place:
                    place, tail, n = found, np.zeros(0, np.int64), 0
                ids = _ids(batch["ids"], i)
                tail, n = np.concatenate([tail, ids])[-context:] if context else tail, n + batch["n"][i].as_py()
        if place is not None:
            yield row()

    return run


_TAIL = pa.schema([("split", pa.string()), (_RANGE, pa.int64()), ("tail", pa.list_(pa.int64())), ("n", pa.int64())])


def _carried(context: int):
    """What comes before each range of a split: its last ids and how many; one row per range goes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, tail, start = None, np.zeros(0, np.int64), 0
        for batch in batches:
            tails, starts = [], []
            for i, name in enumerate(batch["split"].to_pylist()):
                if i == 0 and split is None or name != split:
                    split, tail, start = name, np.zeros(0, np.int64), 0
                tails.append(tail.tolist())
                starts.append(start)
                tail = np.concatenate([tail, _ids(batch["tail"], i)])[-context:] if context else tail
                start += batch["n"][i].as_py()
            columns = {"split": batch["split"], _RANGE: batch[_RANGE], "tail": tails, "n": starts}
            yield pa.RecordBatch.from_pydict(columns, schema=_TAIL)

    return run


def _scored(scorer: Scorer, context: int):
    """Losses of consecutive texts; the ids before a text are kept from batch to batch."""
    schema = pa.schema([("split", pa.string()), ("pos", pa.int64()), ("nll", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at = np.zeros(0, np.int64), 0
        for batch in batches:
            starts = batch["start"].to_pylist()
            for i, split in enumerate(batch["split"].to_pylist()):
                ids = _ids(batch["ids"], i)
                if starts[i] is not None:  # the row that opens a range
                    before, at = ids, starts[i]
                    continue
                if not len(ids):
                    continue
                losses = np.asarray(scorer(before, ids), np.float64)
                if losses.shape != ids.shape:
                    raise ValueError(f"the scorer gave {losses.shape} losses for {len(ids)} ids")
                columns = [pa.array([split] * len(ids), pa.string()), pa.array(at + np.arange(len(ids)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(losses, mask=np.isnan(losses))], schema=schema)
                before = np.concatenate([before, ids])[-context:] if context else before
                at += len(ids)

    return run


def scored_losses(
    encoded: DataFrame,
    scorer: Scorer,
    order_by: Sequence[str],
    *,
    context: int,
    split: str = "split",
    ids: str = "input_ids",
) -> DataFrame:
    """``(split, pos, nll)`` of every id, from 0 in each split; NULL where the scorer gives none.

    All texts of a split follow each other in the order of ``order_by``, and the scorer sees
    the last ``context`` ids before a text, across borders of texts, batches and tasks. Texts
    are dealt out by ranges of the order key, so a large split is spread over many tasks;
    what a range needs from the earlier ones is one row per range.
    """
    order = [split, *order_by]
    rows = encoded.select(*order, F.col(ids).cast("array<bigint>").alias("ids")).where(F.size("ids") > 0)
    kept = F.least(F.size("ids"), F.lit(context))
    last = F.slice("ids", -kept, kept) if context else F.slice("ids", 1, 0)
    narrow = materialize(rows.select(*order, last.alias("ids"), F.size("ids").cast("bigint").alias("n")))
    place = key_ranges(narrow, order, weight=F.col("n")).range_of_key().cast("bigint").alias(_RANGE)
    name = F.col(split).cast("string").alias("split")
    kinds = f"split string, {_RANGE} bigint, tail array<bigint>, n bigint"
    dealt = narrow.select(name, place, *order_by, "ids", "n").repartition(_RANGE)
    dealt = dealt.sortWithinPartitions(_RANGE, "split", *order_by)
    tails = materialize(dealt.select("split", _RANGE, "ids", "n").mapInArrow(_tails(context), kinds))
    heads = tails.repartition("split").sortWithinPartitions("split", _RANGE).mapInArrow(_carried(context), kinds)
    texts = rows.select(name, place, *order_by, F.lit(None).cast("bigint").alias("start"), "ids")
    none = [F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in order_by]
    heads = materialize(heads).select("split", _RANGE, *none, F.col("n").alias("start"), F.col("tail").alias("ids"))
    both = texts.unionByName(heads).repartition(_RANGE)
    both = both.sortWithinPartitions(_RANGE, "split", F.col("start").isNull(), *order_by)
    return both.select("split", "start", "ids").mapInArrow(_scored(scorer, context), "split string, pos bigint, nll double")
