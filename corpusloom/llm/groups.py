"""Many small groups in one pass of a task.

A grouped pandas function costs milliseconds per group. Here rows are dealt out by group,
sorted, and handed over as record batches that hold whole groups, so that a function can
treat thousands of groups at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.files import releasing


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where a row differs from the one before it in some key."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    run: Callable[[pa.Table, np.ndarray], pa.RecordBatch],
    schema: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """Apply ``run(rows, starts)`` to batches of whole groups; the keys are numbers without NULL.

    Rows of a group come in the given order.

    A task holds one batch and one group at a time, so groups should be of bounded size.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and all(held[0][k][0].as_py() == batch[k][batch.num_rows - 1].as_py() for k in keys):
                held.append(batch)
                continue
            table = pa.Table.from_batches([*held, batch])
            starts = _starts(table, keys)
            last = int(starts[-1])
            if last:
                yield run(table.slice(0, last), starts[:-1])
            held = table.slice(last).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield run(table, _starts(table, keys))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(releasing(over), schema)
