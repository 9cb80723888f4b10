"""Positions and running aggregates over a whole corpus in key order.

``sum().over(Window.orderBy(key))`` moves every row to one task. Here the key space is
cut into ranges, each range is one window partition, and what a range needs from the
earlier ones (one row per range and group) is broadcast. The range of a row is a pure
function of its key and of literals in the plan, so recomputing a lost task gives the
same rows, and a range never grows with the share of rows that one group holds.

Order keys must identify a row, otherwise the order within equal keys is undefined.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

_RANGE = "_range"
#: How many groups of tasks are merged before the final merge.
MERGE_WIDTH = 256
#: Rows of a range, about: what a window sorts in one task. Ranges of wide rows hold fewer.
RANGE_ROWS = 1_000_000
#: Weight that counts as one row.
WEIGHT_OF_ROW = 100
#: Groups whose starts are a constant of a plan.
MAX_GROUPS = 1000

# Formats that keep every digit of a key on its way from a result into a plan.
EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class KeyRanges:
    """Consecutive key ranges: the first key of each range but the first, and exact row counts.

    Keys are kept as JSON text that Spark wrote. In a plan they become one constant.
    """

    schema: StructType
    firsts: tuple[str, ...]
    rows: tuple[int, ...]

    @property
    def total(self) -> int:
        return sum(self.rows)

    def range_of_key(self) -> Column:
        """Which range a row belongs to: how many range starts are not after its key.

        A binary search: steps of falling powers of two, each taken if the start it leads
        to exists and is not after the key.
        """
        if not self.firsts:
            return F.lit(0)
        starts = F.from_json(F.lit(f"[{','.join(self.firsts)}]"), ArrayType(self.schema), EXACT)
        key = F.struct(*self.schema.names)
        digits = len(self.firsts).bit_length()
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(digits))])

        def advance(place: Column, step: Column) -> Column:
            return F.when(F.try_element_at(starts, place + step) <= key, place + step).otherwise(place)

        return F.aggregate(steps, F.lit(0), advance)

    def rows_before(self, range_column: str = _RANGE) -> Column:
        """How many rows the earlier ranges hold."""
        before = [0, *accumulate(self.rows[:-1])]
        constant = F.from_json(F.lit(str(before)), "array<bigint>")
        return F.element_at(constant, F.col(range_column) + 1)


def range_count(rows: DataFrame, weight: Column | None = None) -> int:
    """Twice the shuffle partitions, more if a range would exceed ``RANGE_ROWS`` rows or weight."""
    total = F.count(F.lit(1))
    if weight is not None:
        total = F.greatest(total, F.ceil(F.coalesce(F.sum(weight), F.lit(0)) / WEIGHT_OF_ROW))
    size = rows.agg(total.alias("n")).first()["n"]
    return max(2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_ROWS))


def key_ranges(
    df: DataFrame, order_by: Sequence[str], parts: int | None = None, weight: Column | None = None
) -> KeyRanges:
    """Cut the key space into ranges of similar numbers of rows.

    Reads only the key columns and ``weight``. The number of ranges follows the rows, so a
    range stays small enough for one task at any size, and there are more ranges than
    tasks. ``weight`` is what else a row brings along, such as tokens: their sum raises
    the number of ranges. One row per range comes to the driver.
    """
    parts = parts or range_count(df, weight)
    keys = df.select(*order_by)
    found = (
        keys.repartitionByRange(parts, *order_by)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.to_json(F.min(F.struct(*order_by)), EXACT).alias("first"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    found.sort(key=lambda row: row["part"])
    return KeyRanges(
        schema=keys.schema,
        firsts=tuple(row["first"] for row in found[1:]),
        rows=tuple(row["rows"] for row in found),
    )


def group_starts(df: DataFrame, group: str) -> dict[str | None, int]:
    """How many rows stand before the first one of each group, in the order of the groups.

    Groups are few, such as splits; more than ``MAX_GROUPS`` are an error.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(group).limit(MAX_GROUPS + 1).collect()
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"{group!r} has more than {MAX_GROUPS} values")
    starts, before = {}, 0
    for row in counts:
        starts[row[group]] = before
        before += row["n"]
    return starts


def start_of_group(starts: Mapping[str | None, int], group: str) -> Column:
    """The same as a column: a constant of the plan. NULL is the first group."""
    start = F.lit(0).cast("bigint")
    for value, before in starts.items():
        if value is not None:
            start = F.when(F.col(group) == F.lit(value), F.lit(before)).otherwise(start)
    return start


def aligned_ranges(
    df: DataFrame,
    order_by: Sequence[str],
    unit_rows: int,
    parts: int | None = None,
    starts: Mapping[str | None, int] | None = None,
) -> KeyRanges:
    """Ranges that each hold whole units of ``unit_rows`` consecutive rows.

    Work within a unit then needs one shuffle of the wide rows: by range. With ``starts``
    of the groups in the first order key, units begin anew in each group.
    """
    coarse = key_ranges(df, order_by, parts)
    units = math.ceil(coarse.total / unit_rows)
    rows = unit_rows * max(1, math.ceil(units / max(1, len(coarse.rows))))
    index = F.col("row_index")
    within = index - (start_of_group(starts, order_by[0]) if starts else F.lit(0))
    found = (
        with_row_index(df.select(*order_by), order_by, ranges=coarse)
        .where((index > 0) & (within % rows == 0))
        .select("row_index", F.to_json(F.struct(*order_by), EXACT).alias("first"))
        .collect()
    )
    found.sort(key=lambda row: row["row_index"])
    edges = [0, *(row["row_index"] for row in found), coarse.total]
    return KeyRanges(
        schema=coarse.schema,
        firsts=tuple(row["first"] for row in found),
        rows=tuple(b - a for a, b in zip(edges, edges[1:], strict=False)),
    )


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in key order, as a filter.

    The key of the last of them is found from the key columns alone; the other columns are
    neither sorted nor shuffled. With a single key the filter reaches the scan. Keys
    that do not tell the last row and the next one apart are an error.
    """
    if n <= 0:
        return df.limit(0)
    keys = df.select(*order_by)
    # At most n + 1 narrow rows leave each task, and each merge reads those of few tasks.
    tasks = keys.withColumn("_tasks", F.spark_partition_id() % MERGE_WIDTH)
    for group in (F.col("_tasks"), F.lit(0)):
        ordered = Window.partitionBy(group).orderBy(*order_by)
        tasks = tasks.withColumn("_rank", F.row_number().over(ordered)).where(F.col("_rank") <= n + 1)
    edge = tasks.where(F.col("_rank") >= n).select("_rank", F.to_json(F.struct(*order_by), EXACT).alias("key"))
    found = {row["_rank"]: row["key"] for row in edge.collect()}
    if n + 1 not in found:
        return df
    if found[n] == found[n + 1]:
        raise ValueError(f"the order keys {list(order_by)} do not tell rows {n} and {n + 1} apart")
    cut = F.from_json(F.lit(found[n]), keys.schema, EXACT)
    if len(order_by) > 1:
        return df.where(F.struct(*order_by) <= cut)
    key = F.col(order_by[0])
    return df.where(key.isNull() | (key <= cut[order_by[0]]))


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_index",
    *,
    ranges: KeyRanges | None = None,
    keep_range: bool = False,
) -> DataFrame:
    """Number the rows from 0 in key order."""
    ranges = ranges or key_ranges(df, order_by)
    within = Window.partitionBy(_RANGE).orderBy(*order_by)
    indexed = df.withColumn(_RANGE, ranges.range_of_key()).withColumn(
        name, ranges.rows_before() + F.row_number().over(within) - 1
    )
    return indexed if keep_range else indexed.drop(_RANGE)


@dataclass(frozen=True)
class Running:
    """An aggregate over all earlier rows of the group, the current one excluded.

    ``sum`` starts at 0; ``min``, ``max`` and ``last`` (the latest value that is not
    NULL) are NULL on the first row.
    """

    how: str
    value: Column


def with_running(
    df: DataFrame,
    order_by: Sequence[str],
    running: Mapping[str, Running],
    *,
    group_by: Sequence[str] = (),
    range_of_row: Column | None = None,
    totals_of: DataFrame | None = None,
) -> DataFrame:
    """Add running aggregates in key order, per group if ``group_by`` is given.

    ``range_of_row`` cuts the order into ranges and must not decrease along it; by
    default the ranges come from :func:`key_ranges`. The groups of ``group_by`` must lead
    ``order_by``: then what is carried from earlier ranges has one row per range at most,
    which bounds the broadcast. ``totals_of`` is a narrower table with the same keys from
    which the totals of a range are taken when ``df`` carries wide columns.
    """
    if list(order_by[: len(group_by)]) != list(group_by):
        raise ValueError(f"the order {list(order_by)} must begin with the groups {list(group_by)}")
    if range_of_row is None:
        range_of_row = key_ranges(totals_of if totals_of is not None else df, order_by).range_of_key()
    place = [_RANGE, *group_by]
    within = Window.partitionBy(*place).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group_by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)

    def over_rows(r: Running) -> Column:
        return F.last(r.value, ignorenulls=True) if r.how == "last" else getattr(F, r.how)(r.value)

    def over_range(r: Running) -> Column:
        if r.how == "last":
            return F.max_by(r.value, F.when(r.value.isNotNull(), F.struct(*order_by)))
        return getattr(F, r.how)(r.value)

    def over_ranges(how: str, name: str) -> Column:
        return F.last(name, ignorenulls=True) if how == "last" else getattr(F, how)(name)

    def combine(how: str, local: Column, carried: Column) -> Column:
        if how == "sum":
            return F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        if how == "last":
            return F.coalesce(local, carried)
        return (F.least if how == "min" else F.greatest)(local, carried)

    ranged = df.withColumn(_RANGE, range_of_row)
    totals = (totals_of if totals_of is not None else df).withColumn(_RANGE, range_of_row)
    totals = totals.groupBy(*place).agg(*[over_range(r).alias(name) for name, r in running.items()])
    # A group is carried into a range only if an earlier range holds it as well: with
    # leading group keys that is the first group of a range, so at most one row per range.
    carried = totals.select(
        *place,
        F.count(F.lit(1)).over(earlier).alias("_earlier"),
        *[over_ranges(r.how, name).over(earlier).alias(f"_carried_{name}") for name, r in running.items()],
    )
    carried = carried.where("_earlier > 0").drop("_earlier")
    local = ranged.select("*", *[over_rows(r).over(within).alias(f"_local_{name}") for name, r in running.items()])
    joined = local.join(F.broadcast(carried), place, "left")
    return joined.select(
        *[F.col(name) for name in df.columns],
        *[
            combine(r.how, F.col(f"_local_{name}"), F.col(f"_carried_{name}")).alias(name)
            for name, r in running.items()
        ],
    )
