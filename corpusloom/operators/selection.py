"""Row selection: blank filter, batch map, first rows, subset report, intervals."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import contains_text
from corpusloom.operators.ordering import MERGE_WIDTH, first_rows


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    """Keep rows whose text is neither NULL nor whitespace only."""
    return df.where(contains_text(text))


def map_batches(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    columns: list[str] | None = None,
) -> DataFrame:
    """Apply user code to Arrow batches of rows; it may return fewer or more rows.

    Only ``columns`` are sent to Python and only what ``fn`` returns is kept. The
    partitions of ``df`` are the degree of parallelism.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return (df.select(*columns) if columns else df).mapInArrow(run, schema)


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in key order, or all rows if there are fewer."""
    return first_rows(df, n, order_by)


def head_per_split(df: DataFrame, n: int, order_by: list[str], split: str = "split") -> DataFrame:
    """The first ``n`` rows of each split in key order.

    Spark keeps ``n`` rows per split and task before a shuffle. The tasks are merged in
    two steps, so that no task reads ``n`` rows from each of very many.
    """
    tasks = df.withColumn("_tasks", F.spark_partition_id() % MERGE_WIDTH)
    for group in ([split, "_tasks"], [split]):
        ordered = Window.partitionBy(*group).orderBy(*order_by)
        tasks = tasks.withColumn("_rank", F.row_number().over(ordered)).where(F.col("_rank") <= n)
    return tasks.drop("_rank", "_tasks")


def subset_report(df: DataFrame, n: int) -> DataFrame:
    """How many rows there are and how many :func:`head` keeps."""
    return df.agg(F.count(F.lit(1)).alias("original_rows")).select(
        "original_rows", F.least("original_rows", F.lit(n).cast("bigint")).alias("subset_rows")
    )
