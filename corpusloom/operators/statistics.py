"""Split statistics and estimates from a prefix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import sentence_count, whitespace_tokens
from corpusloom.operators.ordering import EXACT, MAX_GROUPS
from corpusloom.operators.selection import drop_blank, head, head_per_split
from corpusloom.operators.windows import SPLITS

# How many rows the two reports look at.
SENTENCE_SAMPLE = 10000
HEAD_ROWS = 100


def _with_all_splits(metrics: DataFrame, splits: Sequence[str]) -> DataFrame:
    names = metrics.sparkSession.createDataFrame([(name,) for name in splits], "split string")
    return names.join(metrics, "split", "full").withColumn("num_examples", F.coalesce("num_examples", F.lit(0)))


def split_metrics(df: DataFrame, ids: str = "input_ids", splits: Sequence[str] = SPLITS) -> DataFrame:
    """Rows and sequence lengths per split; an empty split has 0 rows and NULL lengths."""
    length = F.size(ids).cast("bigint")
    metrics = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("num_examples"),
        F.avg(length).alias("avg_seq_length"),
        F.min(length).alias("min_seq_length"),
        F.max(length).alias("max_seq_length"),
        F.sum(length).alias("total_tokens"),
    )
    return _with_all_splits(metrics, splits)


def head_statistics(
    df: DataFrame,
    order_by: list[str],
    tokens: Callable[[Column], Column] = whitespace_tokens,
    *,
    text: str = "text",
    rows: int = HEAD_ROWS,
    splits: Sequence[str] = SPLITS,
    preview_tokens: int = 100,
    characters: int = 200,
) -> DataFrame:
    """Rows per split, and of the first ``rows``: mean length, first length and a preview.

    Blank texts do not count. The first rows are found from the keys; only their texts
    are tokenized, behind a filter on one key per split.
    """
    full = drop_blank(df, text)
    keys = full.select("split", *order_by)
    counts = keys.groupBy("split").agg(F.count(F.lit(1)).alias("num_examples"))
    last = head_per_split(keys, rows, order_by).groupBy("split")
    cuts = last.agg(F.to_json(F.max(F.struct(*order_by)), EXACT).alias("key")).limit(MAX_GROUPS + 1).collect()
    if len(cuts) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} splits")
    kind = keys.select(*order_by).schema
    reached = F.lit(False)
    for row in cuts:
        cut = F.from_json(F.lit(row["key"]), kind, EXACT)
        within = F.col(order_by[0]) <= cut[order_by[0]] if len(order_by) == 1 else F.struct(*order_by) <= cut
        reached |= (F.col("split") == row["split"]) & within
    first = full.where(reached).select("split", *order_by, tokens(F.col(text)).alias("_tokens"))
    shown = F.substring(F.array_join(F.slice("_tokens", 1, preview_tokens), " "), 1, characters)
    first = first.select("split", *order_by, F.size("_tokens").cast("bigint").alias("_length"), shown.alias("_shown"))
    first = first.groupBy("split").agg(
        F.avg("_length").alias(f"avg_length_{rows}"),
        F.min_by("_length", F.struct(*order_by)).alias("first_length"),
        F.min_by("_shown", F.struct(*order_by)).alias("preview"),
    )
    return _with_all_splits(counts.join(first, "split", "left"), splits)


def sentence_estimate(
    df: DataFrame,
    order_by: list[str],
    *,
    sample_size: int = SENTENCE_SAMPLE,
    reference_divisor: bool = False,
    text: str = "text",
) -> DataFrame:
    """Sentences in the first rows, scaled to all rows.

    The mean is taken over the rows that were read. ``reference_divisor`` divides by
    ``sample_size`` even if there are fewer rows.
    """
    total = df.agg(F.count(F.lit(1)).alias("n"))
    sample = head(df.select(*order_by, text), sample_size, order_by).agg(
        F.coalesce(F.sum(sentence_count(text)), F.lit(0)).alias("sentences"),
        F.count(F.lit(1)).alias("_read"),
    )
    divisor = F.lit(sample_size).cast("bigint") if reference_divisor else F.col("_read")
    mean = F.col("sentences") / F.nullif(F.col("sample_size"), F.lit(0))
    return (
        sample.select(divisor.alias("sample_size"), "sentences", total.scalar().alias("total_examples"))
        .withColumn("avg_per_example", mean)
        .withColumn("estimated_total", F.col("avg_per_example") * F.col("total_examples"))
    )
