"""Token positions of a corpus and the sliding windows over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import Running, key_ranges, with_running
from corpusloom.session import materialize

# Split names, window length and step.
SPLITS = ("train", "validation", "test")
WINDOW_LENGTH = 2048
WINDOW_STRIDE = 512


def document_lengths(tokenized: DataFrame, keep: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """One narrow row per document that has tokens, written once: ``keep`` and ``n_tokens``."""
    lengths = tokenized.select(*keep, F.size(tokens).cast("bigint").alias("n_tokens"))
    return materialize(lengths).where("n_tokens > 0")


def corpus_positions(lengths: DataFrame, order_by: Sequence[str], split: str | None = None) -> DataFrame:
    """Add ``row_index`` and ``token_start``: the place of each document in the joined text.

    The blank lines between joined texts are whitespace and add no token. With ``split``
    the positions restart in each split.
    """
    groups = [split] if split else []
    order = [*groups, *order_by]
    return with_running(
        lengths,
        order,
        {"row_index": Running("sum", F.lit(1).cast("bigint")), "token_start": Running("sum", F.col("n_tokens"))},
        group_by=groups,
        range_of_row=key_ranges(lengths, order).range_of_key(),
    )


def check_windows(length: int, stride: int) -> None:
    if not 0 < stride <= length:
        raise ValueError("stride must be positive and not exceed the window length, or tokens stay unscored")


def with_split_total(
    rows: DataFrame,
    lengths: DataFrame,
    name: str,
    value: str = "n_tokens",
    split: str = "split",
    splits: Sequence[str] = SPLITS,
) -> DataFrame:
    """Add the sum of ``value`` over the split of each row.

    Only the totals of the listed ``splits`` are broadcast, which bounds them; a row of
    another split is an error.
    """
    totals = lengths.where(F.col(split).isin(*splits)).groupBy(split).agg(F.sum(value).alias(name))
    joined = rows.join(F.broadcast(totals), split, "left")
    unlisted = F.raise_error(F.concat(F.lit("split is not listed: "), F.col(split)))
    return joined.withColumn(
        name, F.when(F.col(split).isin(*splits), F.col(name)).otherwise(unlisted.cast("bigint"))
    )


def sliding_windows(
    positions: DataFrame,
    *,
    length: int = WINDOW_LENGTH,
    stride: int = WINDOW_STRIDE,
    split: str = "split",
    splits: Sequence[str] = SPLITS,
) -> DataFrame:
    """The windows ``(begin, end, trg_len)`` over each split.

    Every document emits the windows that begin inside it, so the plan of a long split
    is built by many tasks and no sequence of a whole split exists. A window is kept if
    the one before it did not already reach the end.
    """
    check_windows(length, stride)
    begin, n = F.col("begin"), F.col("n")
    first = F.ceil(F.col("token_start") / stride).cast("bigint") * stride
    last = F.col("token_start") + F.col("n_tokens") - 1
    begins = F.when(first <= last, F.sequence(first, last, F.lit(stride).cast("bigint")))
    previous_end = F.when(begin == 0, F.lit(0)).otherwise(begin - stride + length)
    end = F.least(begin + length, n)
    started = positions.select(split, F.explode(begins).alias("begin"))
    return (
        with_split_total(started, positions, "n", split=split, splits=splits)
        .where(previous_end < n)
        .select(split, "begin", end.alias("end"), (end - previous_end).alias("trg_len"))
    )


def window_of(position: Column, length: int, stride: int) -> Column:
    """Which window scores a token: the first one that reaches it."""
    later = F.floor((position - length) / stride).cast("bigint") + 1
    return F.when(position < length, F.lit(0).cast("bigint")).otherwise(later)


def window_targets(
    positions: DataFrame,
    *,
    length: int = WINDOW_LENGTH,
    stride: int = WINDOW_STRIDE,
    split: str = "split",
) -> DataFrame:
    """First and last scored token of each window and how many it scores.

    All earlier tokens of the window are context and have the ignored label.
    """
    check_windows(length, stride)
    first, last = F.col("token_start"), F.col("token_start") + F.col("n_tokens") - 1
    touched = F.sequence(window_of(first, length, stride), window_of(last, length, stride))
    pieces = positions.select(split, first.alias("_first"), last.alias("_last"), F.explode(touched).alias("window"))
    window = F.col("window")
    opens = F.when(window == 0, F.lit(0)).otherwise(length + (window - 1) * stride)
    closes = length + window * stride - 1
    pieces = pieces.select(
        split,
        "window",
        F.greatest("_first", opens).alias("_from"),
        F.least("_last", closes).alias("_to"),
    )
    return pieces.groupBy(split, "window").agg(
        F.min("_from").alias("first_target"),
        F.max("_to").alias("last_target"),
        F.sum(F.col("_to") - F.col("_from") + 1).alias("n_targets"),
    )
