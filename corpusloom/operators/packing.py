"""Packing into blocks, padding, label masking and token masking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ordering import (
    Running,
    aligned_ranges,
    group_starts,
    key_ranges,
    start_of_group,
    with_row_index,
    with_running,
)
from corpusloom.operators.windows import SPLITS, with_split_total
from corpusloom.session import materialize

# Label that the loss ignores, and the padding multiple.
IGNORED_LABEL = -100
PAD_MULTIPLE = 8


def pack_batches(
    encoded: DataFrame,
    order_by: Sequence[str],
    *,
    batch_rows: int = 1000,
    block_size: int = 2048,
    ids: str = "input_ids",
    split: str | None = None,
) -> DataFrame:
    """Concatenate the ids of each batch of consecutive rows and cut them into blocks.

    With ``split`` every split is batched by itself. A batch drops its remainder if it has a full block; a shorter batch gives one short
    block. Rows are shuffled once, to ranges that hold whole batches; offsets, cutting
    and regrouping stay within a range.
    """
    rows = _batched(encoded, order_by, batch_rows, "batch", ids, split)
    place = ["_range", *([split] if split else []), "batch"]
    ordered = Window.partitionBy(*place).orderBy("row_index")
    length = F.size(ids).cast("bigint")
    placed = rows.select(
        *place,
        F.col(ids).alias("_ids"),
        (F.sum(length).over(ordered) - length).alias("_start"),
        F.sum(length).over(Window.partitionBy(*place)).alias("_total"),
    )
    return _cut_and_join(placed, place, block_size).drop("_range")


def _batched(
    encoded: DataFrame, order_by: Sequence[str], batch_rows: int, name: str, ids: str, split: str | None
) -> DataFrame:
    """Number the batches of consecutive rows, in each split from 0, in ranges of whole batches."""
    order = [*([split] if split else []), *order_by]
    keys = materialize(encoded.select(*order))
    starts = group_starts(keys, split) if split else None
    ranges = aligned_ranges(keys, order, batch_rows, starts=starts)
    rows = with_row_index(encoded.select(*order, ids), order, ranges=ranges, keep_range=True)
    if starts:
        rows = rows.withColumn("row_index", F.col("row_index") - start_of_group(starts, split))
    return rows.withColumn(name, F.floor(F.col("row_index") / batch_rows).cast("bigint"))


def pack_splits(
    encoded: DataFrame,
    order_by: Sequence[str],
    *,
    block_size: int = 2048,
    ids: str = "input_ids",
    split: str = "split",
    splits: Sequence[str] = SPLITS,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Concatenate the ids of each whole split and cut them into blocks.

    ``lengths`` holds the order keys and ``n_tokens`` of every row, for instance of the
    tokens before they were encoded; without it the ids are computed once more to measure
    them. Offsets come from that narrow table and are joined to the ids.
    """
    order = [split, *order_by]
    if lengths is None:
        lengths = encoded.select(*order, F.size(ids).cast("bigint").alias("n_tokens"))
    lengths = materialize(lengths.select(*order, "n_tokens"))
    ranges = key_ranges(lengths, order, weight=F.col("n_tokens")).range_of_key()
    starts = with_running(
        lengths, order, {"_start": Running("sum", F.col("n_tokens"))}, group_by=[split], range_of_row=ranges
    )
    starts = with_split_total(starts, lengths, "_total", split=split, splits=splits).drop("n_tokens")
    placed = encoded.select(*order, F.col(ids).alias("_ids")).join(starts, order)
    placed = placed.select(split, "_ids", "_start", "_total")
    return _cut_and_join(placed, [split], block_size)


def _cut_and_join(placed: DataFrame, place: Sequence[str], block_size: int) -> DataFrame:
    """Cut each row's ids at block borders and join the pieces of a block in order.

    A block takes at most ``block_size`` ids, which bounds what is gathered.
    """
    start, total = F.col("_start"), F.col("_total")
    length = F.size("_ids")
    used = F.when(total >= block_size, total - total % block_size).otherwise(total)
    end = F.least(start + length, used)
    first_block = F.floor(start / block_size).cast("bigint")
    last_block = F.floor((end - 1) / block_size).cast("bigint")
    blocks = F.when(end > start, F.sequence(first_block, last_block))
    pieces = placed.select(*place, "_ids", "_start", end.alias("_end"), F.explode(blocks).alias("block"))
    piece_start = F.greatest(F.col("_start"), F.col("block") * block_size)
    piece_end = F.least(F.col("_end"), (F.col("block") + 1) * block_size)
    pieces = pieces.select(
        *place,
        "block",
        piece_start.alias("_at"),
        F.slice("_ids", (piece_start - F.col("_start") + 1).cast("int"), (piece_end - piece_start).cast("int")).alias(
            "_piece"
        ),
    )
    joined = pieces.groupBy(*place, "block").agg(F.sort_array(F.collect_list(F.struct("_at", "_piece"))).alias("_p"))
    block = F.flatten("_p._piece")
    return joined.select(*place, "block", block.alias("input_ids")).select(
        "*",
        F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        F.col("input_ids").alias("labels"),
    )


def collate(
    encoded: DataFrame,
    order_by: Sequence[str],
    *,
    batch_size: int = 4,
    pad_id: int = 0,
    multiple: int | None = PAD_MULTIPLE,
    ids: str = "input_ids",
    split: str | None = None,
) -> DataFrame:
    """Pad each batch of consecutive rows to its longest row, rounded up to ``multiple``.

    With ``split`` every split is batched by itself. Labels equal the ids with every padding id replaced by -100. If the padding id is
    the end id, genuine end tokens are replaced too. Rows are shuffled once, to ranges
    that hold whole batches.
    """
    rows = _batched(encoded, order_by, batch_size, "batch_id", ids, split)
    group = [split] if split else []
    longest = F.max(F.size(ids)).over(Window.partitionBy("_range", *group, "batch_id"))
    width = longest if multiple is None else F.ceil(longest / multiple) * multiple
    padded = rows.select(*group, *order_by, "batch_id", ids, width.cast("int").alias("width"))
    return pad_to_width(padded.withColumn("n_pad", F.col("width") - F.size(ids)), pad_id, ids)


def pad_to_width(rows: DataFrame, pad_id: int, ids: str = "input_ids") -> DataFrame:
    """Append ``n_pad`` padding ids and add the mask and the labels."""
    others = [name for name in rows.columns if name != ids]
    padded = F.concat(ids, F.array_repeat(F.lit(pad_id), F.col("n_pad")))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.col("n_pad")))
    return rows.select(*others, padded.alias("input_ids"), mask.alias("attention_mask")).withColumn(
        "labels", F.transform("input_ids", lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x))
    )


def mask_tokens(
    encoded: DataFrame,
    key: str,
    *,
    vocabulary_size: int,
    mask_id: int,
    pad_id: int = 0,
    seed: int = 42,
    share: float = 0.15,
    ids: str = "input_ids",
) -> DataFrame:
    """Masked-token inputs: ``share`` of the positions become targets.

    Of the targets 80 % become the mask id, 10 % a random id and 10 % stay. Draws are
    hashes of (seed, key, position), so they do not depend on the partitioning. Adds
    ``labels`` (-100 except at targets) and ``choices`` (keep, mask, random or same).
    """

    def draw(tag: str, position: Column) -> Column:
        text = F.concat_ws(":", F.lit(tag), F.lit(str(seed)), F.col(key).cast("string"), position.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)

    def choose(x: Column, i: Column) -> Column:
        change = draw("change", i)
        kind = F.when(change < 0.8, F.lit("mask")).when(change < 0.9, F.lit("random")).otherwise(F.lit("same"))
        return F.when((x != pad_id) & (draw("select", i) < share), kind).otherwise(F.lit("keep"))

    def replace(x: Column, i: Column) -> Column:
        choice = F.element_at("choices", i + 1)
        word = F.floor(draw("word", i) * vocabulary_size).cast("int")
        return F.when(choice == "mask", F.lit(mask_id)).when(choice == "random", word).otherwise(x)

    chosen = encoded.withColumn("choices", F.transform(ids, choose))
    labels = F.transform(
        ids, lambda x, i: F.when(F.element_at("choices", i + 1) == "keep", F.lit(IGNORED_LABEL)).otherwise(x)
    )
    return chosen.withColumn("labels", labels).withColumn(ids, F.transform(ids, replace))
