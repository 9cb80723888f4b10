"""Tokens, vocabulary, ids and back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import whitespace_tokens
from corpusloom.operators.selection import drop_blank

Tokenizer = Callable[[Column], Column]

# Size and special ids of the vocabulary.
VOCABULARY_SIZE = 50280
END_ID = 0
UNKNOWN_ID = 1
SPECIAL_TOKENS = ("<end>", "<unknown>")
DEFAULT_MAX_LENGTH = 2048


def padding_id(pad_id: int | None, end_id: int | None) -> int:
    """The padding id, which is the end id if no padding token is set."""
    chosen = end_id if pad_id is None else pad_id
    if chosen is None:
        raise ValueError("neither a padding id nor an end id is set")
    return chosen


def tokenize(
    df: DataFrame,
    tokenizer: Tokenizer = whitespace_tokens,
    *,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    text: str = "text",
    keep: Sequence[str] = (),
    skip_blank: bool = True,
) -> DataFrame:
    """Replace the source columns by ``tokens``, cut to the first ``max_length``.

    ``keep`` names the columns (order key, split) to carry along. ``max_length=None``
    keeps whole texts. ``skip_blank=False`` turns blank texts into empty arrays.
    """
    rows = drop_blank(df, text) if skip_blank else df
    tokens = tokenizer(F.col(text) if skip_blank else F.coalesce(F.col(text), F.lit("")))
    return rows.select(*keep, (tokens if max_length is None else F.slice(tokens, 1, max_length)).alias("tokens"))


def explode_tokens(tokenized: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row per token.

    A plain explode makes the optimizer add a size filter on the array and push it below
    the projection, which tokenizes the text a second and a third time. The outer form
    does not; the NULL it gives for an empty array is dropped here.
    """
    return tokenized.select(F.explode_outer(tokens).alias("token")).where(F.col("token").isNotNull())


def build_vocabulary(tokenized: DataFrame, size: int = VOCABULARY_SIZE, tokens: str = "tokens") -> DataFrame:
    """The most frequent tokens with ids: ``(token, id, freq)``, ``size`` counting the special ids.

    Counts are combined before the shuffle, so a frequent token costs one row per task.
    Only tokens at least as frequent as the power of two that still leaves ``size`` of
    them reach the final sort, and only the kept ones are numbered.
    """
    wanted = size - len(SPECIAL_TOKENS)
    counts = explode_tokens(tokenized, tokens).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    binary_digits = F.length(F.bin("freq"))
    levels = counts.groupBy(binary_digits.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    # At most 64 levels, so one task numbers them.
    reached = levels.select("level", F.sum("n").over(Window.orderBy(F.desc("level"))).alias("reached"))
    lowest = reached.agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("level"))), F.lit(0)))
    counts = counts.where(binary_digits >= lowest.scalar())
    kept = counts.orderBy(F.desc("freq"), "token").limit(wanted)
    ordered = Window.orderBy(F.desc("freq"), "token")
    rank = F.row_number().over(ordered)
    return kept.select("token", (rank + len(SPECIAL_TOKENS) - 1).cast("int").alias("id"), "freq")


class TokenCodec:
    """Encodes token arrays to ids and back with a vocabulary of bounded size.

    The vocabulary is the only thing that reaches the driver, and at most ``limit`` rows
    of it. Lookups run on Arrow arrays inside the tasks: no token is exploded or shuffled.
    """

    def __init__(self, vocabulary: DataFrame, limit: int = VOCABULARY_SIZE):
        rows = vocabulary.select("id", "token").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"the vocabulary has more than {limit} rows")
        names = dict(rows)
        self.size = max(names, default=UNKNOWN_ID) + 1
        listed = [names.get(i) for i in range(self.size)]
        listed[: len(SPECIAL_TOKENS)] = SPECIAL_TOKENS
        shared = vocabulary.sparkSession.sparkContext.broadcast(listed)

        def encode(tokens: pa.Array) -> pa.Array:
            known = pa.array(shared.value[len(SPECIAL_TOKENS) :], pa.string())
            place = pc.index_in(tokens.flatten(), value_set=known)
            ids = pc.fill_null(pc.add(place, len(SPECIAL_TOKENS)), UNKNOWN_ID)
            return _same_lists(tokens, ids.cast(pa.int32()))

        def decode(ids: pa.Array) -> pa.Array:
            return _same_lists(ids, pa.array(shared.value, pa.string()).take(ids.flatten()))

        self._encode = F.arrow_udf(encode, "array<int>")
        self._decode = F.arrow_udf(decode, "array<string>")

    def encode(self, tokens: Column | str) -> Column:
        return self._encode(tokens)

    def decode(self, ids: Column | str) -> Column:
        return self._decode(ids)


def _same_lists(lists: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` cut into lists like ``lists``."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int64())
    ends = pc.cumulative_sum(lengths).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, values)


def encode(tokenized: DataFrame, codec: TokenCodec, tokens: str = "tokens") -> DataFrame:
    """Replace ``tokens`` by ``input_ids`` and ``attention_mask``."""
    others = [name for name in tokenized.columns if name != tokens]
    return tokenized.select(*others, codec.encode(tokens).alias("input_ids")).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))
    )


def decode_preview(encoded: DataFrame, codec: TokenCodec, first_ids: int = 100, characters: int = 200) -> DataFrame:
    """Add ``preview``: the first ids as text, cut to ``characters``."""
    words = codec.decode(F.slice("input_ids", 1, first_ids))
    return encoded.withColumn("preview", F.substring(F.array_join(words, " "), 1, characters))
