"""A count-based bigram model: counts, losses, perplexity and next-token candidates.

The loss of a pair, -ln((n(a, b) + alpha) / (n(a) + alpha * V)), is a difference of a
term of the pair and a term of its context, so losses are summed from combined counts:
one row per pair and one per context. Whole splits need no join at all, since one pass
counts each pair in every split side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ordering import EXACT, MERGE_WIDTH, Running, key_ranges, with_running
from corpusloom.operators.windows import (
    WINDOW_LENGTH,
    WINDOW_STRIDE,
    check_windows,
    window_of,
)
from corpusloom.session import materialize

# Sampling settings of the candidate filter.
TEMPERATURE = 1.0
TOP_K = 50
TOP_P = 0.95
#: Decimal places to which shares are compared with ``top_p`` where weights are not whole numbers.
SHARE_PLACES = 12
#: Names the group of a split's first window.
FIRST = ":first window"


def token_pairs(tokenized: DataFrame, keep: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """Each token with the one after it, inside one text: ``(token, next_token)``."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    left, right = F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n)
    zipped = tokenized.select(*keep, left.alias("token"), right.alias("next_token"))
    return zipped.select(*keep, F.explode(F.arrays_zip("token", "next_token")).alias("pair")).select(*keep, "pair.*")


def pair_counts(pairs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*keep, "token", "next_token").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class BigramModel:
    """Counts of a training text: its pairs, and how often each token is a context."""

    pairs: DataFrame
    contexts: DataFrame
    alpha: float = 1.0

    def vocabulary_size(self) -> Column:
        """Distinct right-hand tokens and one for unknown ones."""
        targets = self.pairs.select("next_token").distinct()
        return targets.agg((F.count(F.lit(1)) + 1).alias("v")).scalar()


def train_bigrams(tokenized: DataFrame, alpha: float = 1.0) -> BigramModel:
    """Count the training text once and write both tables of counts.

    Joins read them straight from the scan, which adaptive execution needs to split a
    join partition that one frequent token makes too large.
    """
    pairs = materialize(pair_counts(token_pairs(tokenized)))
    contexts = materialize(pairs.groupBy("token").agg(F.sum("n").alias("n")))
    return BigramModel(pairs, contexts, alpha)


def _known(counts: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add ``_model``: the training count of each row, 0 if unseen.

    ``table`` has one row per key and grows with the text, so it is never broadcast. If
    many rows of ``counts`` share a key, adaptive execution splits that key's partition
    and reads the single matching row for each part.
    """
    known = table.withColumnRenamed("n", "_model").hint("merge")
    return counts.join(known, list(on), "left").withColumn("_model", F.coalesce("_model", F.lit(0)))


def bigram_losses(counts: DataFrame, model: BigramModel, group_by: Sequence[str]) -> DataFrame:
    """Summed loss per group: ``(group, n_pairs, n_targets, nll)``.

    ``counts`` holds ``(group, token, next_token, n)``, already combined per group. A
    target without a predecessor (``token`` is NULL) has no loss.
    """
    groups = list(group_by)
    scored = F.when(F.col("token").isNotNull(), F.col("n"))
    of_pairs = _known(counts, model.pairs, ["token", "next_token"]).select(
        *groups,
        F.col("n").alias("n_targets"),
        scored.alias("n_pairs"),
        (-scored * F.log(F.col("_model") + F.lit(float(model.alpha)))).alias("part"),
    )
    contexts = counts.where(F.col("token").isNotNull()).groupBy(*groups, "token").agg(F.sum("n").alias("n"))
    smoothing = F.lit(float(model.alpha)) * F.col("_v")
    of_contexts = (
        _known(contexts, model.contexts, ["token"])
        .withColumn("_v", model.vocabulary_size())
        .select(*groups, (F.col("n") * F.log(F.col("_model") + smoothing)).alias("part"))
    )
    return (
        of_pairs.unionByName(of_contexts, allowMissingColumns=True)
        .groupBy(*groups)
        .agg(F.sum("n_pairs").alias("n_pairs"), F.sum("n_targets").alias("n_targets"), F.sum("part").alias("nll"))
    )


def split_pair_counts(tokenized: DataFrame, splits: Sequence[str], split: str = "split") -> DataFrame:
    """How often each pair occurs in each of ``splits``: one column per split, one pass."""
    counts = [F.count_if(F.col(split) == name).alias(name) for name in splits]
    return token_pairs(tokenized, [split]).groupBy("token", "next_token").agg(*counts)


def _sums_by_split(
    counts: DataFrame, held_out: Sequence[str], loss: Callable[[Column], Column], with_pairs: bool
) -> DataFrame:
    """One row per split: the number of pairs and the sum of ``loss`` of their counts."""
    pairs = F.sum if with_pairs else lambda _: F.lit(0).cast("bigint")
    sums = [
        F.struct(F.lit(name).alias("split"), pairs(name).alias("n_pairs"), F.sum(loss(F.col(name))).alias("nll"))
        for name in held_out
    ]
    return counts.agg(F.array(*sums).alias("sums")).select(F.inline("sums"))


def split_losses(
    counts: DataFrame, held_out: Sequence[str], *, train: str = "train", alpha: float = 1.0
) -> DataFrame:
    """Summed bigram loss of each held-out split: ``(split, n_pairs, nll)``.

    ``counts`` comes from :func:`split_pair_counts` and is read several times, so it
    should be a written table.
    """
    smoothing = F.lit(float(alpha))
    contexts = counts.groupBy("token").agg(*[F.sum(name).alias(name) for name in (train, *held_out)])
    contexts = contexts.withColumn("_v", _split_vocabulary(counts, train))
    of_pairs = _sums_by_split(counts, held_out, lambda n: -n * F.log(F.col(train) + smoothing), True)
    of_contexts = _sums_by_split(contexts, held_out, lambda n: n * F.log(F.col(train) + smoothing * F.col("_v")), False)
    whole = of_pairs.unionByName(of_contexts).groupBy("split")
    return whole.agg(F.sum("n_pairs").alias("n_pairs"), F.sum("nll").alias("nll"))


def split_unigram_losses(counts: DataFrame, held_out: Sequence[str], *, train: str = "train") -> DataFrame:
    """The same for a model that ignores the context: -ln((n(b) + 1) / (N + V))."""
    total = counts.agg(F.coalesce(F.sum(train), F.lit(0)).alias("n")).scalar()
    targets = counts.groupBy("next_token").agg(*[F.sum(name).alias(name) for name in (train, *held_out)])
    targets = targets.withColumn("_whole", (total + _split_vocabulary(counts, train)).cast("double"))
    return _sums_by_split(targets, held_out, lambda n: n * (F.log("_whole") - F.log(F.col(train) + 1)), True)


def _split_vocabulary(counts: DataFrame, train: str) -> Column:
    targets = counts.where(F.col(train) > 0).select("next_token").distinct()
    return targets.agg((F.count(F.lit(1)) + 1).alias("v")).scalar()


def perplexity(losses: DataFrame, *keep: str) -> DataFrame:
    """Mean loss and its exponential; an infinite value becomes NULL."""
    loss = F.col("nll") / F.nullif(F.col("n_pairs"), F.lit(0))
    value = F.exp("loss")
    return losses.select(*keep, "n_pairs", loss.alias("loss")).withColumn(
        "perplexity", F.when(value < float("inf"), value)
    )


def named_metrics(scores: DataFrame, prefixes: dict[str, str], split: str = "split") -> DataFrame:
    """One ``(metric, value)`` row per score, named after the prefix of its split."""
    prefix = F.coalesce(*[F.when(F.col(split) == name, F.lit(short)) for name, short in prefixes.items()], split)
    values = F.map_from_arrays(
        F.array(F.lit("loss"), F.lit("perplexity")), F.array(F.col("loss"), F.col("perplexity"))
    )
    return scores.select(prefix.alias("_prefix"), F.explode(values)).select(
        F.concat_ws("_", "_prefix", "key").alias("metric"), "value"
    )


def compare_with_baseline(scores: DataFrame, baseline: DataFrame, on: Sequence[str]) -> DataFrame:
    """Difference and relative improvement (percent); NULL where the baseline is missing."""
    other = baseline.select(*on, F.col("perplexity").alias("baseline"))
    ours, theirs = F.col("perplexity"), F.col("baseline")
    return scores.join(other, list(on), "left").select(
        *on,
        "perplexity",
        "baseline",
        (ours - theirs).alias("difference"),
        ((1 - ours / theirs) * 100).alias("relative_improvement"),
    )


def scored_pairs(
    tokenized: DataFrame,
    order_by: Sequence[str],
    *,
    length: int = WINDOW_LENGTH,
    stride: int = WINDOW_STRIDE,
    split: str = "split",
    tokens: str = "tokens",
) -> DataFrame:
    """Every token of a split with its predecessor and the window that scores it.

    The texts of a split are one sequence: the first token of a text follows the last
    one of the text before it. Only the first token of a split has no predecessor.
    """
    check_windows(length, stride)
    order = [split, *order_by]
    texts = tokenized.select(*order, F.col(tokens).alias("tokens"))
    wide = texts.withColumn("n_tokens", F.size("tokens").cast("bigint"))
    wide = wide.withColumn("_last", F.get("tokens", F.size("tokens") - 1))
    narrow = materialize(wide.select(*order, "n_tokens", "_last"))
    placed = with_running(
        wide,
        order,
        {"token_start": Running("sum", F.col("n_tokens")), "_before": Running("last", F.col("_last"))},
        group_by=[split],
        range_of_row=key_ranges(narrow, order).range_of_key(),
        totals_of=narrow,
    )
    kept = F.greatest(F.size("tokens") - 1, F.lit(0))
    previous = F.concat(F.array("_before"), F.slice("tokens", F.lit(1), kept))
    placed = placed.select(split, "token_start", previous.alias("token"), F.col("tokens").alias("next_token"))
    pairs = placed.select(split, "token_start", F.posexplode(F.arrays_zip("token", "next_token")).alias("at", "pair"))
    window = window_of(F.col("token_start") + F.col("at"), length, stride)
    scored = pairs.select(split, window.alias("window"), "pair.token", "pair.next_token")
    return scored.where(F.col("next_token").isNotNull())


def _window_pairs(
    tokenized: DataFrame, held_out: Sequence[str], order_by: Sequence[str], length: int, split: str
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(group, token, next_token, n)`` of all pairs, and ``(split, n_tokens)``.

    Groups are the splits, and one more for the first window of each held-out split; its
    pairs are taken out of the split again by rows with n = -1.
    """
    order = [split, *order_by]
    texts = tokenized.select(*order, "tokens").where(F.size("tokens") > 0)
    scored = texts.where(F.col(split).isin(*held_out))
    ends = materialize(
        scored.select(
            *order,
            F.size("tokens").cast("bigint").alias("n_tokens"),
            F.get("tokens", F.lit(0)).alias("first"),
            F.get("tokens", F.size("tokens") - 1).alias("last"),
        )
    )
    placed = with_running(
        ends,
        order,
        {"token_start": Running("sum", F.col("n_tokens")), "before": Running("last", F.col("last"))},
        group_by=[split],
        range_of_row=key_ranges(ends, order).range_of_key(),
    )
    placed = materialize(placed.select(*order, "first", "token_start", "before"))
    inside = token_pairs(texts, [split]).select(F.col(split).alias("group"), "token", "next_token", F.lit(1).alias("n"))
    borders = placed.where("before IS NOT NULL").select(
        F.col(split).alias("group"),
        F.col("before").alias("token"),
        F.col("first").alias("next_token"),
        F.lit(1).alias("n"),
    )
    # At most ``length`` texts of a split reach into its first window. One key per split
    # finds them, so that no other text is tokenized for this.
    opening = placed.where(F.col("token_start") < length).select(*order, "token_start", "before")
    last = opening.groupBy(split).agg(F.to_json(F.max(F.struct(*order_by)), EXACT).alias("key")).collect()
    kind = placed.select(*order_by).schema
    reached = F.lit(False)
    for row in last:
        cut = F.from_json(F.lit(row["key"]), kind, EXACT)
        reached |= (F.col(split) == row[split]) & (F.struct(*order_by) <= cut)
    heads = texts.where(reached).join(F.broadcast(opening), order)
    used = F.least(F.size("tokens").cast("bigint"), F.lit(length) - F.col("token_start")).cast("int")
    heads = heads.select(split, F.slice("tokens", F.lit(1), used).alias("next"), "before")
    previous = F.concat(F.array("before"), F.slice("next", F.lit(1), F.size("next") - 1))
    zipped = F.arrays_zip(previous.alias("token"), F.col("next").alias("next_token"))
    heads = heads.select(split, F.explode(zipped).alias("pair")).select(split, "pair.*").where("token IS NOT NULL")
    moved = F.array(
        F.struct(F.concat(split, F.lit(FIRST)).alias("group"), F.lit(1).alias("n")),
        F.struct(F.col(split).alias("group"), F.lit(-1).alias("n")),
    )
    heads = heads.select("token", "next_token", F.inline(moved))
    totals = ends.groupBy(split).agg(F.sum("n_tokens").alias("n_tokens"))
    return inside.unionByName(borders).unionByName(heads), totals


def window_perplexity(
    tokenized: DataFrame,
    held_out: Sequence[str],
    order_by: Sequence[str],
    *,
    train: str = "train",
    alpha: float = 1.0,
    length: int = WINDOW_LENGTH,
    stride: int = WINDOW_STRIDE,
    split: str = "split",
) -> DataFrame:
    """Sliding-window perplexity of held-out splits: ``(split, n_tokens, perplexity)``.

    A window's mean loss times its number of targets is the sum of its losses, but for the
    first window of a split, which has a target without a predecessor. So pairs need no
    windows: those inside texts are counted without any order, those across texts come
    from a narrow table, and the first window of each split, which a few texts fill, is
    counted apart. All counts stand side by side in one table, so they need no join.
    """
    check_windows(length, stride)
    pairs, totals = _window_pairs(tokenized, held_out, order_by, length, split)
    names = [*held_out, *(f"{name}{FIRST}" for name in held_out)]
    sums = [F.sum(F.when(F.col("group") == name, F.col("n")).otherwise(0)).alias(name) for name in (train, *names)]
    counts = materialize(pairs.groupBy("token", "next_token").agg(*sums))
    first = F.col("split").endswith(FIRST)
    losses = split_losses(counts, names, train=train, alpha=alpha).select(
        F.when(first, F.expr(f"left(split, length(split) - {len(FIRST)})")).otherwise(F.col("split")).alias(split),
        *[F.when(first, F.col(c)).alias(f"first_{c}") for c in ("nll", "n_pairs")],
        *[F.when(~first, F.col(c)).alias(f"rest_{c}") for c in ("nll", "n_pairs")],
    )
    both = losses.unionByName(totals, allowMissingColumns=True)
    both = both.groupBy(split).agg(*[F.sum(c).alias(c) for c in both.columns if c != split])
    targets = F.least(F.col("n_tokens"), F.lit(length))
    opening = F.when(F.col("first_n_pairs") > 0, F.col("first_nll") / F.col("first_n_pairs") * targets)
    rest = F.when(F.col("rest_n_pairs") > 0, F.col("rest_nll")).otherwise(0.0)
    value = F.exp((opening + rest) / F.col("n_tokens"))
    scored = both.where("n_tokens > 0").select(split, "n_tokens", value.alias("perplexity"))
    return scored.withColumn("perplexity", F.when(F.col("perplexity") < float("inf"), F.col("perplexity")))


def window_perplexity_of_losses(
    losses: DataFrame,
    *,
    length: int = WINDOW_LENGTH,
    stride: int = WINDOW_STRIDE,
    split: str = "split",
) -> DataFrame:
    """The same from any scorer's ``(split, pos, nll)``; NULL where a token has no loss."""
    check_windows(length, stride)
    scored = losses.withColumn("window", window_of(F.col("pos"), length, stride)).groupBy(split, "window")
    sums = scored.agg(F.count("nll").alias("n_pairs"), F.sum("nll").alias("nll"), F.count(F.lit(1)).alias("n_targets"))
    return _weighted(sums, split)


def _weighted(windows: DataFrame, split: str) -> DataFrame:
    """exp of the window means weighted by target length, over all tokens.

    The first window scores one token fewer than its target length, yet has that weight.
    """
    mean = F.col("nll") / F.nullif(F.col("n_pairs"), F.lit(0))
    value = F.exp(F.sum(mean * F.col("n_targets")) / F.sum("n_targets"))
    return (
        windows.groupBy(split)
        .agg(F.sum("n_targets").alias("n_tokens"), value.alias("perplexity"))
        .withColumn("perplexity", F.when(F.col("perplexity") < float("inf"), F.col("perplexity")))
    )


def next_token_candidates(
    pairs: DataFrame,
    *,
    temperature: float = TEMPERATURE,
    top_k: int | None = TOP_K,
    top_p: float = TOP_P,
) -> DataFrame:
    """The tokens that sampling may choose after each context.

    Temperature first, then the ``top_k`` most likely (``None`` or 0: all), then the
    smallest set of them that reaches ``top_p``. ``p`` and ``cum_p`` refer to the
    ``top_k``. Temperature 0 is greedy. At temperature 1 the cut at ``top_p`` is exact; at
    others counts are taken relative to the largest of their context, so that small
    temperatures do not overflow, and shares count as rounded to ``SHARE_PLACES``. With ``top_k`` each task keeps
    that many rows of a context before the shuffle, and the tasks are merged in two steps;
    without it all rows of a context meet in one task.
    """
    if temperature < 0 or (top_k or 0) < 0:
        raise ValueError("temperature and top_k must not be negative")
    if temperature == 0:
        temperature, top_k = 1.0, 1
    kept = pairs.select("token", "next_token", "n", (F.spark_partition_id() % MERGE_WIDTH).alias("_tasks"))
    for group in (["token", "_tasks"], ["token"]) if top_k else (["token"],):
        ordered = Window.partitionBy(*group).orderBy(F.desc("n"), "next_token")
        kept = kept.withColumn("rank", F.row_number().over(ordered))
        kept = kept.where(F.col("rank") <= top_k) if top_k else kept
    context = Window.partitionBy("token")
    # At temperature 1 the weights are whole numbers and the cut compares whole numbers.
    exact = temperature == 1
    weight = F.col("n") if exact else F.pow(F.col("n") / F.max("n").over(context), F.lit(1.0 / temperature))
    kept = kept.withColumn("_weight", weight)
    kept = kept.withColumn("_sum", F.sum("_weight").over(context)).withColumn(
        "_upto", F.sum("_weight").over(Window.partitionBy("token").orderBy("rank"))
    )
    before = F.col("_upto") - F.col("_weight")
    if exact:
        part, whole = Fraction(str(top_p)).as_integer_ratio()
        inside = _whole(before) * _whole(whole) < _whole(F.col("_sum")) * _whole(part)
    else:
        inside = F.round(before / F.col("_sum"), SHARE_PLACES) < top_p
    return kept.where((F.col("rank") == 1) | inside).select(
        "token",
        "next_token",
        "rank",
        (F.col("_weight") / F.col("_sum")).alias("p"),
        (F.col("_upto") / F.col("_sum")).alias("cum_p"),
    )


def _whole(value: Column | int) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("decimal(19,0)")
