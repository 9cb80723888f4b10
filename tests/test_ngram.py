import math
import random
from collections import Counter

import pytest

from corpusloom.operators.ngram import (
    compare_with_baseline,
    next_token_candidates,
    perplexity,
    split_losses,
    split_pair_counts,
    split_unigram_losses,
    train_bigrams,
    window_perplexity,
    window_perplexity_of_losses,
)


def _texts(seed, n, empty=0.2):
    rng = random.Random(seed)
    return [[] if rng.random() < empty else rng.choices("aaaaabcdef", k=rng.randrange(1, 12)) for _ in range(n)]


TRAIN, HELD_OUT = _texts(1, 30), _texts(2, 25)


def _frame(spark, texts, split="test"):
    rows = [(i, split, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "k int, split string, tokens array<string>").repartition(3)


def _inside(texts):
    return [p for t in texts for p in zip(t, t[1:])]


class _Loop:
    """The same model, token by token."""

    def __init__(self, texts):
        pairs = _inside(texts)
        self.pairs, self.contexts = Counter(pairs), Counter(a for a, _ in pairs)
        self.targets = Counter(b for _, b in pairs)
        self.v, self.total = len(self.targets) + 1, len(pairs)

    def loss(self, a, b):
        return -math.log((self.pairs[(a, b)] + 1) / (self.contexts[a] + self.v))

    def unigram(self, b):
        return -math.log((self.targets[b] + 1) / (self.total + self.v))


def test_losses_like_a_loop(spark):
    loop = _Loop(TRAIN)
    held_out = HELD_OUT + [["never", "seen", "a"], ["a", "unseen"]]
    both = _frame(spark, TRAIN, "train").union(_frame(spark, held_out))
    counts = split_pair_counts(both, ["train", "test"])
    pairs = _inside(held_out)
    got = perplexity(split_losses(counts, ["test"]), "split").first()
    expected = sum(loop.loss(a, b) for a, b in pairs) / len(pairs)
    assert (got["n_pairs"], got["loss"]) == (len(pairs), pytest.approx(expected, abs=1e-12))
    assert got["perplexity"] == pytest.approx(math.exp(expected))
    base = perplexity(split_unigram_losses(counts, ["test"]), "split").first()
    assert base["loss"] == pytest.approx(sum(loop.unigram(b) for _, b in pairs) / len(pairs), abs=1e-12)


@pytest.mark.parametrize("length, stride", [(8, 3), (5, 5), (200, 100), (4, 1)])
def test_window_perplexity_like_the_loop(spark, length, stride):
    loop = _Loop(TRAIN)
    sequence = [x for t in HELD_OUT for x in t]
    losses = [None] + [loop.loss(a, b) for a, b in zip(sequence, sequence[1:])]
    n, previous, total = len(sequence), 0, 0.0
    for begin in range(0, n, stride):
        end = min(begin + length, n)
        scored = [x for x in losses[previous:end] if x is not None]
        total += sum(scored) / len(scored) * (end - previous)
        previous = end
        if end == n:
            break
    whole = _frame(spark, TRAIN, "train").unionByName(_frame(spark, HELD_OUT))
    scores = window_perplexity(whole, ["test"], ["k"], length=length, stride=stride)
    assert "Join" not in scores._jdf.queryExecution().executedPlan().toString()
    got = scores.first()
    assert (got["split"], got["n_tokens"]) == ("test", n)
    assert got["perplexity"] == pytest.approx(math.exp(total / n))
    rows = spark.createDataFrame([("test", i, x) for i, x in enumerate(losses)], "split string, pos long, nll double")
    given = window_perplexity_of_losses(rows, length=length, stride=stride).first()
    assert (given["n_tokens"], given["perplexity"]) == (n, pytest.approx(math.exp(total / n)))


def test_corpora_without_pairs(spark):
    train = _frame(spark, TRAIN, "train")
    one = window_perplexity(train.unionByName(_frame(spark, [["a"]])), ["test"], ["k"]).first()
    assert tuple(one) == ("test", 1, None)
    assert window_perplexity(train.unionByName(_frame(spark, [[], []])), ["test"], ["k"]).count() == 0


def test_small_temperature_and_no_limit(spark):
    rows = [("a", "x", 3000), ("a", "y", 2900), ("a", "z", 1)]
    pairs = spark.createDataFrame(rows, "token string, next_token string, n long")
    sharp = next_token_candidates(pairs, temperature=0.01).orderBy("rank").collect()
    weights = [1.0, (2900 / 3000) ** 100]
    assert sharp[0]["p"] == pytest.approx(weights[0] / sum(weights))
    assert next_token_candidates(pairs, top_k=0, top_p=1.0).count() == 3
    assert next_token_candidates(pairs, top_k=None, top_p=1.0).count() == 3
    for wrong in ({"temperature": -1.0}, {"top_k": -1}):
        with pytest.raises(ValueError, match="negative"):
            next_token_candidates(pairs, **wrong)


def test_missing_baseline_gives_null(spark):
    ours = spark.createDataFrame([("test", 50.0), ("validation", 30.0)], "split string, perplexity double")
    other = spark.createDataFrame([("test", 40.0)], "split string, perplexity double")
    got = {r["split"]: tuple(r)[1:] for r in compare_with_baseline(ours, other, ["split"]).collect()}
    assert got == {"test": (50.0, 40.0, 10.0, -25.0), "validation": (30.0, None, None, None)}


@pytest.mark.parametrize("temperature, top_k, top_p", [(1.0, 50, 0.95), (0.5, 3, 0.8), (2.0, 4, 1.0), (0, 50, 0.95)])
def test_candidates_like_a_loop(spark, temperature, top_k, top_p):
    counts = Counter(_inside(TRAIN))
    expected = {}
    for token in {a for a, _ in counts}:
        options = sorted(((-n, b) for (a, b), n in counts.items() if a == token))[: 1 if temperature == 0 else top_k]
        weights = [(-n) ** (1 / (temperature or 1)) for n, _ in options]
        reached = 0.0
        for rank, ((_, b), w) in enumerate(zip(options, weights), 1):
            if rank > 1 and reached >= top_p:
                break
            reached += w / sum(weights)
            expected[(token, b)] = (rank, w / sum(weights), reached)
    pairs = train_bigrams(_frame(spark, TRAIN)).pairs
    got = next_token_candidates(pairs, temperature=temperature, top_k=top_k, top_p=top_p).collect()
    assert {(r["token"], r["next_token"]) for r in got} == set(expected)
    for r in got:
        assert (r["rank"], r["p"], r["cum_p"]) == pytest.approx(expected[(r["token"], r["next_token"])])


def test_candidates_that_reach_the_share_exactly(spark):
    """Counts whose first entries are exactly 95 % of their context; the next entry is left out."""
    contexts = {
        "hundred": [25, 23, 22, 25, 3, 2],
        "of_120": [12] * 9 + [6] + [3, 2, 1],
        "twelve": [12, 12, 12, 12, 12, 12, 12, 11, 3, 1, 1],
        "just_below": [12] * 9 + [5] + [4, 2, 1],
    }
    rows = [(token, f"w{i:02}", n) for token, counts in contexts.items() for i, n in enumerate(counts)]
    pairs = spark.createDataFrame(rows, "token string, next_token string, n bigint")
    got = Counter(r["token"] for r in next_token_candidates(pairs).collect())
    for token, counts in contexts.items():
        counts = sorted(counts, reverse=True)
        kept = [i for i in range(len(counts)) if i == 0 or 100 * sum(counts[:i]) < 95 * sum(counts)]
        assert got[token] == len(kept), token
    assert got["hundred"] == 4 and got["of_120"] == 10
