import math
import random
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.operators.ngram import window_perplexity_of_losses
from corpusloom.operators.scoring import scored_losses


def _docs(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["test", "validation"]), i, [rng.randrange(50) for _ in range(rng.choice([0, 1, 1, 2, 9, 40]))]) for i in range(n)]


def _frame(spark, docs):
    return spark.createDataFrame(docs, "split string, k int, input_ids array<int>").repartition(5)


def remembering(context):
    """A scorer whose losses tell all that it was shown."""

    def score(before, ids):
        assert len(before) <= context
        seen = np.concatenate([before, ids])
        at = len(before) + np.arange(len(ids))
        return np.array([np.nan if i == 0 else float(sum(seen[max(0, i - context) : i] * 3) + seen[i]) for i in at])

    return score


def plain(docs, context):
    found = {}
    for split in {d[0] for d in docs}:
        ids = [x for s, _, ids in sorted(docs, key=lambda d: d[1]) if s == split for x in ids]
        for i, x in enumerate(ids):
            found[split, i] = float(sum(y * 3 for y in ids[max(0, i - context) : i]) + x) if i else None
    return found


@pytest.mark.parametrize("context", [1, 3, 17])
@pytest.mark.parametrize("partitions", ["1", "7"])
def test_context_goes_over_borders_of_texts_and_tasks(spark, context, partitions):
    docs = _docs(context, 120)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        losses = scored_losses(_frame(spark, docs), remembering(context), ["k"], context=context)
        found = {(r["split"], r["pos"]): r["nll"] for r in losses.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == plain(docs, context)


def test_no_context_and_empty_tables(spark):
    docs = _docs(1, 20)
    losses = scored_losses(_frame(spark, docs), lambda before, ids: ids * 1.0, ["k"], context=0).collect()
    assert len(losses) == sum(len(d[2]) for d in docs)
    assert scored_losses(_frame(spark, []), remembering(1), ["k"], context=1).count() == 0
    assert scored_losses(_frame(spark, [("test", 1, []), ("test", 2, None)]), remembering(1), ["k"], context=1).count() == 0


def test_a_scorer_must_score_every_id(spark):
    docs = _frame(spark, [("test", 1, [1, 2, 3])])
    with pytest.raises(Exception, match="the scorer gave"):
        scored_losses(docs, lambda before, ids: np.zeros(2), ["k"], context=1).collect()


def test_losses_make_a_window_perplexity(spark):
    docs = [(s, k, ids) for s, k, ids in _docs(3, 60)]
    losses = scored_losses(_frame(spark, docs), remembering(2), ["k"], context=2)
    scaled = losses.withColumn("nll", losses.nll / 100)
    got = {r["split"]: r["perplexity"] for r in window_perplexity_of_losses(scaled, length=32, stride=8).collect()}
    for split in got:
        nll = [v for (s, _), v in sorted(plain(docs, 2).items()) if s == split]
        total, end = 0.0, 0
        windows = defaultdict(list)
        for begin in range(0, len(nll), 8):
            last = min(begin + 32, len(nll))
            windows[begin], end = (end, last), last
            if last == len(nll):
                break
        for first, last in windows.values():
            scored = [x / 100 for x in nll[first:last] if x is not None]
            total += sum(scored) / len(scored) * (last - first) if scored else 0.0
        assert math.isclose(got[split], math.exp(total / len(nll)), rel_tol=1e-9)
