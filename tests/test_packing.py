import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.packing import collate, mask_tokens, pack_batches, pack_splits


def _python_blocks(lists, block):
    joined = [x for ids in lists for x in ids]
    used = len(joined) - len(joined) % block if len(joined) >= block else len(joined)
    return [joined[i : i + block] for i in range(0, used, block)]


def _encoded(spark, lists, splits=("train",), parts=4):
    rows = [(i * 3, splits[i % len(splits)], ids) for i, ids in enumerate(lists)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "k long, split string, input_ids array<int>").repartition(parts)


def _lists(lengths):
    counter = iter(range(1, 10**6))
    return [[next(counter) for _ in range(n)] for n in lengths]


LENGTHS = [
    [3, 0, 5, 2, 1, 1, 4, 30, 0, 2, 7],
    [1],
    [0, 0],
    [8, 8, 8],
    [2, 2, 3],
    [25],
]


@pytest.mark.parametrize("lengths", LENGTHS)
@pytest.mark.parametrize("batch_rows", [1, 3, 100])
def test_batches_pack_like_a_loop(spark, lengths, batch_rows):
    lists, block = _lists(lengths), 8
    expected = {}
    for b in range(0, len(lists), batch_rows):
        for i, ids in enumerate(_python_blocks(lists[b : b + batch_rows], block)):
            expected[(b // batch_rows, i)] = ids
    got = pack_batches(_encoded(spark, lists), ["k"], batch_rows=batch_rows, block_size=block).collect()
    assert {(r["batch"], r["block"]): r["input_ids"] for r in got} == expected
    assert all(r["labels"] == r["input_ids"] and r["attention_mask"] == [1] * len(r["input_ids"]) for r in got)


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_splits_pack_like_a_loop(spark, parts):
    rng = random.Random(parts)
    lists, splits, block = _lists([rng.randrange(20) for _ in range(60)]), ("train", "test", "validation"), 16
    expected = {
        (name, i): ids
        for s, name in enumerate(splits)
        for i, ids in enumerate(_python_blocks(lists[s::3], block))
    }
    got = pack_splits(_encoded(spark, lists, splits, parts), ["k"], block_size=block).collect()
    assert {(r["split"], r["block"]): r["input_ids"] for r in got} == expected


def test_a_split_that_is_not_listed_is_an_error(spark):
    with pytest.raises(Exception, match="split is not listed: dev"):
        pack_splits(_encoded(spark, _lists([3, 4]), ("train", "dev")), ["k"], block_size=4).collect()


@pytest.mark.parametrize("multiple", [8, None])
def test_collate_pads_to_the_longest_row(spark, multiple):
    lists = [[5, 0, 7], [1] * 9, [], [2] * 8, [3]]
    rows = collate(_encoded(spark, lists), ["k"], batch_size=2, multiple=multiple).orderBy("k").collect()
    widths = [16, 16, 8, 8, 8] if multiple else [9, 9, 8, 8, 1]
    assert [r["width"] for r in rows] == widths
    assert [r["batch_id"] for r in rows] == [0, 0, 1, 1, 2]
    for ids, width, r in zip(lists, widths, rows):
        pad = width - len(ids)
        assert r["n_pad"] == pad
        assert r["input_ids"] == ids + [0] * pad
        assert r["attention_mask"] == [1] * len(ids) + [0] * pad
        # A genuine end token has the padding id, so it is masked as well.
        assert r["labels"] == [-100 if x == 0 else x for x in r["input_ids"]]


def test_masking_is_reproducible_and_near_its_shares(spark):
    df = _encoded(spark, [[7] * 500 + [0] * 20 for _ in range(40)])

    def masked(d):
        return mask_tokens(d, "k", vocabulary_size=50, mask_id=99).orderBy("k").collect()

    rows = masked(df)
    assert rows == masked(df.repartition(1))
    choices = [c for r in rows for c in r["choices"][:500]]
    assert all(c == "keep" for r in rows for c in r["choices"][500:])
    chosen = [c for c in choices if c != "keep"]
    assert 0.13 < len(chosen) / len(choices) < 0.17
    assert 0.77 < chosen.count("mask") / len(chosen) < 0.83
    assert 0.08 < chosen.count("random") / len(chosen) < 0.12
    for r in rows:
        for choice, x, label in zip(r["choices"], r["input_ids"], r["labels"]):
            assert label == (-100 if choice == "keep" else 7)
            if choice == "mask":
                assert x == 99
            elif choice in ("keep", "same"):
                assert x in (7, 0)


def test_packing_shuffles_the_ids_once(spark):
    df = _encoded(spark, _lists([3, 5, 9, 20]))
    plan = pack_batches(df, ["k"], batch_rows=2, block_size=4)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) == 1


def test_blocks_keep_every_token_in_order(spark):
    lists = _lists([5, 11, 2, 14])
    got = pack_batches(_encoded(spark, lists), ["k"], batch_rows=4, block_size=8).orderBy("batch", "block")
    assert [x for r in got.collect() for x in r["input_ids"]] == list(range(1, 33))
    assert got.where(F.size("input_ids") != 8).count() == 0
