import pytest

from corpusloom.operators.windows import corpus_positions, sliding_windows, window_targets

CASES = [(1, 4, 2), (4, 4, 2), (5, 4, 2), (6, 4, 4), (9, 4, 3), (30, 8, 3), (31, 10, 10), (12, 20, 5), (17, 7, 1)]


def _loop(n, length, stride):
    windows, previous = [], 0
    for begin in range(0, n, stride):
        end = min(begin + length, n)
        windows.append((begin, end, end - previous))
        previous = end
        if end == n:
            break
    return windows


def _positions(spark, n):
    sizes, k = [], 0
    while n:
        sizes.append((k, "train", min(n, 1 + k % 4)))
        n -= sizes[-1][2]
        k += 1
    lengths = spark.createDataFrame(sizes, "k long, split string, n_tokens long")
    return corpus_positions(lengths, ["k"], split="split")


@pytest.mark.parametrize("n, length, stride", CASES)
def test_windows_like_the_loop(spark, n, length, stride):
    positions = _positions(spark, n)
    windows = sliding_windows(positions, length=length, stride=stride).orderBy("begin").collect()
    expected = _loop(n, length, stride)
    assert [(r["begin"], r["end"], r["trg_len"]) for r in windows] == expected
    assert sum(r["trg_len"] for r in windows) == n
    targets = window_targets(positions, length=length, stride=stride).orderBy("window").collect()
    assert [(r["window"], r["first_target"], r["last_target"], r["n_targets"]) for r in targets] == [
        (i, end - scored, end - 1, scored) for i, (_, end, scored) in enumerate(expected)
    ]


def test_a_stride_beyond_the_length_is_refused(spark):
    with pytest.raises(ValueError, match="unscored"):
        sliding_windows(_positions(spark, 5), length=2, stride=3)
