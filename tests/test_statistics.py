import pytest

from corpusloom.operators.statistics import head_statistics, sentence_estimate, split_metrics


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(i, "train", [1] * (i + 1)) for i in range(5)] + [(9, "test", [1, 1]), (8, "test", [])]
    return spark.createDataFrame(rows, "k int, split string, input_ids array<int>")


def test_an_empty_split_still_appears(encoded):
    got = {r["split"]: tuple(r)[1:] for r in split_metrics(encoded).collect()}
    assert got == {
        "train": (5, 3.0, 1, 5, 15),
        "validation": (0, None, None, None, None),
        "test": (2, 1.0, 0, 2, 2),
    }


def test_head_statistics_use_the_first_rows(spark):
    rows = [(i, "train", "a " * (i + 1)) for i in range(5)] + [(9, "test", "b c"), (8, "test", "d" * 300), (7, "test", " ")]
    df = spark.createDataFrame(rows, "k int, split string, text string")
    got = {r["split"]: tuple(r)[1:] for r in head_statistics(df, ["k"], rows=3).collect()}
    assert got == {
        "train": (5, 2.0, 1, "a"),
        "validation": (0, None, None, None),
        "test": (2, 1.5, 1, "d" * 200),
    }


def test_head_statistics_tokenize_behind_a_key_filter(spark, tmp_path):
    rows = [(i, "train", "a b") for i in range(50)]
    spark.createDataFrame(rows, "k int, split string, text string").write.parquet(f"{tmp_path}/t")
    found = head_statistics(spark.read.parquet(f"{tmp_path}/t"), ["k"], rows=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("PushedFilters" in line and "LessThanOrEqual(k,2)" in line for line in plan.splitlines())


def test_estimate_divides_by_the_rows_read(spark):
    text = "a sentence of words. another sentence here."
    df = spark.createDataFrame([(i, text) for i in range(6)], "k int, text string")
    columns = ["sample_size", "sentences", "avg_per_example", "total_examples", "estimated_total"]
    assert sentence_estimate(df, ["k"], sample_size=4).select(columns).first() == (4, 8, 2.0, 6, 12.0)
    assert sentence_estimate(df, ["k"], sample_size=12).select(columns).first() == (6, 12, 2.0, 6, 12.0)
    original = sentence_estimate(df, ["k"], sample_size=12, reference_divisor=True)
    assert original.select(columns).first() == (12, 12, 1.0, 6, 6.0)
    assert sentence_estimate(df.limit(0), ["k"]).select(columns).first() == (0, 0, None, 0, None)
