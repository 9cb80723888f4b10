from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.tokens import (
    TokenCodec,
    build_vocabulary,
    decode_preview,
    encode,
    padding_id,
    tokenize,
)


@pytest.fixture(scope="module")
def tokenized(spark):
    lists = [["b", "a", "a"], ["c", "c", "b"], [], ["d"], ["e", "e", "e", "e"]]
    return spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, tokens array<string>")


@pytest.mark.parametrize("size", [2, 3, 4, 6, 7, 50])
def test_vocabulary_is_ordered_by_count_then_token(tokenized, size):
    counts = Counter(t for r in tokenized.collect() for t in r["tokens"])
    ranked = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[: size - 2]
    got = build_vocabulary(tokenized, size).orderBy("id").collect()
    assert [(r["token"], r["id"], r["freq"]) for r in got] == [(t, i + 2, n) for i, (t, n) in enumerate(ranked)]


def test_encode_and_decode(spark, tokenized):
    codec = TokenCodec(build_vocabulary(tokenized, 4))
    rows = encode(tokenized, codec).orderBy("i").collect()
    assert [r["input_ids"] for r in rows] == [[1, 3, 3], [1, 1, 1], [], [1], [2, 2, 2, 2]]
    assert [r["attention_mask"] for r in rows] == [[1, 1, 1], [1, 1, 1], [], [1], [1, 1, 1, 1]]
    shown = decode_preview(encode(tokenized, codec), codec, first_ids=2, characters=12).orderBy("i").collect()
    assert [r["preview"] for r in shown] == ["<unknown> a", "<unknown> <u", "", "<unknown>", "e e"]


def test_encode_null_lists(spark, tokenized):
    codec = TokenCodec(build_vocabulary(tokenized, 10))
    lists = spark.createDataFrame([(0, ["a"]), (1, None), (2, ["e", "zz"])], "i int, tokens array<string>")
    rows = encode(lists.coalesce(1), codec).orderBy("i").collect()
    assert [r["input_ids"] for r in rows] == [[3], [], [2, 1]]


def test_special_names_in_the_text_are_unknown_words(spark, tokenized):
    codec = TokenCodec(build_vocabulary(tokenized, 10))
    lists = spark.createDataFrame([(["<end>", "<unknown>"],)], "tokens array<string>")
    assert encode(lists, codec).first()["input_ids"] == [1, 1]


def test_a_vocabulary_over_the_limit_is_refused(tokenized):
    with pytest.raises(ValueError, match="more than 3 rows"):
        TokenCodec(build_vocabulary(tokenized, 10), limit=3)


def test_tokenize_truncates_and_handles_blanks(spark):
    df = spark.createDataFrame([(0, "a b c d"), (1, "  "), (2, None), (3, "x")], "i int, text string")
    got = tokenize(df, max_length=3, keep=["i"]).orderBy("i").collect()
    assert [(r["i"], r["tokens"]) for r in got] == [(0, ["a", "b", "c"]), (3, ["x"])]
    got = tokenize(df, max_length=3, keep=["i"], skip_blank=False).orderBy("i").collect()
    assert [r["tokens"] for r in got] == [["a", "b", "c"], [], [], ["x"]]
    assert tokenize(df).columns == ["tokens"]


def test_any_column_function_is_a_tokenizer(spark):
    df = spark.createDataFrame([("a-b-c",)], "text string")
    assert tokenize(df, lambda text: F.split(text, "-")).first()["tokens"] == ["a", "b", "c"]


def test_padding_falls_back_to_the_end_id():
    assert (padding_id(None, 0), padding_id(5, 0), padding_id(0, 7)) == (0, 5, 0)
    with pytest.raises(ValueError):
        padding_id(None, None)
