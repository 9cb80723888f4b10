import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import contains_text, sentence_count, strip, whitespace_tokens, word_tokens
from corpusloom.operators.selection import drop_blank

SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def _python_sentences(text):
    return sum(len(part.strip()) > 10 for part in re.split(r"[.!?]+", text))


def _column(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[0] for r in rows.select(column("text").alias("v"), "i").orderBy("i").collect()]


def test_strip_removes_what_python_removes(spark):
    texts = [f"{s}a{s}b{s}" for s in SPACES] + ["", " ", "​x​", "a\nb"]
    assert _column(spark, texts, strip) == [t.strip() for t in texts]


def test_blank_texts_are_dropped(spark):
    texts = [None, "", " \t\n", "  ", "\x1c\x1f", *SPACES, "​", "x", " \n.\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    kept = {r["i"] for r in drop_blank(rows).collect()}
    assert kept == {i for i, t in enumerate(texts) if t and len(t.strip()) > 0}


def test_contains_text_is_null_for_null(spark):
    assert _column(spark, [None, "a"], contains_text) == [None, True]


def test_sentence_edges(spark):
    texts = [
        "",
        "short. tiny! no?",
        "exactly 10.",
        "exactly 11c.",
        "          spaces          .",
        "a" + " " * 50 + "b. " + "x" * 11,
        "no terminator at all here",
        "...???!!!",
        "one sentence here. another sentence\nover lines! third one is long enough?",
        " " * 12 + "." + "\x1c" * 12,
        "café \U0001f600 你好 abc. ok",
    ]
    assert _column(spark, texts, sentence_count) == [_python_sentences(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n\t \x1c", max_size=60), min_size=40, max_size=40))
def test_sentences_of_any_text(spark, texts):
    assert _column(spark, texts, sentence_count) == [_python_sentences(t) for t in texts]


def test_word_tokens_separate_letters_digits_and_marks(spark):
    text = F.lit("Café no. 12, ok?!")
    assert spark.range(1).select(word_tokens(text)).first()[0] == ["Café", "no", ".", "12", ",", "ok", "?!"]


def test_tokens_end_at_any_unicode_white_space(spark):
    space = ["\u00a0", "\u0085", "\u2003", "\u3000", "\x1c", "\x1f", "\v", " "]
    df = spark.createDataFrame([(f"one{s}two",) for s in space], "text string")
    for tokenizer in (whitespace_tokens, word_tokens):
        assert {tuple(r[0]) for r in df.select(tokenizer("text")).collect()} == {("one", "two")}
