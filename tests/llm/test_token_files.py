import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from corpusloom.llm import token_files  # noqa: E402
from corpusloom.llm.queries import op1_token_files, tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, key string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def reference():
    """The library as it comes: special tokens in texts keep their own ids."""
    made = tokenizers.Tokenizer.from_file(tokenizer_path())
    return lambda text: [*made.encode(text or "", add_special_tokens=False).ids, 0]


def expected(rows, encode):
    start, out = 0, []
    for key, text in rows:
        ids = np.array(encode(text), "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def found(df):
    return sorted(((r["key"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=lambda r: r[1])


def test_vbyte_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 1 << 32, n, np.uint64) >> rng.integers(0, 32, n, np.uint64)).astype("<u4")
        control, data = token_files.vbyte_encode(values)
        assert len(control) == -(-n // 4)
        assert (token_files.vbyte_decode(control, data, n) == values).all()


def test_words_give_the_ids_of_whole_texts(reference):
    parts = ["a", "word", " ", "  ", "\n", "\t", " \n", "é", "Ñ", "1", "23", "!", "...", "'s", "'ll", "_", "\xa0", "\x85",
             "漢", "ɏ", "ª", "\x1c", "\r\n", "$", "²", "<|endoftext|>", "’"]
    random.seed(2)
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(5000)]
    cache = token_files.WordCache(tokenizer_path())
    for text, ids in zip(texts, cache.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference(text)[:-1], repr(text)


def test_words_met_again_are_not_merged_again(reference):
    """A word of every batch stays remembered, however many others come; with signs after it it is the same word."""
    cache = token_files.WordCache(tokenizer_path(), remembered_words=40)
    learned, merge = [], cache._learn
    cache._learn = lambda words: (learned.extend(words), merge(words))
    rng = random.Random(2)
    for i in range(12):
        others = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz\u00e9", k=9)) for _ in range(30)]
        text = f"start often, {' '.join(others)} often. don't (often) often-{others[0]} \u00c9often_, often7! end"
        assert list(np.frombuffer(cache.encode([text])[0], "<u4")) == reference(text)[:-1]
        assert len(cache.ids) + len(cache.former) <= 2 * (20 + 50)
    assert learned.count(" often") == 1
    assert not any(word.startswith(" often") and word[6:] for word in cache.ids if word[6:7] in {",", "."})


def test_special_tokens_may_be_read_as_text():
    made = tokenizers.Tokenizer.from_file(tokenizer_path())
    made.encode_special_tokens = True
    texts = ["one <|endoftext|> two", "<|endoftext|>", "plain"]
    for special_as_text, library in ((True, made), (False, tokenizers.Tokenizer.from_file(tokenizer_path()))):
        found = token_files.WordCache(tokenizer_path(), special_as_text).encode(texts)
        plain = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == plain
    assert np.frombuffer(found[0], "<u4").tolist() == [505, 220, 50256, 734]


def test_whole_table(spark, small_dir, documents, reference):
    rows = op1_token_files(spark, small_dir).collect()
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert got == expected(sorted(documents), reference)


@pytest.mark.parametrize("file_ids", [3, 1 << 25])
def test_nulls_ties_repeats_and_clashing_names(spark, reference, file_ids):
    rows = [(2, "b b"), (1, None), (2, "b b"), (5, ""), (None, "no key"), (2, "a much longer text"), (9, "漢字 " * 50)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = found(token_files.tokenize_to_files(df, tokenizer_path(), file_ids=file_ids))
    order = [(None, "no key"), (1, None), (2, "b b"), (2, "b b"), (2, "a much longer text"), (5, ""), (9, "漢字 " * 50)]
    assert got == expected(order, reference)


def test_long_text_and_loader(spark, reference, tmp_path):
    text = "lorem ipsum dolor " * 40_000
    df = spark.createDataFrame([(1, text), (2, "end")], "doc_id long, text string")
    encode = token_files.bytes_encoder(tokenizer_path())
    encoded = token_files.encode_documents(df, encode)
    files = token_files.write_token_files(encoded, f"file://{tmp_path}/t")
    loaded = list(token_files.read_ids([r["file"] for r in files.orderBy("index").collect()]))
    assert [(k, ids.tolist()) for k, ids in loaded] == [(1, reference(text)), (2, reference("end"))]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.tokenize_to_files(df, tokenizer_path()).count() == 0
