import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import token_alignment as ta
from corpusloom.llm.queries import op13_token_alignment, tokenizer_path

PATH_A, PATH_B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
FIRST, SECOND = ta.ByteLevel(PATH_A), ta.Pieces(PATH_B)
PLAIN_A = Tokenizer.from_file(PATH_A)
PLAIN_A.encode_special_tokens = True
PLAIN_B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
ODD = [
    "a", " ", " \n", "  lead", "trail  ", "a▁b", "x \n y", "\x00a b", "it's  we'll \t go", "<|endoftext|> <s> b </s>",
    "é ü　x y", "🙂🙃 a🙂b c", "a\n\n b\r\n c", "\x1c a \x85 b", "don 't 'll", "word word word  word",
]


def _token_a(i):
    of_char = ta._byte_of_char()
    return bytes(of_char[c] for c in PLAIN_A.id_to_token(i))


def _token_b(i):
    piece = PLAIN_B.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if PLAIN_B.is_byte(i) else piece.replace("▁", " ").encode()


def _spans(tokens):
    at = 0
    for token in tokens:
        yield at, at + len(token)
        at += len(token)


def plain(text):
    """Whole text by both libraries, links from all pairs of tokens."""
    nothing = (0, 0, 0, 0, ""), Counter()
    if not text:
        return nothing
    a = PLAIN_A.encode(" " + text, add_special_tokens=False).ids
    b = PLAIN_B.encode(text)
    spelled = [_token_a(i) for i in a], [_token_b(i) for i in b]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return nothing
    spans = [list(_spans(s)) for s in spelled]
    links = Counter(
        (x, y) for x, (i, j) in zip(a, spans[0]) for y, (k, m) in zip(b, spans[1]) if max(i, k) < min(j, m)
    )
    common = sorted({j for _, j in spans[0]} & {j for _, j in spans[1]})
    groups = []
    for first, last in zip([0, *common], common):
        inside = [
            ",".join(str(t) for t, (i, j) in zip(ids, places) if first <= i and j <= last)
            for ids, places in zip((a, b), spans)
        ]
        groups.append("|".join(inside))
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return (len(a), len(b), len(groups), sum(links.values()), digest), links


def _aligned(texts):
    found = ta.align_texts(texts, FIRST, SECOND)
    rows = zip(*[found[c].to_pylist() for c in MEASURES])
    low = (1 << ta.PAIR_BITS) - 1
    links = [Counter({(e["pair"] >> ta.PAIR_BITS, e["pair"] & low): e["times"] for e in r}) for r in found["links"].to_pylist()]
    return list(zip(rows, links))


def test_texts_equal_the_libraries_on_whole_texts(documents):
    texts = ODD + sorted((t for _, t in documents if t), key=len)[:60]
    for text, found in zip(texts, _aligned(texts)):
        assert found == plain(text), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab é'\n\t ▁🙂.,0S　​", min_size=1, max_size=30), min_size=1, max_size=8))
def test_any_texts(texts):
    assert _aligned(texts) == [plain(t) for t in texts]


def expected(rows):
    measured = [(key, *plain(text)) for key, text in rows]
    docs = Counter(pair for *_, links in measured for pair in links)
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (key, *m[:4], sum(n for p, n in links.items() if docs[p] == best[p[0]]), sum(n * docs[p] for p, n in links.items()), m[4])
            for key, m, links in measured
        ),
        key=repr,
    )


def _rows(found):
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


@pytest.mark.parametrize("limit", [ta.BROADCAST_PAIRS, 0])
def test_corpus_with_copies_nulls_and_odd_texts(spark, limit):
    texts = [None, "", *ODD, "same text here", "same text here", "same text there", "long " * 3000 + "end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same text here"), (3, "same text here"), (None, None)]
    # Other columns with the names that the operator uses itself.
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("digest", "copies", "links", "pair", "n", "key")])
    found = ta.align_tokenizers(docs, PATH_A, PATH_B, broadcast_pairs=limit, batch_chars=100)
    assert _rows(found) == expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align_tokenizers(docs, PATH_A, PATH_B).count() == 0


def test_unlike_files_are_refused():
    with pytest.raises(ValueError):
        ta.ByteLevel(tokenizer_path("word_bpe_49k.json"))


def test_query_on_short_documents(spark, documents, tmp_path):
    rows = [(k, t) for k, t in documents if t and len(t) < 700]
    rows += [(k + 10**6, t) for k, t in rows[:5]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = op13_token_alignment(spark, str(tmp_path)).withColumnRenamed("doc_id", "key")
    assert _rows(found) == expected(rows)
