"""How two tokenizers cut the same texts.

Texts are deduplicated exactly: a shuffle by the full text leaves each distinct text once,
with its number of copies. Each distinct text is encoded by both tokenizers and aligned by
byte offsets; places where tokens of both end cut it into *groups*, and every pair of
tokens whose byte ranges overlap is a *link*. How many documents hold a pair of ids linked
is the sum of the copies of the texts that hold it. What a text measures goes back to its
documents by the digest of the text.

Within a batch a text is cut before every single space that stands between two visible
characters. No token of either tokenizer crosses such a place, which is checked on the
vocabularies, so the ids and links of a text are those of its pieces in turn, and each
distinct piece of a batch is encoded once.

The table of pair counts is broadcast only if it has at most ``broadcast_pairs`` rows.
Beyond that the links are shuffled by pair.

Defined cases: a NULL or empty text has no tokens, nor has one that either tokenizer does
not give back byte by byte (with a space in front); all its measures are 0 and the digest
of its groups is ''. NULL and repeated keys are kept, one row each; an empty table gives
no row. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.files import shared_folder, written

#: Characters of text that are encoded and aligned at a time, about; a text is never cut.
BATCH_CHARS = 8_000_000
#: Pairs of ids whose counts are broadcast at most: 17 bytes each.
BROADCAST_PAIRS = 4_000_000
#: Bits of an id of the second tokenizer in a pair.
PAIR_BITS = 20

#: Texts without white space that are encoded in one call.
_LINES = 4000
_WHITE = re.compile(r"\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE_BEFORE = re.compile(r" \s")
_SPACE_AFTER = re.compile(r" (?<=\s )")
# The byte-level tokenizer's rule of words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LINKS = "array<struct<pair:bigint,times:bigint>>"
ALIGNED = (
    f"digest string, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    f"groups_sha256 string, links {LINKS}"
)


class Vocabulary:
    """The bytes of every token id, for vectorised comparison with texts."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) >= 1 << PAIR_BITS:
            raise ValueError(f"a vocabulary holds fewer than {1 << PAIR_BITS} ids")
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        #: An id followed by the sign between tokens, between the sides of a group, between groups.
        self.names = [np.array([f"{i}{sign}" for i in range(len(tokens))], object) for sign in ",|;"]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens in turn."""
        lengths = self.lengths[ids]
        place = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[place + np.arange(len(place))]


class ByteLevel:
    """A byte-level tokenizer of a JSON file; special tokens in texts are plain text.

    The file's merges are in the order of their ids, so ranks say all; the merging itself
    is done by the tiktoken library, which is several times faster here.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, special = described["model"], {t["content"] for t in described["added_tokens"]}
        rule = described["pre_tokenizer"]
        merges = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        ids = model["vocab"]
        first = len(ids) - len(merges) - len(special & set(ids))
        if (
            model["type"] != "BPE"
            or described["normalizer"] is not None
            or (rule["type"], rule["use_regex"], rule["add_prefix_space"]) != ("ByteLevel", True, False)
            or any(ids[m] != first + i for i, m in enumerate(merges))
        ):
            raise ValueError(f"not a byte-level tokenizer with merges in the order of ids: {path}")
        of_char = _byte_of_char()
        ranks = {bytes(of_char[c] for c in token): i for token, i in ids.items() if token not in special}
        tokens = [b""] * (1 + max([*ids.values(), *(t["id"] for t in described["added_tokens"])]))
        for token, i in ranks.items():
            tokens[i] = token
        self.vocabulary = Vocabulary(tokens)
        self._encode = tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._line_end = ranks[b"\n"]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, each with a space in front, and how many each has.

        A line end before a space and a visible character is a word and a token of its own,
        so texts without white space go to the library as lines.
        """
        found: list[list[int]] = [[]] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if text and not _WHITE.search(text):
                plain.append(i)
            else:
                found[i] = self._encode(" " + text)
        for at in range(0, len(plain), _LINES):
            some = plain[at : at + _LINES]
            ids = self._encode("\n".join([" " + texts[i] for i in some]))
            first = 0
            for i in some[:-1]:
                end = ids.index(self._line_end, first)
                found[i] = ids[first:end]
                first = end + 1
            found[some[-1]] = ids[first:]
        return _flat(found)


def _byte_of_char() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """A sentencepiece model; it puts a space in front of each text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(size)]
        if any(re.search("[^▁]▁", piece) for piece in pieces):
            raise ValueError(f"pieces of {path} cross the border of words")
        byte = [self._model.is_byte(i) for i in range(size)]
        self.vocabulary = Vocabulary(
            [bytes([int(p[3:-1], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, byte, strict=True)]
        )

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and how many each has."""
        return _flat(self._model.encode(texts, num_threads=1))


@lru_cache(maxsize=4)
def _loaded(kind: type[ByteLevel | Pieces], path: str) -> ByteLevel | Pieces:
    """Once per Python worker, which serves many tasks."""
    return kind(path)


def pieces_of(text: str) -> list[str]:
    """The text cut before single spaces between visible characters; the spaces are left out."""
    odd = text[0] == " " or text[-1] == " " or _SPACE_BEFORE.search(text) or _SPACE_AFTER.search(text)
    return _CUT.split(text) if odd else text.split(" ")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes, of which some may be 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Alignment:
    """The alignment of many texts at once; a space stands in front of each.

    ``good`` tells which texts both tokenizers give back; of those: ``n_a``, ``n_b``,
    ``n_groups`` and ``n_links`` per text (0 for others), ``pairs`` of all links in order,
    and the groups as text.
    """

    def __init__(self, texts: list[str], first: ByteLevel | Pieces, second: ByteLevel | Pieces):
        raw = [b" " + text.encode() for text in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        spelled = np.frombuffer(b"".join(raw), np.uint8)
        sides = [(*side.encode(texts), side.vocabulary) for side in (first, second)]
        fits = np.ones(len(texts), bool)
        for ids, counts, vocabulary in sides:
            fits &= _sums(vocabulary.lengths[ids], counts) == sizes
        self.good = fits.copy()
        for ids, counts, vocabulary in sides:
            wrong = vocabulary.spelled(ids[np.repeat(fits, counts)]) != spelled[np.repeat(fits, sizes)]
            self.good[fits] &= _sums(wrong, sizes[fits]) == 0
        self._align(sides, sizes)

    def _align(self, sides: list, sizes: np.ndarray) -> None:
        good = self.good
        (a, self.n_a), (b, self.n_b) = (
            (ids[np.repeat(good, counts)], np.where(good, counts, 0)) for ids, counts, _ in sides
        )
        ends_a, ends_b = (np.cumsum(v.lengths[ids]) for ids, (_, _, v) in zip((a, b), sides, strict=True))
        total = int(ends_a[-1]) if len(ends_a) else 0
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        ends = np.flatnonzero(at_a | at_b)
        # The bytes between two neighbouring ends are those that one pair of tokens shares.
        token_a = np.cumsum(at_a)[ends] - at_a[ends]
        token_b = np.cumsum(at_b)[ends] - at_b[ends]
        self.pairs = (a[token_a] << PAIR_BITS) | b[token_b]
        borders = at_a[ends] & at_b[ends]
        of_text = np.searchsorted(np.cumsum(np.where(good, sizes, 0)), ends, "left")
        self.n_links = np.bincount(of_text, minlength=len(good))[: len(good)]
        self.n_groups = np.bincount(of_text[borders], minlength=len(good))[: len(good)]
        self._name(a, b, token_a[borders], token_b[borders], *(v.names for _, _, v in sides))

    def _name(self, a, b, last_a, last_b, names_a, names_b) -> None:
        """The groups as text: per group the ids of the first tokenizer, then those of the second."""
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(sizes_a), sizes_b)
        signed = np.empty(len(a) + len(b), object)
        signed[place_a], signed[place_b] = names_a[0][a], names_b[0][b]
        signed[place_a[last_a]], signed[place_b[last_b]] = names_a[1][a[last_a]], names_b[2][b[last_b]]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        signed = signed.tolist()
        #: The groups of each text, as ``a1,a2|b1;a3|b2,b3;``.
        self.groups = ["".join(signed[i:j]) for i, j in zip([0, *ends], ends, strict=False)]


def _links(of_text: np.ndarray, different: np.ndarray, place: np.ndarray, n_texts: int) -> pa.ListArray:
    """Per text the different pairs with their numbers, in order of the pairs."""
    found, times = np.unique(of_text * max(len(different), 1) + place, return_counts=True)
    text, place = np.divmod(found, max(len(different), 1))
    offsets = np.searchsorted(text, np.arange(n_texts + 1))
    entries = pa.StructArray.from_arrays([pa.array(different[place]), pa.array(times.astype(np.int64))], ["pair", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of consecutive runs, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def align_texts(texts: list[str], first: ByteLevel | Pieces, second: ByteLevel | Pieces) -> dict[str, pa.Array]:
    """The measures and links of whole texts, none of them empty."""
    cut = [pieces_of(text) for text in texts]
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = list(chain.from_iterable(cut))
    number = {piece: i for i, piece in enumerate(dict.fromkeys(flat))}
    used = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    found = Alignment(list(number), first, second)
    good = _sums(~found.good[used], sizes) == 0
    ends = np.cumsum(sizes).tolist()
    places = used.tolist()
    digests = [
        hashlib.sha256("".join(map(found.groups.__getitem__, places[i:j]))[:-1].encode()).hexdigest() if ok else ""
        for i, j, ok in zip([0, *ends], ends, good.tolist(), strict=False)
    ]
    of_text = np.repeat(np.arange(len(texts)), sizes)
    kept = good[of_text]
    used, of_text = used[kept], of_text[kept]
    links = found.n_links[used]
    different, place = np.unique(found.pairs, return_inverse=True)
    place = place[_runs((np.cumsum(found.n_links) - found.n_links)[used], links)]
    count = {name: getattr(found, name)[used] for name in ("n_a", "n_b", "n_groups", "n_links")}
    return {
        **{name: pa.array(_sums(n, np.where(good, sizes, 0)), pa.int64()) for name, n in count.items()},
        "groups_sha256": pa.array(digests, pa.string()),
        "links": _links(np.repeat(of_text, links), different, place, len(texts)),
    }


def _batches_of_texts(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        first, texts, held = 0, [], 0
        for i, text in enumerate(batch["text"]):
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= chars or i == batch.num_rows - 1:
                yield batch.slice(first, len(texts)), texts
                first, texts, held = i + 1, [], 0


def aligned_texts(distinct: DataFrame, path_a: str, path_b: str, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """Encode and align each text of ``(digest, copies, text)`` once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _loaded(ByteLevel, path_a), _loaded(Pieces, path_b)
        for rows, texts in _batches_of_texts(batches, batch_chars):
            made = {"digest": rows["digest"], "copies": rows["copies"]} | align_texts(texts, first, second)
            yield pa.RecordBatch.from_pydict(made)

    return distinct.select("digest", "copies", "text").mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many documents hold a pair linked, and whether no pair of its first id has more.

    Counts are combined in each task first. A first id has as many pairs as the second
    tokenizer has ids, at most.
    """
    counts = aligned.select("copies", F.inline("links")).groupBy("pair").agg(F.sum("copies").alias("n"))
    of_first = Window.partitionBy(F.shiftright("pair", PAIR_BITS))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_first)).alias("best"))


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, copies.

    ``n_best`` counts the links whose pair no other pair of its first id exceeds in
    documents, ``count_sum`` sums the documents of the pairs of all links.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "alignment")
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    distinct = narrow.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("digest", F.sha2("text", 256))
    aligned = aligned_texts(distinct, path_a, path_b, batch_chars)
    aligned.write.option("compression", "zstd").parquet(f"{folder}/aligned")
    aligned = spark.read.schema(aligned.schema).parquet(f"{folder}/aligned")
    counts = written(pair_counts(aligned), f"{folder}/counts")
    known = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    scores = (
        aligned.select("digest", F.inline("links"))
        .join(known, "pair")
        .groupBy("digest")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    measures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    found = aligned.drop("links").join(scores, "digest", "left")
    found = written(found, f"{folder}/measures")
    rows = narrow.select("key", F.sha2("text", 256).alias("digest"))
    return rows.join(found, "digest", "left").select(
        "key",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in measures],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        F.coalesce("copies", F.lit(0)).alias("copies"),
    )
