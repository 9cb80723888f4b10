"""Token ids of a corpus in binary files.

Ids are replaced by their rank of frequency over the whole corpus, so that common ids are
small numbers, and written as Stream VByte: two bits per id in *control bytes* say
whether its data takes 1 to 4 bytes, and the *data bytes* stand apart from them. A reader
turns control bytes into lengths by a table of 256 rows and gathers all values of a block
at once in numpy.

A file is a series of blocks, each with whole documents::

    b"CLSVB001" | documents, ids, data bytes (3 x u64) | keys (i64) | 1 if a key is null (u8)
    | ids per document (u64) | control bytes (a quarter of the ids, rounded up) | data bytes

``ranks.u32`` beside the files holds the id of every rank. Files follow each other in
ascending order of the key. All numbers are little-endian.

Defined cases: a NULL text counts as empty, and an empty text has the end id alone; NULL
keys come first; rows of equal key are ordered by number of ids and checksum, repeated
rows are all written; an empty table gives no file and no row. Other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.files import (
    drop_folder,
    open_file,
    release_memory,
    shared_folder,
    small_batches,
    write_file,
    written,
)

MAGIC = b"CLSVB001"
HEADER = struct.Struct("<8sQQQ")
#: Ids in a block, at least; a document is never cut.
BLOCK_IDS = 1 << 20
#: Ids in a file, about.
FILE_IDS = 1 << 25
#: Characters of text that are encoded at a time, about, and words whose ids a Python worker
#: remembers before it starts anew; more of either costs memory and saves time.
BATCH_CHARS = 8_000_000
REMEMBERED_WORDS = 600_000

#: The tokenizer's rule of words, written for letters up to U+024F, where the regular
#: expression engines agree on classes. Other texts go to the tokenizer whole.
_WORD = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: The character by which a byte-level vocabulary writes each byte: printable ones of Latin-1
#: stand for themselves, the others are U+0100 and on in their order.
_BYTE_LEVEL = {b: chr(b) for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)}
_BYTE_LEVEL |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _BYTE_LEVEL)}
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ɏ]*")
#: A word of letters and one of other signs, where the rule cuts.
_SIGNED = r"^(?P<head>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<tail>[!-/:-@\[-`{-~]+)$"
#: White space before a space, of the kinds that plain texts hold.
_SPACES = [white + " " for white in " \n\t\r\v\f"]


class WordCache:
    """Encodes whole texts with the tokenizers library, each distinct word once.

    Byte-pair merges never cross words, so the ids of a text are those of its words in
    turn. A space after a visible character always begins a word, so texts are first cut
    at spaces, and the pieces of a batch are told apart by Arrow's dictionary encoding;
    letters with other signs after them are two words, other pieces not seen before are cut
    by the rule, and only new words go to the tokenizer's merging. When half as many as may
    be remembered are known, only those met again before the next time stay.
    """

    def __init__(self, path: str, special_as_text: bool = False, remembered_words: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        #: Of tokens that are cut out before words are: texts that hold one go to the tokenizer whole.
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ids: dict[str, bytes] = {}
        #: Remembered before ``ids``: what is met again moves there, the rest is forgotten in its turn.
        self.former: dict[str, bytes] = {}
        self.remembered_words = remembered_words

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of words that the rule has cut: what is left to the library is the merging."""
        merged = self.tokenizer.model.tokenize
        spelled = "\n".join(words).encode().decode("latin-1").translate(_BYTE_LEVEL).split(_BYTE_LEVEL[ord("\n")])
        ids = [[token.id for token in merged(letters)] for letters in spelled]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = list(accumulate(map(len, ids), initial=0))
        self.ids.update((word, raw[4 * i : 4 * j]) for word, i, j in zip(words, ends, ends[1:], strict=False))

    def _unknown(self, words: list[str]) -> list[str]:
        """The words that are not remembered, without those that were before: they move on."""
        known, former = self.ids, self.former
        new = [word for word in words if word not in known]
        known.update((word, former[word]) for word in new if word in former)
        return [word for word in new if word not in former]

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces of plain text, each of which begins and ends with a word."""
        known = self.ids
        new = self._unknown(pieces)
        # A piece of letters alone, with or without a space before them, is one word.
        words = {piece for piece in new if (piece[1:] if piece[:1] == " " else piece).isalpha()}
        cut = [(piece, _WORD.findall(piece)) for piece in new if piece not in words]
        inside = set().union(*[own for _, own in cut])
        words.update(self._unknown(list(inside)))
        spaces = [word for word in words if word.isspace()]
        known.update((word, self.whole(word)) for word in spaces)
        self._learn(list(words.difference(spaces)))
        known.update((piece, b"".join([known[word] for word in own])) for piece, own in cut)
        return [known[piece] for piece in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian u32."""
        if len(self.ids) > self.remembered_words // 2:
            self.ids, self.former = {}, self.ids
        out: list[bytes | None] = [
            None if _PLAIN.fullmatch(text) and not any(s in text for s in self.special) else self.whole(text)
            for text in texts
        ]
        plain = [i for i, ids in enumerate(out) if ids is None]
        cut = [i for i in plain if not any(pair in texts[i] for pair in _SPACES)]
        for i, ids in zip(cut, self._pieces([texts[i] for i in cut]), strict=True):
            out[i] = ids
        for i in plain:
            if out[i] is None:  # white space before a space: the text is one piece, which is not remembered
                words = _WORD.findall(texts[i])
                self._lookup(list(dict.fromkeys(words)))
                out[i] = b"".join([self.ids[word] for word in words])
        return out

    def _pieces(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = pc.split_pattern(pa.array(texts, pa.large_string()), " ", max_splits=None)
        offsets = found.offsets.to_numpy()
        coded = found.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        # The first piece of a text has no space before it.
        first = coded.dictionary.take(coded.indices.take(pa.array(offsets[:-1]))).to_pylist()
        different = list(dict.fromkeys(first))
        ids_of = dict(zip(different, self._lookup(different), strict=True))
        heads = [ids_of[piece] for piece in first]
        later = np.ones(len(index), bool)
        later[offsets[:-1]] = False
        index = index[later]
        used = np.zeros(len(coded.dictionary), bool)
        used[index] = True
        index = (np.cumsum(used) - 1)[index]
        ids = self._spaced(coded.dictionary.filter(pa.array(used)))
        values = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - (ends - lengths), lengths)
        body = values[at].tobytes()
        ends = np.concatenate([[0], ends])[offsets - np.arange(len(offsets))]
        return [head + body[4 * a : 4 * b] for head, a, b in zip(heads, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _spaced(self, pieces: pa.Array) -> list[bytes]:
        """Ids of different pieces, each after a space; letters and the signs after them are looked up apart."""
        found = pc.extract_regex(pieces, _SIGNED)
        signed = found.is_valid()
        space, nothing = pa.scalar(" ", pieces.type), pa.scalar("", pieces.type)
        other, heads = pieces.filter(pc.invert(signed)), found.field("head").filter(signed)
        other, heads = (pc.binary_join_element_wise(space, part, nothing) for part in (other, heads))
        tails = found.field("tail").filter(signed)
        other, heads, tails = (part.to_numpy(zero_copy_only=False).tolist() for part in (other, heads, tails))
        known = iter(self._lookup(other))
        self._lookup(list(dict.fromkeys(chain(heads, tails))))
        both = (self.ids[head] + self.ids[tail] for head, tail in zip(heads, tails, strict=True))
        return [next(both if s else known) for s in signed.to_numpy(zero_copy_only=False).tolist()]


_caches: dict[tuple[str, bool, int], WordCache] = {}


def bytes_encoder(
    path: str, special_as_text: bool = False, remembered_words: int = REMEMBERED_WORDS
) -> Callable[[list[str]], list[bytes]]:
    """Encoder for the byte-level tokenizer file at ``path``, which every executor has."""

    def encode(texts: list[str]) -> list[bytes]:
        key = path, special_as_text, remembered_words
        if key not in _caches:
            _caches[key] = WordCache(*key)
        return _caches[key].encode(texts)

    return encode


def pack(ids: bytes) -> bytes:
    """Little-endian u32 ids for the way through Spark: high and low bytes apart, compressed."""
    planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encode_documents(
    docs: DataFrame,
    encode: Callable[[list[str]], list[bytes]],
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    place: Sequence[Column] = (),
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """One row per document: key, n_tokens, crc and packed ids with the end id.

    ``place`` gives columns that order the documents where the key does not; they come
    out as place0, place1 and so on.
    """
    end = struct.pack("<I", end_id)
    narrow = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).cast("string").alias("text"),
        *[c.alias(f"place{i}") for i, c in enumerate(place)],
    )

    def rows(texts: list[str], others: pa.RecordBatch) -> pa.RecordBatch:
        ids = [found + end for found in encode(texts)]
        made = {
            "key": others["key"],
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "crc": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            "ids": pa.array([pack(x) for x in ids], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(made | {n: others[n] for n in others.schema.names if n not in ("key", "text")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            first, texts, chars = 0, [], 0
            for i, t in enumerate(batch["text"]):
                texts.append(t.as_py() or "")
                chars += len(texts[-1])
                if chars >= batch_chars or i == batch.num_rows - 1:
                    yield rows(texts, batch.slice(first, len(texts)))
                    first, texts, chars = i + 1, [], 0

    ordered = "".join(f", {f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[2:])
    return narrow.mapInArrow(run, f"key long, n_tokens long, crc long, ids binary{ordered}")


def frequency_ranks(encoded: DataFrame, max_ids: int = 1 << 22) -> np.ndarray:
    """The ids of the corpus from the most to the least frequent; ties by id.

    Counts over all documents, summed in each task before the shuffle. What comes to the
    driver is bounded by the vocabulary; more than ``max_ids`` different ids are an error.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)

        def add(parts: list[np.ndarray]) -> None:
            nonlocal total
            found = np.bincount(np.concatenate(parts))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[: len(found)] += found

        parts, n = [], 0
        for batch in batches:
            for packed in batch.column(0):
                parts.append(unpack(packed.as_py()))
                n += len(parts[-1])
                if n >= BLOCK_IDS:
                    add(parts)
                    parts, n = [], 0
        if parts:
            add(parts)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.limit(max_ids + 1).toArrow()
    if found.num_rows > max_ids:
        raise ValueError(f"more than {max_ids} different token ids")
    ids, n = found["id"].to_numpy(), found["n"].to_numpy()
    return ids[np.lexsort((ids, -n))].astype("<u4")


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def vbyte_encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of u32 values."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = extra
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    taken = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def vbyte_decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    padded = data + b"\0\0\0"
    at_every_byte = np.ndarray((len(data),), "<u4", padded, strides=(1,))
    return at_every_byte[ends - lengths] & _MASKS[lengths]


def _block(keys: list, lengths: list[int], ids: list[np.ndarray], rank: np.ndarray) -> Iterator[bytes]:
    values = rank[np.concatenate(ids)]
    control, data = vbyte_encode(values)
    yield HEADER.pack(MAGIC, len(keys), len(values), len(data))
    yield np.array([k or 0 for k in keys], "<i8").tobytes()
    yield np.array([k is None for k in keys], np.uint8).tobytes()
    yield np.array(lengths, "<u8").tobytes()
    yield control
    yield data


def _blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, null flags, lengths and ranks of each block of an open file."""
    while head := stream.read(HEADER.size):
        magic, docs, n, data = HEADER.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a token file")
        keys = np.frombuffer(stream.read(8 * docs), "<i8")
        nulls = np.frombuffer(stream.read(docs), np.uint8)
        lengths = np.frombuffer(stream.read(8 * docs), "<u8").astype(np.int64)
        control = stream.read(-(-n // 4))
        yield keys, nulls, lengths, vbyte_decode(control, stream.read(data), n)


def write_token_files(encoded: DataFrame, folder: str, *, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents of :func:`encode_documents` in ascending order of place or key.

    Returns the list of files (index, file, documents, n_tokens), which is also written
    below ``folder``. ``encoded`` should be a written table, as it is read three times:
    for the counts, for the sample of keys, and for the files. The one shuffle moves
    packed ids.
    """
    spark = encoded.sparkSession
    ids = frequency_ranks(encoded)
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, "<u4")
    rank[ids] = np.arange(len(ids), dtype="<u4")
    write_file(f"{folder}/ranks.u32", [ids.tobytes()])
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    order = [*(c for c in encoded.columns if c.startswith("place")), "key", "n_tokens", "crc"]
    shared = spark.sparkContext.broadcast(rank)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TaskContext.get().partitionId()
        name = f"{folder}/part-{index:06d}.svb"
        written = [0, 0]

        def chunks() -> Iterator[bytes]:
            keys, lengths, parts, n = [], [], [], 0
            for batch in batches:
                for k, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    part = unpack(packed.as_py())
                    keys.append(k)
                    lengths.append(len(part))
                    parts.append(part)
                    n += len(part)
                    if n >= BLOCK_IDS:
                        yield from _block(keys, lengths, parts, shared.value)
                        written[0] += len(keys)
                        written[1] += n
                        keys, lengths, parts, n = [], [], [], 0
            if keys:
                yield from _block(keys, lengths, parts, shared.value)
                written[0] += len(keys)
                written[1] += n

        write_file(name, chunks())
        yield pa.RecordBatch.from_pydict(
            {"index": [index], "file": [name], "documents": [written[0]], "n_tokens": [written[1]]}
        )

    ranged = encoded.repartitionByRange(max(1, -(-total // file_ids)), *order).sortWithinPartitions(*order)
    listed = ranged.select("key", "ids").mapInArrow(write, "index long, file string, documents long, n_tokens long")
    return written(listed, f"{folder}/files").where("documents > 0")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the listed files: key, start, n_tokens and ids_crc32.

    ``start`` counts the ids of all documents before it; one row per file is summed for
    that, the rest happens where a file is read.
    """
    running = Window.orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(running), F.lit(0)))
    spread = placed.select("file", "start").repartition(max(1, files.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_file(f"{name.rpartition('/')[0]}/ranks.u32") as f:
                    ids = np.frombuffer(f.read(), "<u4")
                with open_file(name) as f:
                    for keys, nulls, lengths, ranks in _blocks(f):
                        ends = np.cumsum(lengths)
                        of_block = ids[ranks]
                        raw = memoryview(of_block.tobytes())
                        starts = ends - lengths
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, mask=nulls.astype(bool)),
                                pa.array(start + starts),
                                pa.array(lengths),
                                pa.array(
                                    [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)],
                                    pa.int64(),
                                ),
                            ],
                            ["key", "start", "n_tokens", "ids_crc32"],
                        )
                        start += int(ends[-1])

    return spread.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long")


def read_ids(names: Iterable[str]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Key and ids of every document of the given files, for a training loader."""
    for name in names:
        with open_file(f"{name.rpartition('/')[0]}/ranks.u32") as f:
            ids = np.frombuffer(f.read(), "<u4")
        with open_file(name) as f:
            for keys, nulls, lengths, ranks in _blocks(f):
                parts = np.split(ids[ranks], np.cumsum(lengths)[:-1])
                yield from ((None if z else int(k), part) for k, z, part in zip(keys, nulls, parts, strict=True))


def tokenize_to_files(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    file_ids: int = FILE_IDS,
    special_as_text: bool = False,
    place: Sequence[Column] = (),
    batch_chars: int = BATCH_CHARS,
    remembered_words: int = REMEMBERED_WORDS,
) -> DataFrame:
    """Encode, write and read back: key, start, n_tokens, ids_crc32 of every document.

    Texts are tokenized once; packed ids are written to the shared folder, counted,
    ordered and written in the final format, then the packed ids are deleted. ``place``
    gives columns that order the documents instead of the key.
    """
    spark: SparkSession = docs.sparkSession
    folder = shared_folder(spark, "tokens")
    encode = bytes_encoder(tokenizer_path, special_as_text, remembered_words)
    encoded = encode_documents(docs, encode, key=key, text=text, end_id=end_id, place=place, batch_chars=batch_chars)
    with small_batches(spark):
        encoded = written(encoded, f"{folder}/ids")
    files = write_token_files(encoded, folder, file_ids=file_ids)
    drop_folder(spark, f"{folder}/ids")
    return read_token_files(files)
