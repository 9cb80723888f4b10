"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text is the sequence of its 5-word shingles, repeats numbered. For each of several
tables a hash picks the smallest shingles, and these are kept *in the order of the text*:
two texts share a key only if the same shingles stand in the same order, so keys follow
edit similarity rather than set overlap. So few shingles are left of a short text that
samples of two alike ones may never be equal; texts of 4 to 14 shingles therefore also have
a key of all shingles and one of all but each, which every two such texts share whose
sequences are equal but for one shingle of either. Texts that share a key in some table are
compared by the overlap of samples of their shingles, likely pairs by a banded alignment of
their shingle sequences: common subsequence over union, at least 0.8. Linked texts form classes.

Equal texts are one node (by 128 bits of SHA-256) before any comparison. Within a bucket
samples are compared in blocks inside the tasks. First the pairs of a spanning forest of
the most alike texts leave a task, so a large group of near copies is joined by about as
many pairs as it has members. Then, of texts that are still in different classes, all
likely pairs follow, the most alike partners of each text first, in growing slices until
none is left: no partner is dropped.

Defined cases: a NULL text counts as empty; texts without words are in a class with
equal texts only; a NULL key is a member of its class but never its id unless all keys
are NULL; ties and repeated rows are equal texts; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.alignment import ordered_similarity
from corpusloom.llm.components import components
from corpusloom.llm.files import releasing, shared_folder, written
from corpusloom.llm.groups import map_groups
from corpusloom.llm.shingles import mix, numbered, shingles_of_words, word_hashes


@dataclass(frozen=True)
class OrderMinHash:
    """Parameters. With 20 tables of 5 shingles a pair of long texts at 0.8 shares a key with
    probability 1 - (1 - 0.8^5)^20 = 0.9996. Least likely are 8 against 10 shingles, 0.993."""

    words: int = 5
    similarity: float = 0.8
    tables: int = 20
    per_key: int = 5
    #: Texts of so many shingles also have keys with one of them left out.
    short: tuple[int, int] = (4, 14)
    #: Shingle hashes kept of a text, at most about. Up to this length the overlap of two
    #: texts is exact; of longer texts the share 1/2, 1/4, ... with the smallest hashes is kept.
    signature: int = 1024
    #: Sampled overlaps are estimates: pairs this far below the similarity are aligned as well.
    margin: float = 0.06
    #: Rows of a block of signatures that one task compares with another.
    block: int = 256
    #: Alike partners of a text in the first slice; a slice is eight times the one before.
    first_slice: int = 8


_CHUNK = 1 << 14


def _hash(shingles: np.ndarray, row: np.ndarray) -> np.ndarray:
    return (shingles[None, :] * row[:, None]) >> np.uint64(32)


def levels(sizes: np.ndarray, signature: int) -> np.ndarray:
    """How often the sample of a text of so many shingles is halved."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / signature))).astype(np.int64)


def left_out(shingles: np.ndarray) -> np.ndarray:
    """Keys of the sequence without each of its elements, and of all of it."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(shingles), dtype=np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles + (place + np.uint64(1)) * odd))])
    after = np.concatenate([np.cumsum(mix(shingles + place * odd)[::-1])[::-1], np.zeros(1, np.uint64)])
    return mix(np.concatenate([before[:-1] + after[1:], before[-1:]]))


class Sketcher:
    def __init__(self, p: OrderMinHash):
        self.p = p
        odd = mix(np.arange(1, p.tables + 2, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
        self.factors, self.sample = odd[1:], odd[:1]

    def sketch(self, shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Sampled hashes as u32, and a key per table, then those of the last table if the text is short."""
        p = self.p
        places = [[] for _ in range(p.tables)]
        for at in range(0, len(shingles), _CHUNK):
            values = _hash(shingles[at : at + _CHUNK], self.factors)
            take = min(p.per_key, values.shape[1])
            found = np.argpartition(values, take - 1, axis=1)[:, :take] + at
            for table in range(p.tables):
                places[table].append(found[table])
        chosen = np.array([np.concatenate(x) for x in places])
        if chosen.shape[1] > p.per_key:
            values = (shingles[chosen] * self.factors[:, None]) >> np.uint64(32)
            best = np.argpartition(values, p.per_key - 1, axis=1)[:, : p.per_key]
            chosen = np.take_along_axis(chosen, best, axis=1)
        chosen.sort(axis=1)
        keys = np.zeros(p.tables, np.uint64)
        for column in shingles[chosen].T:
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        if p.short[0] <= len(shingles) <= p.short[1]:
            keys = np.concatenate([keys, left_out(shingles)])
        sample = _hash(shingles, self.sample)[0]
        level = int(levels(np.array([len(shingles)]), p.signature)[0])
        return sample[sample < np.uint64(1 << 32 >> level)].astype("<u4").tobytes(), keys


def overlaps(samples: list[np.ndarray], level: np.ndarray, p: OrderMinHash) -> np.ndarray:
    """How far the estimated similarity of each two texts is above what asks for an alignment.

    Two samples are compared at the level of the sparser one. Texts more than one level
    apart differ too much in length.
    """
    above = np.full((len(samples), len(samples)), -1.0, np.float32)
    for at_level in np.unique(level):
        rows = np.flatnonzero((level == at_level) | (level == at_level - 1))
        cut = 1 << 32 >> int(at_level)
        kept = [samples[i][samples[i] < cut] for i in rows]
        size = np.array([len(x) for x in kept])
        values, column, times = np.unique(np.concatenate(kept), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        row = np.repeat(np.arange(len(rows)), size)[times[column] > 1]
        column = shared[column[times[column] > 1]]
        both = np.zeros((len(rows), len(rows)), np.float32)
        for first in range(0, int(column.max(initial=-1)) + 1, _CHUNK):
            own = (column >= first) & (column < first + _CHUNK)
            block = np.zeros((len(rows), _CHUNK), np.float32)
            block[row[own], column[own] - first] = 1
            both += block @ block.T
        union = np.maximum(size[:, None] + size[None, :] - both, 1)
        limit = p.similarity - (p.margin if at_level else 1e-6)
        here = np.maximum(level[rows][:, None], level[rows][None, :]) == at_level
        part = above[np.ix_(rows, rows)]
        part[here] = (both / union - limit)[here]
        above[np.ix_(rows, rows)] = part
    np.fill_diagonal(above, -1)
    return above


def digest(text: Column) -> Column:
    """128 bits of SHA-256: the node of a text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, 32))


def _sketches(docs: DataFrame, p: OrderMinHash) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(p)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                words, first = word_hashes([t.as_py() or "" for t in part["text"]])
                made = []
                for a, b in zip(first, first[1:], strict=False):
                    shingles = numbered(shingles_of_words(words[a:b], p.words))
                    made.append(sketcher.sketch(shingles) if len(shingles) else (None, None))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["node"],
                        pa.array([s for s, _ in made], pa.binary()),
                        pa.array(np.maximum(np.diff(first) - p.words + 1, 1), pa.int32()),
                        pa.array([None if k is None else k.view(np.int64) for _, k in made], pa.list_(pa.int64())),
                    ],
                    ["key", "node", "signature", "size", "keys"],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "node", "text").mapInArrow(
        releasing(run), f"key {kind}, node binary, signature binary, size int, keys array<bigint>"
    )


def spanning_forest(above: np.ndarray, classes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs with ``above`` >= 0 that join all classes such pairs can join, the highest where there is a choice."""
    n = len(above)
    tied = np.where(classes[:, None] == classes[None, :], np.float32(2), above)
    best, parent, outside = np.full(n, -1, np.float32), np.full(n, -1), np.ones(n, bool)
    found = []
    for _ in range(n):
        i = int(np.argmax(np.where(outside, best, -2)))
        if best[i] >= 0 and classes[i] != classes[parent[i]]:
            found.append((i, int(parent[i])))
        outside[i] = False
        closer = tied[i] > best
        best[closer], parent[closer] = tied[i][closer], i
    return found


def _alike(p: OrderMinHash, low: int, high: int, first: bool):
    """Compares two blocks of a bucket.

    In the first turn: a spanning forest, and partners from low to high of sampled texts;
    later partners from low to high of all texts.
    """

    def run(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        nodes = rows["node"].to_pylist()
        classes = rows["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        samples = [np.frombuffer(s, "<u4") for s in rows["signature"].to_pylist()]
        level = levels(rows["size"].to_numpy(), p.signature)
        own, x, y = (rows[c].to_numpy() for c in ("block", "x", "y"))
        a: list[bytes] = []
        b: list[bytes | None] = []

        def propose(i: int, j: int) -> None:
            a.append(min(nodes[i], nodes[j]))
            b.append(max(nodes[i], nodes[j]))

        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(nodes)], strict=True):
            at = np.arange(start, stop)
            if len(at) < 2 or (classes[at] == classes[start]).all():
                continue
            above = overlaps([samples[i] for i in at], level[at], p)
            if x[start] != y[start]:
                above[own[at][:, None] == own[at][None, :]] = -1  # texts of one block meet in another group
            if not (above >= 0).any():
                continue
            if first:
                for i, j in spanning_forest(above, classes[at]):
                    propose(at[i], at[j])
            for i in np.flatnonzero((above >= 0).any(axis=1)):
                near = np.flatnonzero(above[i] >= 0)
                if first and not level[at[i]]:
                    near = near[level[at[near]] > 0]
                # Places do not change when classes join, so that no partner slips between two slices.
                near = at[near[np.argsort(-above[i, near], kind="stable")]]
                apart = classes[near] != classes[at[i]]
                for j in near[low:high][apart[low:high]]:
                    propose(at[i], j)
                if apart[high:].any():
                    a.append(nodes[at[i]])
                    b.append(None)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def _likely_pairs(
    buckets: DataFrame, classes: DataFrame, p: OrderMinHash, low: int, high: int, first: bool
) -> DataFrame:
    """Pairs worth an alignment, and (node, NULL) where a later slice holds more."""
    rows = buckets.join(classes.select("node", "component"), "node")
    mixed = rows.groupBy("table", "bucket").agg((F.min("component") != F.max("component")).alias("mixed"))
    rows = rows.join(mixed.where("mixed").drop("mixed"), ["table", "bucket"])
    rows = rows.join(classes.drop("component"), "node")
    spread = rows.withColumn("blocks", F.ceil(F.col("n") / p.block).cast("int"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("x"), F.greatest("block", other).alias("y")),
    )
    spread = spread.select("table", "bucket", "node", "component", "signature", "size", "block", F.inline(pairs))
    found = map_groups(spread, ["table", "bucket", "x", "y"], _alike(p, low, high, first), "a binary, b binary", ["node"])
    return found.distinct()


def _aligned(pairs: DataFrame, texts: DataFrame, p: OrderMinHash) -> DataFrame:
    """Pairs whose shingle sequences reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, how = [], []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sides = []
                for side in ("a_text", "b_text"):
                    words, first = word_hashes(part[side].to_pylist())
                    sides.append([shingles_of_words(words[i:j], p.words) for i, j in zip(first, first[1:], strict=False)])
                for i, (a, b) in enumerate(zip(*sides, strict=True)):
                    found = ordered_similarity(a, b, p.similarity)
                    if found:
                        kept.append(at + i)
                        how.append(found)
            chosen = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen["a"], chosen["b"], pa.array(how, pa.float64())], ["a", "b", "similarity"]
            )

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(releasing(run), "a binary, b binary, similarity double")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after joining those that links connect."""
    of = classes.select("node", "component")
    ends = links.join(of.withColumnsRenamed({"node": "a", "component": "one"}), "a")
    ends = ends.join(of.withColumnsRenamed({"node": "b", "component": "other"}), "b")
    joined = components(ends.select(F.col("one").alias("a"), F.col("other").alias("b")))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("new"))
    return classes.join(joined, "component", "left").withColumn("component", F.coalesce("new", "component")).drop("new")


def near_duplicates(
    docs: DataFrame, p: OrderMinHash = OrderMinHash(), *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, class_id (smallest key of the class), class_size (rows), kept, for every row.

    Of each class the row with the smallest key is kept; of repeated rows with that key
    all are marked. Use :func:`keep_first` to keep exactly one row.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "near-dup")
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    narrow = narrow.withColumn("node", digest(F.col("text")))
    sketches = written(_sketches(narrow, p), f"{folder}/sketches")

    # One row per different text.
    sketched = sketches.where("signature IS NOT NULL")
    entries = sketched.select("node", "keys").dropDuplicates(["node"])
    entries = entries.select("node", F.posexplode("keys").alias("table", "bucket"))
    entries = entries.withColumn("table", F.least("table", F.lit(p.tables)))
    entries = written(entries, f"{folder}/entries")
    sizes = entries.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(entries.join(sizes, ["table", "bucket"]), f"{folder}/buckets")

    involved = buckets.select("node").distinct()
    samples = sketched.select("node", "signature", "size").join(involved, "node", "left_semi").dropDuplicates(["node"])
    texts = narrow.select("node", "text").join(involved, "node", "left_semi").dropDuplicates(["node"])
    texts = written(texts, f"{folder}/texts")
    samples = written(samples, f"{folder}/samples")
    classes = samples.withColumn("component", F.col("node"))
    low, step, turn = 0, p.first_slice, 0
    while True:
        found = _likely_pairs(buckets, classes, p, low, low + step, turn == 0)
        found = written(found, f"{folder}/pairs-{turn}")
        pairs = found.where("b IS NOT NULL")
        if turn and found.isEmpty():
            break
        aligned = written(_aligned(pairs, texts, p), f"{folder}/links-{turn}")
        more = not found.where("b IS NULL").isEmpty() if turn else not pairs.isEmpty()
        if not aligned.isEmpty():
            classes = written(_joined(classes, aligned), f"{folder}/classes-{turn}")
        low, step, turn = (low + step, step * 8, turn + 1) if turn else (0, step, 1)
        if not more:
            break

    rows = sketches.select("key", "node").join(classes.select("node", "component"), "node", "left")
    rows = rows.select("key", F.coalesce("component", "node").alias("component"))
    ids = rows.groupBy("component").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    out = rows.join(ids, "component")
    return out.select("key", "class_id", "class_size", F.col("key").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_first(docs: DataFrame, p: OrderMinHash = OrderMinHash(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each class: that with the smallest key.

    ``key`` should identify a row; rows that share both key and class are kept together.
    """
    found = near_duplicates(docs, p, key=key, text=text).where("kept").select(F.col("key").alias("_kept")).distinct()
    return docs.join(found, F.col(key).eqNullSafe(F.col("_kept")), "left_semi").select(*docs.columns)


def expected_recall(p: OrderMinHash, similarity: float) -> float:
    return 1 - math.pow(1 - math.pow(similarity, p.per_key), p.tables)
