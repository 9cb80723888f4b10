"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

1. Terms are hashed words. Passages of 64 words give document frequencies over the corpus.
2. A randomised singular value decomposition of the TF-IDF matrix A of all passages: with
   a random matrix R every task adds up A'(A R) and (A R)'(A R) of its passages, the sums
   give the leading right singular vectors and values. One pass; sums have terms x rank
   numbers. Latent coordinates are divided by the singular values, so that what all
   texts of a language share does not outweigh the rest.
3. Search: windows about as long as an item, a quarter of it apart, of every document are
   compared with every item by the cosine of their latent vectors. Windows of at least
   ``near`` are candidates; no region without one is aligned. ``near`` is low, since an item with
   45 % of its words replaced must still be found; tests measure the share that is.
4. Candidates are checked. First by an exact bound: a region of twice the item's length
   around the window must hold so many of the item's rarest words that its share of words
   in order can be reached (the bound leaves out no region that the check would take; it is
   worked out for the batch first, and the regions kept are those that hold a candidate). Then
   the longest common subsequence of item and region must hold most of the item's words, or
   a good part of them and the item's answer.

The benchmark and what is made from it are constants of the plan, with a checked size.
Documents are not shuffled; only sums are.

An item's answer is the column of that name, if there is one, else its last sentence.
Items longer than 64 words are searched by pieces of 64, half overlapping.

Items of fewer than 8 words are too short to be told from chance when reworded: they are
found where all their words stand together in order, by hashes of runs of words, with 1
as their cosine and share.

Defined cases: NULL texts count as empty and match nothing; NULL items and items without
words are ignored; repeated items and documents each give their rows; a NULL key is kept as a key; without items or documents
the result is empty; columns besides the named ones are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.alignment import common_subsequence
from corpusloom.llm.files import releasing, shared_folder, written
from corpusloom.llm.shingles import mix, word_hashes


@dataclass(frozen=True)
class Latent:
    """Parameters."""

    terms: int = 1 << 15
    rank: int = 32
    passage: int = 64
    #: Shorter items are searched word for word.
    least_words: int = 8
    #: Cosine from which a window is a candidate.
    near: float = 0.2
    #: Of an item's rarest words so many must occur in a region; more words are looked up for that.
    rare_words: int = 4
    #: Share of an item's words in order that decides alone, or together with the answer.
    common: float = 0.8
    common_with_answer: float = 0.55
    answer_common: float = 0.8
    seed: int = 11
    max_items: int = 200_000
    max_item_words: int = 20_000_000


_BLOCK = 512
#: Words of the windows the search compares with the items; those of the least width that holds an item.
_WIDTHS = (8, 12, 16, 24, 32, 48, 64)
#: Words and items of one matrix of cosines.
_SPAN, _GROUP = 1 << 15, 256
_BITS = 22
OUTPUT = "item long, cosine double, common double, answer boolean, first_word long, words long"


def _terms(hashes: np.ndarray, p: Latent) -> np.ndarray:
    return (hashes % np.uint64(p.terms)).astype(np.int64)


def _passages(first: np.ndarray, size: int) -> np.ndarray:
    """Where passages start: every ``size`` words from the start of each text."""
    lengths = np.diff(first)
    counts = -(-lengths // size)
    before = np.cumsum(counts) - counts
    return np.repeat(first[:-1] - size * before, counts) + size * np.arange(counts.sum())


def _first_uses(terms: np.ndarray, starts: np.ndarray, p: Latent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (passage, term) pairs and how often each occurs."""
    passage = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(terms)))
    pair, times = np.unique(passage * p.terms + terms, return_counts=True)
    return pair // p.terms, pair % p.terms, times


def _word_batches(batches: Iterator[pa.RecordBatch], p: Latent, chars: int = 1 << 20):
    """(part of a batch, word hashes, where each text begins) for about ``chars`` characters at a time."""
    for batch in batches:
        begin, texts, total = 0, [], 0
        for i, text in enumerate(batch["text"]):
            texts.append(text.as_py() or "")
            total += len(texts[-1])
            if total >= chars or i == batch.num_rows - 1:
                yield (batch.slice(begin, len(texts)), *word_hashes(texts, alnum=True))
                begin, texts, total = i + 1, [], 0


def _summed(partial: DataFrame, kind: type) -> dict[int, np.ndarray]:
    """Sum arrays that tasks return as rows (block, values); streams, so memory holds one sum per block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, values in zip(batch["block"].to_pylist(), batch["values"].to_pylist(), strict=True):
                part = np.frombuffer(values, kind)
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            ["block", "values"],
        )

    rows = partial.repartition("block").mapInArrow(releasing(add), "block int, values binary").collect()
    return {row["block"]: np.frombuffer(row["values"], kind) for row in rows}


def _frequencies(terms: DataFrame, p: Latent) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and the number of passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.terms + 1, np.int64)
        for batch in batches:
            for found, first in _stored(batch):
                starts = _passages(first, p.passage)
                _, term, _ = _first_uses(found, starts, p)
                total[:-1] += np.bincount(term, minlength=p.terms)
                total[-1] += len(starts)
        blocks = [*total[:-1].reshape(-1, _BLOCK), total[-1:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(len(blocks) - 1), -1], pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
            ["block", "values"],
        )

    found = _summed(terms.mapInArrow(releasing(count), "block int, values binary"), np.int64)
    if not found:
        return np.zeros(p.terms, np.int64), 0
    passages = int(found.pop(-1)[0])
    return np.concatenate([found[k] for k in sorted(found)]), passages


def _stored(batch: pa.RecordBatch, least: int = 1 << 18):
    """Term numbers of a stored batch in parts of about ``least`` words, with the starts of the texts."""
    held, words = [], 0
    for i, blob in enumerate(batch["terms"]):
        held.append(np.frombuffer(blob.as_py(), "<u2"))
        words += len(held[-1])
        if words >= least or i == batch.num_rows - 1:
            yield np.concatenate(held).astype(np.int64), np.cumsum([0] + [len(x) for x in held])
            held, words = [], 0


def _store_terms(narrow: DataFrame, p: Latent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, first in _word_batches(batches, p):
            terms = _terms(hashes, p).astype("<u2")
            blobs = [terms[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary())], ["terms"])

    return narrow.select("text").mapInArrow(releasing(run), "terms binary")


def _random(p: Latent) -> np.ndarray:
    return np.random.default_rng(p.seed).normal(size=(p.terms, p.rank)).astype(np.float32)


def _basis(terms: DataFrame, idf: np.ndarray, p: Latent) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF matrix of all passages, each divided by its value (terms x rank)."""
    shared = terms.sparkSession.sparkContext.broadcast(idf)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, weight = np.ascontiguousarray(_random(p).T), shared.value
        image = np.zeros((p.rank, p.terms), np.float64)
        core = np.zeros((p.rank, p.rank), np.float64)
        for batch in batches:
            for found, first in _stored(batch):
                starts = _passages(first, p.passage)
                if not len(starts):
                    continue
                passage, term, times = _first_uses(found, starts, p)
                value = (times * weight[term]).astype(np.float32)
                norm = np.sqrt(np.bincount(passage, value.astype(np.float64) ** 2, len(starts)))
                value /= np.maximum(norm, 1e-9)[passage].astype(np.float32)
                y = np.array([np.bincount(passage, value * row[term], len(starts)) for row in random])
                core += y @ y.T
                for k in range(p.rank):
                    image[k] += np.bincount(term, value * y[k][passage], p.terms)
        blocks = np.ascontiguousarray(image.T.astype(np.float32)).reshape(-1, _BLOCK * p.rank)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*range(len(blocks)), -1], pa.int32()),
                pa.array([*(b.tobytes() for b in blocks), core.astype(np.float32).tobytes()], pa.binary()),
            ],
            ["block", "values"],
        )

    sums = _summed(terms.mapInArrow(releasing(add), "block int, values binary"), np.float32)
    if not sums:
        return np.zeros((p.terms, p.rank), np.float32)
    core = sums.pop(-1).reshape(p.rank, p.rank).astype(np.float64)
    image = np.concatenate([sums[k] for k in sorted(sums)]).reshape(p.terms, p.rank).astype(np.float64)
    # A'A is about image core^-1 image' = half half' with half = image L'^-1 and core = L L';
    # its leading vectors are half times the eigenvectors of half' half, scaled to length 1.
    core = (core + core.T) / 2 + np.eye(p.rank) * max(np.trace(core) / p.rank * 1e-6, 1e-12)
    half = image @ np.linalg.inv(np.linalg.cholesky(core)).T
    values, vectors = np.linalg.eigh(half.T @ half)
    # Once for the length of the vector, once for the value; values near 0 are those of a small corpus.
    return (half @ vectors / np.maximum(values, max(values[-1] * 1e-6, 1e-12)))[:, ::-1].astype(np.float32)


@dataclass(frozen=True)
class Piece:
    item: int
    words: np.ndarray
    answer: np.ndarray


def _last_sentence(text: str) -> str:
    return ([s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s] or [""])[-1]


def _pieces(benchmark: DataFrame, p: Latent, item: str, text: str, answer: str | None) -> list[Piece]:
    chosen = [F.col(item).cast("long"), F.col(text).cast("string")]
    chosen.append(F.col(answer).cast("string") if answer else F.lit(None).cast("string"))
    words = F.size(F.split(chosen[1], r"\s+"))
    sizes = benchmark.agg(F.count(F.lit(1)).alias("n"), F.sum(words).alias("words")).first()
    if sizes["n"] > p.max_items or (sizes["words"] or 0) > p.max_item_words:
        raise ValueError(f"the benchmark has more than {p.max_items} items or {p.max_item_words} words")
    found = []
    for name, body, given in benchmark.select(*[c.alias(f"c{i}") for i, c in enumerate(chosen)]).collect():
        if name is None or body is None:
            continue
        whole = word_hashes([body], alnum=True)[0]
        reply = word_hashes([given if given is not None else _last_sentence(body)], alnum=True)[0]
        if not len(whole):
            continue
        starts = [0] if len(whole) <= p.passage else [*range(0, len(whole) - p.passage, p.passage // 2), len(whole) - p.passage]
        found += [Piece(name, whole[s : s + p.passage], reply) for s in starts]
    return found


def _prefix_sums(rows: np.ndarray, block: int = 64) -> np.ndarray:
    """Sums of all rows before each; blocks side by side, as numpy adds few long rows faster than many short ones."""
    blocks = np.zeros((len(rows) // block + 1, block, rows.shape[1]), rows.dtype)
    blocks.reshape(-1, rows.shape[1])[1 : len(rows) + 1] = rows
    for i in range(1, block):
        blocks[:, i] += blocks[:, i - 1]
    blocks[1:] += np.cumsum(blocks[:-1, -1], axis=0)[:, None]
    return blocks.reshape(-1, rows.shape[1])[: len(rows) + 1]


def _windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and middle of windows a quarter of ``width`` apart that cover each text."""
    step = width // 4
    lengths = np.diff(first)
    counts = np.where(lengths > 0, -(-np.maximum(lengths - width, 0) // step) + 1, 0)
    before = np.cumsum(counts) - counts
    begin = np.repeat(first[:-1] - step * before, counts) + step * np.arange(counts.sum())
    end = np.minimum(begin + width, np.repeat(first[1:], counts))
    return begin, end, (begin + end) // 2


class _Runs:
    """Finds short items word for word, by hashes of runs of as many words."""

    def __init__(self, pieces: list[Piece]):
        self.lengths = {}
        for n in {len(piece.words) for piece in pieces}:
            same = [piece for piece in pieces if len(piece.words) == n]
            keys = np.array([self._keys(piece.words, n)[0] for piece in same])
            order = np.argsort(keys, kind="stable")
            self.lengths[n] = keys[order], [same[i] for i in order]

    @staticmethod
    def _keys(hashes: np.ndarray, n: int) -> np.ndarray:
        keys = hashes[: len(hashes) - n + 1].copy()
        for i in range(1, n):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i])
        return keys

    def search(self, hashes: np.ndarray, first: np.ndarray, p: Latent) -> list[tuple[int, int, float, float, bool, int, int]]:
        hits = []
        for n, (keys, pieces) in self.lengths.items():
            if len(hashes) < n:
                continue
            own = self._keys(hashes, n)
            low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
            seen = set()
            for at in np.flatnonzero(low < high):
                text = int(np.searchsorted(first, at, side="right") - 1)
                for k in range(low[at], high[at]):
                    piece = pieces[k]
                    if (text, k) in seen or at + n > first[text + 1] or not np.array_equal(hashes[at : at + n], piece.words):
                        continue
                    seen.add((text, k))
                    reach = len(piece.answer)
                    around = hashes[max(int(first[text]), at - reach) : min(int(first[text + 1]), at + n + reach)]
                    answered = bool(reach) and common_subsequence(piece.answer, around) >= p.answer_common * reach
                    hits.append((text, piece.item, 1.0, 1.0, answered, int(at - first[text]), n))
        return hits


class Searcher:
    """Finds the pieces in texts. Made on the driver, used in tasks."""

    def __init__(self, pieces: list[Piece], weights: np.ndarray, basis: np.ndarray, p: Latent):
        self.p = p
        self.projected = (basis * weights[:, None]).astype(np.float32)
        self.runs = _Runs([piece for piece in pieces if len(piece.words) < p.least_words])
        self.pieces = pieces = [piece for piece in pieces if len(piece.words) >= p.least_words]
        if pieces:
            self._prepare(pieces, weights)

    def _prepare(self, pieces: list[Piece], weights: np.ndarray) -> None:
        p = self.p
        self.size = np.array([len(piece.words) for piece in pieces])
        self.need = np.ceil(np.round(p.common_with_answer * self.size, 9)).astype(np.int64)
        self.region = self.size + 2 * (self.size // 2 + 1)
        self.step = np.maximum(1, self.size // 8)
        self.rare = np.minimum(p.rare_words, self.need)
        self.full = np.array([(1 << len(piece.words)) - 1 for piece in pieces], np.uint64)
        self.words = np.unique(np.concatenate([piece.words for piece in pieces]))
        vectors = np.zeros((len(pieces), self.projected.shape[1]), np.float32)
        keys, masks, rare = [], [], []
        for i, piece in enumerate(pieces):
            terms = _terms(piece.words, p)
            vectors[i] = self.projected[terms].sum(axis=0)
            own, place = np.unique(piece.words, return_inverse=True)
            mask = np.zeros(len(own), np.uint64)
            np.bitwise_or.at(mask, place, np.uint64(1) << np.arange(len(place), dtype=np.uint64))
            keys.append(np.searchsorted(self.words, own) + i * len(self.words))
            masks.append(mask)
            # At most size - need words are missing, so of size - need + rare words at least rare are found.
            looked = np.argsort(-weights[terms], kind="stable")[: len(terms) - self.need[i] + self.rare[i]]
            rare.append(np.searchsorted(self.words, np.unique(piece.words[looked])) + i * len(self.words))
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
        width = np.searchsorted(_WIDTHS, self.size)
        self.groups = [
            (_WIDTHS[w], members[at : at + _GROUP])
            for w in np.unique(width)
            for members in [np.flatnonzero(width == w)]
            for at in range(0, len(members), _GROUP)
        ]
        self.group, self.column = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for number, (_, members) in enumerate(self.groups):
            self.group[members], self.column[members] = number, np.arange(len(members))
        self.keys, self.masks = np.concatenate(keys), np.concatenate(masks)
        word, self.rare_piece = np.concatenate(rare) % len(self.words), np.concatenate(rare) // len(self.words)
        order = np.argsort(word, kind="stable")
        self.rare_piece = self.rare_piece[order]
        self.rare_first = np.searchsorted(word[order], np.arange(len(self.words) + 1))
        self.marked = np.zeros(1 << _BITS, bool)
        self.marked[(self.words >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def search(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float, float, bool, int, int]]:
        """(text, piece's item, cosine, common, answer, first word, words) of every match."""
        hits = self.runs.search(hashes, first, self.p)
        if not self.pieces or not len(hashes):
            return hits
        known = np.full(len(hashes), -1)
        places = np.flatnonzero(self.marked[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, hashes[places]), len(self.words) - 1)
        same = self.words[at] == hashes[places]
        known[places[same]] = at[same]
        piece, start, text = self._regions(known, first)
        stop = np.minimum(start + self.region[piece], first[text + 1])
        near = self._retrieved(_terms(hashes, self.p), first, piece, start, stop)
        piece, start, stop, text = piece[near], start[near], stop[near], text[near]
        passed: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        for low in range(0, len(piece), 4096):
            part = slice(low, low + 4096)
            common = self._common(known, piece[part], start[part], stop[part])
            for k in np.flatnonzero(common >= self.need[piece[part]]):
                passed[int(text[low + k]), int(piece[low + k])].append((-int(common[k]), int(start[low + k]), int(stop[low + k])))
        return hits + [hit for (text, i), regions in passed.items() if (hit := self._verify(hashes, first, text, i, regions))]

    def _retrieved(self, terms: np.ndarray, first: np.ndarray, piece: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Compares all windows with all pieces; which of the regions have the middle of a window near their piece."""
        found = np.zeros(len(piece), bool)
        order = np.argsort(start, kind="stable")
        windows = {width: _windows(first, width) for width, _ in self.groups}
        reach = int(self.region.max())
        for low in range(0, len(terms), _SPAN):
            here = order[slice(*np.searchsorted(start, [low, low + _SPAN], sorter=order))]
            group = self.group[piece[here]]
            base = max(0, low - _WIDTHS[-1])
            part = self.projected[terms[base : low + _SPAN + reach + _WIDTHS[-1]]]
            sums = _prefix_sums(part)
            drawn = 0
            for number, (width, members) in enumerate(self.groups):
                if width != drawn:
                    begin, end, middle = windows[width]
                    inside = slice(*np.searchsorted(middle, [low, low + _SPAN + reach]))
                    middle = middle[inside]
                    vectors = sums[end[inside] - base] - sums[begin[inside] - base]
                    limit = (self.p.near * np.sqrt(np.einsum("ij,ij->i", vectors, vectors)))[:, None]
                    drawn = width
                near = vectors @ self.vectors[members].T >= np.maximum(limit, 1e-9)
                own = here[group == number]
                at, last = np.searchsorted(middle, start[own]), np.searchsorted(middle, stop[own])
                while len(own):
                    more = at < last
                    own, at, last = own[more], at[more], last[more]
                    found[own] |= near[at, self.column[piece[own]]]
                    at = at + 1
        return found

    def _regions(self, known: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, first word and text of the regions with enough of the piece's rarest words: no others can pass the check."""
        place = np.flatnonzero(known >= 0)
        word = known[place]
        times = self.rare_first[word + 1] - self.rare_first[word]
        before = np.cumsum(times) - times
        entry = np.repeat(self.rare_first[word] - before, times) + np.arange(times.sum())
        key = self.rare_piece[entry] * len(known) + np.repeat(place, times)
        key.sort()
        piece, place = np.divmod(key, max(len(known), 1))
        last = np.arange(len(key)) + self.rare[piece] - 1
        near = last < len(key)
        last = np.minimum(last, len(key) - 1)
        near &= (piece[last] == piece) & (place[last] - place < self.region[piece])
        piece, place, last = piece[near], place[near], place[last[near]]
        text = np.searchsorted(first, place, side="right") - 1
        near = last < first[text + 1]
        piece, place, last, text = piece[near], place[near], last[near], text[near]
        begin, step, region = first[text], self.step[piece], self.region[piece]
        low = np.maximum(0, -((begin + region - 1 - last) // step))
        high = np.minimum((place - begin) // step, np.maximum(0, -((begin + region - first[text + 1]) // step)))
        times = np.maximum(0, high - low + 1)
        before = np.cumsum(times) - times
        turn = np.repeat(low - before, times) + np.arange(times.sum())
        key = np.unique(np.repeat(piece * len(known) + begin, times) + turn * np.repeat(step, times))
        piece, start = np.divmod(key, max(len(known), 1))
        return piece, start, np.searchsorted(first, start, side="right") - 1

    def _common(self, known: np.ndarray, piece: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Longest common subsequences of pieces and regions; a bit per word of the piece, as in ``alignment``."""
        places = start + np.arange(int((stop - start).max(initial=0)))[:, None]
        found = known[np.minimum(places, len(known) - 1)]
        found[places >= stop] = -1
        row, column = np.nonzero(found >= 0)
        looked = found[row, column] + piece[column] * len(self.words)
        at = np.minimum(np.searchsorted(self.keys, looked), len(self.keys) - 1)
        match = np.zeros(found.shape, np.uint64)
        match[row, column] = np.where(self.keys[at] == looked, self.masks[at], np.uint64(0))
        enough = np.flatnonzero((match > 0).sum(axis=0) >= self.need[piece])
        full = self.full[piece[enough]]
        left = full.copy()
        for own in match[:, enough]:
            kept = left & own
            left = ((left + kept) | (left - kept)) & full
        common = np.zeros(len(piece), np.int64)
        common[enough] = self.size[piece[enough]] - np.bitwise_count(left)
        return common

    def _cosine(self, terms: np.ndarray, i: int) -> float:
        """The best cosine of the piece and windows of its length."""
        size, step = int(self.size[i]), int(self.step[i])
        sums = np.concatenate([np.zeros((1, self.vectors.shape[1])), np.cumsum(self.projected[terms], axis=0, dtype=np.float64)])
        begin = np.arange(0, max(len(terms) - size, 0) + 1, step)
        vectors = sums[np.minimum(begin + size, len(terms))] - sums[begin]
        return float((vectors @ self.vectors[i] / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)).max())

    def _verify(self, hashes, first, text, i, regions):
        """The best of the regions that passes, one with the answer where they are alike."""
        p, piece = self.p, self.pieces[i]
        best, reach = None, len(piece.answer)
        for less, start, stop in sorted(regions):
            common = -less / len(piece.words)
            if best is not None and common < best[3]:
                break
            around = hashes[max(int(first[text]), start - reach) : min(int(first[text + 1]), stop + reach)]
            answered = bool(reach) and common_subsequence(piece.answer, around) >= p.answer_common * reach
            if answered or (best is None and common >= p.common):
                cosine = self._cosine(_terms(hashes[start:stop], p), i)
                best = (text, piece.item, cosine, common, answered, start - int(first[text]), stop - start)
            if answered:
                break
        return best


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    p: Latent = Latent(),
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
) -> DataFrame:
    """key, item, cosine, common, answer, first_word, words: one row per document row and item found in it."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "decontaminate")
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    pieces = _pieces(benchmark, p, item, item_text, answer)
    if not pieces:
        return narrow.limit(0).selectExpr("key", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in OUTPUT.split(", ")])
    terms = written(_store_terms(narrow, p), f"{folder}/terms")
    held, passages = _frequencies(terms, p)
    idf = np.log1p((passages + 1) / (held + 1)).astype(np.float32)
    searcher = spark.sparkContext.broadcast(Searcher(pieces, idf, _basis(terms, idf, p), p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item", "cosine", "common", "answer", "first_word", "words"]
        for part, hashes, first in _word_batches(batches, p):
            best: dict[tuple[int, int], tuple] = {}
            for hit in searcher.value.search(hashes, first):
                if hit[:2] not in best or hit[3] > best[hit[:2]][3]:
                    best[hit[:2]] = hit
            if best:
                rows = list(zip(*best.values(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part["key"].take(pa.array(rows[0], pa.int64())), *[pa.array(c) for c in rows[1:]]], ["key", *names]
                )

    return narrow.mapInArrow(releasing(run), f"key {kind}, {OUTPUT}")
