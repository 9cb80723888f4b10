"""Word shingles of texts as 64-bit numbers, for many texts at once in numpy.

Words are runs of other bytes than ASCII white space in the lower-cased text, or runs of
ASCII letters and digits and bytes of other characters where punctuation is to be left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def word_hashes(texts: Sequence[str], *, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where the words of each text begin (one more at the end).

    The hash of a word is a difference of prefix sums of byte x power, scaled to the
    first power, so all words of a batch are hashed in a few array operations.
    """
    blobs = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    word = _ALNUM[data] if alnum else data > 32
    edge = np.flatnonzero(np.diff(word, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts])
    first_byte = np.cumsum([0] + [len(blob) + 1 for blob in blobs])
    return hashes, np.searchsorted(starts, first_byte)


def shingles_of_words(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words; a shorter text, unless empty, is one shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - size + 1 + i]
    return mix(out)


def numbered(shingles: np.ndarray) -> np.ndarray:
    """Tell repeats of a shingle within its text apart by their number: the first keeps its value."""
    ordered = np.sort(shingles)
    if not (ordered[1:] == ordered[:-1]).any():
        return shingles
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(len(ordered))
    times = place - np.maximum.accumulate(np.where(new, place, 0))
    out = np.empty_like(shingles)
    out[order] = np.where(times > 0, mix(ordered + times.astype(np.uint64) * np.uint64(_BASE)), ordered)
    return out
