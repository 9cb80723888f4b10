"""Banded alignment of two sequences of numbers: their longest common subsequence."""

from __future__ import annotations

import math

import numpy as np


def common_subsequence(a: np.ndarray, b: np.ndarray, band: int | None = None) -> int:
    """Length of the longest common subsequence, of pairs at most ``band`` places apart.

    A row of the alignment matrix is one integer with a bit per element of ``a``; a step
    is an addition and a few logical operations on it. Matches outside the band are
    masked away.
    """
    if not len(a) or not len(b):
        return 0
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    window = full if band is None else (1 << 2 * band + 1) - 1
    row = full
    for j, x in enumerate(b.tolist()):
        match = where.get(x, 0)
        if match and band is not None:
            match &= window << j - band if j >= band else window >> band - j
        if match:
            kept = row & match
            row = ((row + kept) | (row - kept)) & full
    return len(a) - row.bit_count()


def ordered_similarity(a: np.ndarray, b: np.ndarray, floor: float) -> float:
    """Common subsequence over union: L / (len(a) + len(b) - L); 0.0 if it is below ``floor``.

    That floor leaves at most len(a) + len(b) - 2 L elements unpaired, which is the width
    of the band. Equal beginnings and ends are paired first, as some best alignment does.
    """
    n, m = len(a), len(b)
    need = math.ceil(round(floor * (n + m) / (1 + floor), 9))
    if not n or not m or min(n, m) < need:
        return 0.0
    band = n + m - 2 * need
    short = min(n, m)
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    rest = short - head
    differs = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differs[0]) if len(differs) else rest
    a, b = a[head : n - tail], b[head : m - tail]
    if head + tail + min(len(a), len(b)) < need:
        return 0.0
    if head + tail + np.isin(a, b).sum() < need:
        return 0.0
    paired = head + tail + common_subsequence(a, b, band)
    return paired / (n + m - paired) if paired >= need else 0.0
