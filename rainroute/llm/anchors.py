"""Stretches of documents that may hold a window of symbols repeated elsewhere.

Every window of ``width`` symbols is owned by the smallest hash among its
stretches of ``k`` symbols (the leftmost of equal ones). Equal windows have
equal owners at equal places, so a window can be repeated only within documents
whose owners hash alike. The windows with one owner stand side by side; with their
symbols they make a segment. About 2 / (width - k + 2) segments per symbol.
"""

from __future__ import annotations

import numpy as np

from . import text


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i that has a whole range."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def segments(symbols: np.ndarray, bounds: np.ndarray, width: int, k: int):
    """Segments of rows of symbols (``bounds``: rows + 1 offsets, at most 2**24 symbols).

    Returns row, first and last window start and the owner's place within the row,
    owner hash and segment hash.
    """
    n = len(symbols)
    none = np.empty(0, np.int64)
    if n < width:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = text.prefix_sums(symbols)
    at = np.arange(n - k + 1)
    grams = text.stretch(sums, at, at + k)
    packed = (grams & np.uint64(0xFFFFFFFFFF000000)) | at.astype(np.uint64)
    owner = (sliding_minimum(packed, width - k + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    row = np.searchsorted(bounds, np.arange(len(owner)), side="right") - 1
    whole = np.arange(len(owner)) + width <= bounds[row + 1]
    change = np.ones(len(owner), dtype=bool)
    change[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1]) | ~whole[:-1]
    first = np.flatnonzero(change & whole)
    stops = np.append(np.flatnonzero(change | ~whole), len(owner))
    last = stops[np.searchsorted(stops, first, side="right")] - 1
    rows = row[first]
    return (
        rows,
        first - bounds[rows],
        last - bounds[rows],
        owner[first] - bounds[rows],
        grams[owner[first]],
        text.stretch(sums, first, last + width),
    )
