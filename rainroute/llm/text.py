"""Text as numpy arrays: words and 64-bit hashes of words and of stretches of symbols.

Used inside Arrow tasks. A column of texts is read as one byte buffer with
offsets, cut into pieces of bounded size, so memory per task does not grow with
the batch. Hashes are sums of a random value per symbol times a power of an odd
base, modulo 2**64, so the hash of any stretch is one difference of prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes of text handled at a time

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n and base**-0..-n modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) <= n:
        size = max(n + 1, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    up, _ = powers(len(symbols))
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * up[: len(symbols)], out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:stop], the same wherever these symbols stand."""
    _, down = powers(len(sums))
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets if len(offsets) else np.zeros(len(column) + 1, np.int64)


def runs(offsets: np.ndarray, limit: int = PIECE, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and ``most`` rows each; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), row + most, rows)
        yield row, stop
        row = stop


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Separators of ``[^\x20\x09-\x0D]+``.
SPACE = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
PUNCTUATION = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of every word; a word ends where its text ends."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offsets[1:-1]
    at = at[(at > 0) & (at < len(data))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return stretch(prefix_sums(constants(256, 11)[data]), start, stop)


def word_counts(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of each row's words in the list of all words (rows + 1)."""
    return np.searchsorted(start, offsets, side="left")
