"""Word and shingle hashes of whole texts, many documents at a time with numpy.

Words are maximal runs of bytes other than space and 0x09 to 0x0D, with A to Z lower-cased; other
bytes count as they are.  A word's hash is a polynomial over a table of random 64-bit numbers, and
a shingle's hash mixes the hashes of its words, so equal words give equal hashes everywhere and
different ones collide with a probability near 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[65:91] = _TABLE[97:123]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIXERS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 20  # bytes of text hashed at once; a longer text is a chunk of its own


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) of stretches of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        stop = min(stop, n)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each document the number of words before it (one more at the end)."""
    docs = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    inside = ~_SEPARATOR[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    opens[first] = inside[first]
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(opens[at])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    lengths = np.diff(starts, append=len(at))
    powers = np.cumprod(np.full(int(lengths.max()), _FACTOR))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    hashes = np.add.reduceat(_TABLE[data[at]] * powers[place], starts)
    return mixed(hashes), np.searchsorted(at[starts], offsets)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; the one at place i starts with word i."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += words[j:j + n] * MIXERS[j]
    return mixed(total)


def shingle_set(words: np.ndarray, runs: np.ndarray, first: int, stop: int, width: int) -> np.ndarray:
    """Sorted distinct shingles of the document whose words are first..stop; with fewer words than
    ``width`` the whole sequence is its one shingle."""
    n = stop - first
    if n >= width:
        return np.unique(runs[first:stop - width + 1])
    if n == 0:
        return np.zeros(0, np.uint64)
    few = words[first:stop]
    return mixed((few * MIXERS[32:32 + n]).sum(keepdims=True) + np.uint64(n))
