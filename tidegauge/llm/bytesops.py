"""Whole columns of text as one run of UTF-8 bytes, and vectorised work on it.

Tasks get text as Arrow columns. Nothing here makes a Python object for a word or a
character: words, windows and their hashes are numpy arrays over the bytes of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SECOND_BASE = 0xC2B2AE3D27D4EB4F

# The constants of the splitmix64 finaliser.
_MIX_1 = U64(0xBF58476D1CE4E5B9)
_MIX_2 = U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x *= _MIX_1
    x ^= x >> U64(27)
    x *= _MIX_2
    x ^= x >> U64(31)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """An independent 64-bit hash of ``x`` for each ``seed``."""
    return mix(x ^ U64((seed * _BASE + 0x632BE59BD9B4E019) % (1 << 64)))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


@cache
def _tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``base`` and of its inverse, modulo 2**64."""

    def powers(b: int) -> np.ndarray:
        out = np.empty(size, U64)
        out[0] = 1
        done = 1
        while done < size:
            more = min(done, size - done)
            out[done : done + more] = out[:more] * U64(pow(b, done, 1 << 64))
            done += more
        return out

    return powers(base), powers(pow(base, -1, 1 << 64))


class Rolling:
    """Hashes of any byte ranges of ``data``, from one pass over it."""

    def __init__(self, data: np.ndarray, second: bool = False) -> None:
        base = _SECOND_BASE if second else _BASE
        size = 1 << max(16, int(len(data)).bit_length())
        self._powers, self._inverse = _tables(base, size)
        self._sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self._powers[: len(data)], out=self._sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes at every position that has so many."""
        count = max(0, len(self._sums) - width)
        out = self._sums[width:] - self._sums[:count]
        out *= self._inverse[:count]
        return mix(out)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self._sums[ends] - self._sums[starts]
        out *= self._inverse[starts]
        out += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
        return mix(out)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row; NULL is empty text."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` rows with at most ``limit`` bytes together, or of one row that
    has more."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(rows, low + most, max(high, low + 1))
        yield low, high
        low = high


# --- Words --------------------------------------------------------------------


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _word_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


_LOWER, _WORD = _lower_table(), _word_table()


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters; all other characters stay."""
    out = _LOWER[data]
    after = np.nonzero(data[:-1] == 0xC3)[0] + 1
    second = data[after]
    after = after[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]
    out[after] += 32
    return out


class Words(NamedTuple):
    """Words of a slice: byte range, row, and the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray


def runs(member: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of ``member`` bytes that don't cross a row."""
    n = len(member)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = member[:-1]
    starts = np.nonzero(member & (~before | edge[:n]))[0]
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = member[1:]
    ends = np.nonzero(member & (~after | edge[1:]))[0] + 1
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, rows, first)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of ASCII letters, digits and bytes of other characters."""
    return runs(_WORD[data], offsets)


def shingles(hashes: np.ndarray, spans: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, their rows, and the first of each row.

    A row with fewer words has one shingle of all its words; one without words has none.
    """
    counts = np.diff(spans.first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(made)))
    rows = np.repeat(np.arange(len(counts)), made)
    at = spans.first[rows] + np.arange(first[-1]) - first[rows]
    out = np.zeros(len(at), U64)
    for k in range(size):
        there = at + k < spans.first[rows + 1]
        word = hashes[np.where(there, at + k, 0)] if len(hashes) else out
        out = mix(out + np.where(there, word, U64(k + 1)))
    return out, rows, first


def counted(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) with their counts, in that order."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    at = np.nonzero(new)[0]
    return hashes[at], rows[at], np.diff(np.append(at, len(hashes)))


def gathered(first: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices that lay the ranges ``first[p]:first[p + 1]`` of ``picks`` one after another,
    and where each of them then begins."""
    sizes = first[picks + 1] - first[picks]
    begins = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(first[picks] - begins[:-1], sizes) + np.arange(begins[-1]), begins
