"""Split text into the pieces that byte-pair merges stay within, by byte classes.

Two public patterns are known here. ``SPACED`` keeps one space before a piece and white
space as pieces of its own; ``WORDS`` lower-cases, drops white space and takes digits one by
one. Rows made of printable ASCII and Latin-1 letters are split with numpy; all other rows
(other scripts, controls, special tokens in the text) are for the tokenizers library's own
splitter, so that its Unicode tables decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from tidegauge.llm.bytesops import Rolling, Words

_LETTER, _DIGIT, _OTHER, _SPACE = range(4)


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    table[65:91] = table[97:123] = table[128:] = _LETTER
    table[48:58] = _DIGIT
    table[[9, 10, 13, 32]] = _SPACE
    return table


def _strange_table() -> np.ndarray:
    table = np.ones(256, bool)
    table[[9, 10, 13]] = False
    table[32:127] = False
    table[0x80:0xC0] = table[0xC3] = False
    return table


_CLASS, _STRANGE = _class_table(), _strange_table()


def plain_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of printable ASCII, tabs, line ends and Latin-1 letters without ``<|``."""
    bad = _STRANGE[data]
    lead = np.nonzero(data == 0xC3)[0]
    follows = np.zeros(len(data) + 1, bool)
    follows[lead + 1] = True
    bad |= (data >= 0x80) & (data < 0xC0) & ~follows[:-1]
    sign = lead[np.isin(data[np.minimum(lead + 1, len(data) - 1)], (0x97, 0xB7))]
    bad[sign] = True
    bad[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
    before = np.concatenate(([0], np.cumsum(bad)))
    return before[offsets[1:]] == before[offsets[:-1]]


def _contractions(data: np.ndarray, kinds: np.ndarray, edge: np.ndarray, spaced: bool):
    """Where 's 't 'm 'd 're 've 'll begin and end."""
    n = len(data)
    at = np.nonzero(data == 39)[0]
    before = np.maximum(at - 1, 0)
    free = edge[at] | (kinds[before] != _OTHER)
    if spaced:
        free &= edge[at] | (data[before] != 32)
    at = at[free & (at + 1 < n)]
    at = at[~edge[at + 1]]
    one = data[at + 1]
    has_two = (at + 2 < n) & ~edge[np.minimum(at + 2, n)]
    two = np.where(has_two, data[np.minimum(at + 2, n - 1)], 0)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    length = np.where(short, 2, np.where(pair, 3, 0))
    return at[length > 0], (at + length)[length > 0]


def split(data: np.ndarray, offsets: np.ndarray, spaced: bool) -> Words:
    """Pieces of rows that ``plain_rows`` accepts."""
    n = len(data)
    kinds = _CLASS[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    previous = np.empty(n, np.uint8)
    previous[:1] = _SPACE
    previous[1:] = kinds[:-1]
    blank = kinds == _SPACE
    begins = (kinds != previous) | edge[:n]
    if spaced:
        after_space = np.zeros(n, bool)
        after_space[1:] = data[:-1] == 32
        begins &= edge[:n] | ~after_space | blank
        last = np.zeros(n, bool)
        last[:-1] = blank[:-1] & ~blank[1:]
        begins |= last & ~edge[1:]
    else:
        begins |= kinds == _DIGIT
        begins &= ~blank
    starts_at, ends_at = _contractions(data, kinds, edge, spaced)
    begins[starts_at] = True
    begins[starts_at + 1] = False
    inner = ends_at[ends_at < n]
    begins[inner] = True if spaced else begins[inner] | ~blank[inner]
    starts = np.nonzero(begins)[0]
    if spaced:
        ends = np.append(starts[1:], n)
    else:
        stops = np.zeros(n + 1, bool)
        stops[:n] = begins | blank | edge[:n]
        stops[n] = True
        stop = np.nonzero(stops)[0]
        ends = stop[np.searchsorted(stop, starts, side="right")] if len(starts) else starts
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, rows, first)


def distinct(data: np.ndarray, spans: Words) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces and the number of each piece's own.

    Pieces are told apart by a 64-bit hash; a second hash of every piece is held against its
    representative's, and if one differs, the bytes themselves decide.
    """
    hashes = Rolling(data).ranges(spans.starts, spans.ends)
    numbers, found = pd.factorize(hashes)
    at = np.empty(len(found), np.int64)
    at[numbers[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    check = Rolling(data, second=True).ranges(spans.starts, spans.ends)
    raw = data.tobytes()
    if (check[at][numbers] != check).any():
        known: dict[bytes, int] = {}
        pieces = (raw[s:e] for s, e in zip(spans.starts, spans.ends, strict=True))
        numbers = np.fromiter((known.setdefault(p, len(known)) for p in pieces), np.int64)
        return list(known), numbers
    starts, ends = spans.starts[at].tolist(), spans.ends[at].tolist()
    return [raw[s:e] for s, e in zip(starts, ends, strict=True)], numbers
