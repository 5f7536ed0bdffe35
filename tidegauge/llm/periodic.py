"""Stretches of words that repeat themselves with a period, by a dictionary of basic factors.

A basic factor is a stretch of 2**k words; equal ones of a text get the same name. The names of
level k + 1 are pairs of names of level k, and a position whose factor occurs once in its text
has a name of its own, which needs no further work: in prose nearly all positions drop out after
a few levels.

A run of smallest period q holds at least 2 * q words. With 2**(k + 1) <= q < 2**(k + 2), one of
its first 2**k places is a multiple of 2**k, and the factor of level k there occurs again q words
on. So the occurrences of an anchor's name between 2 and 4 times its length further on propose
all periods; there are at most twice as many proposals a level as words. Each is extended to
both sides by comparing names from the top level down, and proposals of one stretch become its
least period. Names are exact, so nothing is found or missed by chance.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidegauge.llm import bytesops
from tidegauge.llm.bpe import added

#: Bytes of text whose names are made at once (or one text).
SLICE_BYTES = 1 << 20
#: Proposals that are extended at once.
PROPOSALS = 1 << 19

RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def find_runs(words: np.ndarray, min_length: int = 12) -> Runs:
    """All runs of ``words`` (numbers below 2**31; a negative number equals nothing), by start and
    then by period.

    A run is a stretch whose smallest period q is at most half its length, of at least
    ``min_length`` words, that no neighbour extends keeping period q.
    """
    levels = [_alone(words.astype(np.int64))]
    while 4 << len(levels) <= len(words) and (levels[-1] >= 0).any():
        levels.append(_paired(levels[-1], 1 << (len(levels) - 1)))
    found = [_extended(levels, at, period, min_length) for at, period in _proposed(levels)]
    start, end, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # The least period proposed for a stretch is its smallest; the others are multiples of it.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return Runs(start[order], (end - start)[order], period[order])


def _alone(keys: np.ndarray) -> np.ndarray:
    """Names of keys (not negative) from 0; a key that occurs once, like a negative one, gets a
    negative name that no other place has. One more place, with nothing, comes at the end."""
    names = -1 - np.arange(len(keys) + 1, dtype=np.int64)
    known = np.flatnonzero(keys >= 0)
    if len(known):
        _, inverse, counts = np.unique(keys[known], return_inverse=True, return_counts=True)
        again = counts > 1
        number = np.cumsum(again) - 1
        often = again[inverse]
        names[known[often]] = number[inverse[often]]
    return names.astype(np.int32)


def _paired(names: np.ndarray, size: int) -> np.ndarray:
    """Names of factors of twice the size."""
    here, there = names[:-1].astype(np.int64), np.full(len(names) - 1, -1, np.int64)
    there[:-size] = names[size:-1]
    both = (here >= 0) & (there >= 0)
    return _alone(np.where(both, here * len(names) + there, -1))


def _proposed(levels: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to try: those of 1 from neighbours, and those that each level has."""
    names = levels[0][:-1]
    same = np.flatnonzero(names[1:] == names[:-1])
    yield same, np.ones(len(same), np.int64)
    for k, names in enumerate(levels):
        yield from _proposals(names, 1 << k)


def _proposals(names: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Anchors and the distances, from 2 to 4 times the size, to their other occurrences."""
    total = len(names)
    anchors = np.arange(0, total, size)
    anchors = anchors[names[anchors] >= 0]
    alive = np.flatnonzero(names >= 0)
    keys = np.sort(names[alive].astype(np.int64) * total + alive)
    base = names[anchors].astype(np.int64) * total
    # Places beyond the end must not reach into the next name's.
    low, high = (np.searchsorted(keys, base + np.minimum(anchors + k * size, total)) for k in (2, 4))
    some = high > low
    anchors, low, many = anchors[some], low[some], (high - low)[some]
    before = np.concatenate(([0], np.cumsum(many)))
    cuts = np.searchsorted(before, np.arange(0, int(before[-1]), PROPOSALS))
    cuts = np.unique([*cuts, len(many)])
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = np.repeat(np.arange(a, b), many[a:b])
        nth = np.arange(len(part)) - (before[part] - before[a])
        yield anchors[part], keys[low[part] + nth] % total - anchors[part]


def _extended(
    levels: list[np.ndarray], at: np.ndarray, period: np.ndarray, min_length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the stretches with a period around the places, if long enough."""
    right, left = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        while True:
            more = names[right] == names[right + period]
            right[more] += size
            # Below the top level, a factor of this size fits at most once more.
            if k < len(levels) - 1 or not more.any():
                break
        while True:
            back = np.maximum(left - size, 0)
            more = (left >= size) & (names[back] == names[back + period])
            left[more] -= size
            if k < len(levels) - 1 or not more.any():
                break
    end = right + period
    long = end - left >= np.maximum(min_length, 2 * period)
    return left[long], end[long], period[long]


def _slice_runs(texts: list[bytes], min_length: int) -> tuple[list[list[bytes]], np.ndarray, Runs]:
    """The words of texts, where those of each text start, and the runs of all."""
    words, numbers, first, total = [], [], [], 0
    for text in texts:
        # bytes.split() parts at the ASCII white space 0x20 and 0x09 to 0x0D.
        own = text.split()
        known: defaultdict[bytes, int] = defaultdict(count(total).__next__)
        numbers.append(np.fromiter(map(known.__getitem__, own), np.int64, len(own)))
        # Nothing equals the place between two texts, so no run leaves its text.
        numbers.append(np.array([-1], np.int64))
        words.append(own)
        first.append(total)
        total += len(own) + 1
    return words, np.array(first, np.int64), find_runs(np.concatenate(numbers), min_length)


def periodic_runs(
    df: DataFrame,
    text: str = "text",
    min_length: int = 12,
    names: tuple[str, str, str] = ("n_runs", "runs", "kept"),
) -> DataFrame:
    """``df`` with the number of runs of each text's words, the runs and the text without repeats.

    Words are what lies between ASCII white space, numbered from 0. ``runs`` is a list of (start,
    length, period) by start and then period. ``kept`` are the words that no run contains after
    its first period, joined by one space.

    One pass without a shuffle: texts are independent, slices of them have bounded size, and a text
    longer than a slice is one of its own (its names take 4 bytes a word and level). A NULL or
    empty text, or one of white space, has no runs and an empty ``kept``. Rows that repeat, and
    NULL ids, are rows like others; an empty table gives an empty table. Columns that have the
    names of results are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(batch.schema.get_field_index(text)))
            for low, high in bytesops.slices(offsets, SLICE_BYTES):
                raw = data[offsets[low] : offsets[high]].tobytes()
                own = offsets[low : high + 1] - offsets[low]
                texts = [raw[a:b] for a, b in zip(own[:-1], own[1:])]
                yield _with_runs(batch.slice(low, high - low), texts, min_length, names)

    kinds = dict(zip(names, (T.LongType(), RUNS, T.StringType())))
    return df.mapInArrow(run, added(df, **kinds))


def _with_runs(
    batch: pa.RecordBatch, texts: list[bytes], min_length: int, names: tuple[str, str, str]
) -> pa.RecordBatch:
    words, first, runs = _slice_runs(texts, min_length)
    cuts = np.searchsorted(runs.start, [*first, first[-1] + len(words[-1]) + 1 if texts else 0])
    local = runs.start - np.repeat(first, np.diff(cuts))
    kept = []
    for own, a, b in zip(words, cuts[:-1], cuts[1:]):
        if a < b:
            depth = np.zeros(len(own) + 1, np.int64)
            np.add.at(depth, local[a:b] + runs.period[a:b], 1)
            np.add.at(depth, local[a:b] + runs.length[a:b], -1)
            own = [own[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        kept.append(b" ".join(own))
    fields = [pa.array(x, pa.int64()) for x in (local, runs.length, runs.period)]
    listed = pa.ListArray.from_arrays(
        pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    )
    made = (pa.array(np.diff(cuts), pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string()))
    for name, values in zip(names, made):
        taken = [x.lower() for x in batch.schema.names]
        if name.lower() in taken:
            batch = batch.set_column(taken.index(name.lower()), name, values)
        else:
            batch = batch.append_column(name, values)
    return batch
