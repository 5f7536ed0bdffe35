"""Remove byte strings that an earlier document already has: a depth-limited radix sort.

The suffixes of all texts are ordered only through ``depth`` bytes, by passes from the most
significant digit on; after each pass, groups of a single document leave, and the groups that
are equal through the last pass are exactly the repeated windows. So that not every suffix
has to move, the digits are chosen by content:

1. The leading digit of a window is the least (by hash) of the ``key``-byte strings in it.
   Equal windows have equal leading digits at equal places. Windows in a row that have the
   same leading digit at the same place form one stretch, and one entry stands for it.
2. Entries of one leading digit are ordered by their stretch's bytes. A stretch that a
   smaller doc_id has too is removed whole. Where a leading digit has several stretches in
   several documents, the first document of each goes on. Of a digit that has more than
   ``STRETCHES`` in a block (a line that many documents hold in different surroundings), the
   block sends that many here, and the first document of each of its stretches goes on unasked.
3. Those stretches' windows are ordered through all ``depth`` bytes, one by one, dealt by content.

Digits travel as hashes: two entries count as equal if about 100 bits agree. Texts are dealt
into blocks by a hash of doc_id; each block sends an entry once however many of its documents
have it, so a string that a third of all documents share arrives once from each block. What
comes back names entries by their place in the block's own sorted list.

Defined results: NULL and empty text have no windows; texts are compared as UTF-8 bytes, whole;
rows with equal doc_id are never earlier than one another; a NULL doc_id is earlier than all
others; an empty table gives an empty table; columns of the input stay, and a column that has
the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.llm.bpe import added
from tidegauge.llm.bytesops import U64, Rolling, mix, runs, text_bytes
from tidegauge.llm.frames import free_name, give_back, parts_for, stored, text_bytes_total

DEPTH = 50
KEY = 24
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
#: So many edges of buckets are kept in a table; beyond that, each cell is cut evenly.
CELLS = 4096
# Fixed value, at least two: so many stretches of a leading digit enter the first pass from a block.
STRETCHES = 4
_CHUNK = 1 << 19
_NULL_ID = np.iinfo(np.int64).min
_WHOLE, _SINGLE = 0, 1


# --- Buckets of keys ----------------------------------------------------------------


class _Cuts(NamedTuple):
    """Buckets of ascending 64-bit keys: cells from each edge on, cut into ``each`` parts."""

    edges: np.ndarray
    each: int

    def of(self, keys: np.ndarray) -> np.ndarray:
        cell = np.searchsorted(self.edges, keys, side="right") - 1
        if self.each == 1:
            return cell
        widths = np.append(self.edges[1:], U64(0xFFFFFFFFFFFFFFFF)) - self.edges
        step = (widths // U64(self.each) + U64(1))[cell]
        return cell * self.each + ((keys - self.edges[cell]) // step).astype(np.int64)


def _cuts(buckets: int, width: int) -> _Cuts:
    """At least ``buckets`` buckets with about as many entries each, if a key is the least hash
    of ``width`` places in a row.

    A hash u in (0, 1) is the least of some ``width`` places if the places before and after it with
    greater hashes are ``width - 1`` or more: with v = 1 - u, this has the probability
    v**(width - 1) * (1 + (width - 1) * u). ``up_to`` is its integral, scaled to 1.
    """
    cells = min(buckets, CELLS)

    def up_to(u: np.ndarray) -> np.ndarray:
        v = 1.0 - u
        return ((1 - v**width) * (width + 1) - (width - 1) * (1 - v ** (width + 1))) / 2

    share = np.arange(cells) / cells
    low, high = np.zeros(cells), np.ones(cells)
    for _ in range(53):
        middle = (low + high) / 2
        below = up_to(middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return _Cuts((low * 2.0**64).astype(U64), -(-buckets // cells))


# --- A block of documents -------------------------------------------------------


class _Block:
    """The documents of a block in order of doc_id, and their stretches. ``cuts`` has the buckets
    of each pass."""

    def __init__(self, table: pa.Table, depth: int, key: int, cuts: dict[int, _Cuts]) -> None:
        numbers = table.column("doc").to_numpy()
        self.order = np.argsort(numbers, kind="stable")
        table = table.take(pa.array(self.order))
        self.docs = numbers[self.order]
        self.depth, self.key, self.cuts = depth, key, cuts
        self.data, self.offsets = text_bytes(table.column("text"))
        starts, stops, keys, contents, rows = self._stretches()
        order = np.lexsort((self.docs[rows], contents, keys))
        self.starts, self.stops, self.rows = starts[order], stops[order], rows[order]
        keys, contents = keys[order], contents[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (contents[1:] != contents[:-1])
        self.entry = np.cumsum(new) - 1
        at = np.nonzero(new)[0]
        self.keys, self.contents = keys[at], contents[at]
        self.least = self.docs[self.rows[at]]
        digit = np.searchsorted(self.keys, self.keys)
        self.sent = np.arange(len(at)) - digit < STRETCHES
        self.crowded = np.searchsorted(self.keys, self.keys, side="right") - digit > STRETCHES

    def _stretches(self):
        found = []
        data, depth, key = self.data, self.depth, self.key
        ends = self.offsets[1:]
        for low in range(0, max(0, len(data) - depth + 1), _CHUNK):
            part = data[low : low + _CHUNK + depth - 1]
            rolling = Rolling(part)
            hashes = rolling.windows(key)
            # The least hash, then the first place: both in one 64-bit value.
            value = (hashes & ~U64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=U64)
            reach, width = 1, depth - key + 1
            while reach < width:
                step = min(reach, width - reach)
                value = np.minimum(value[:-step], value[step:])
                reach += step
            first = np.arange(low, low + len(value))
            row = np.searchsorted(ends, first, side="right")
            inside = np.nonzero(first + depth <= ends[row])[0]
            if not len(inside):
                continue
            place = (value & U64(0xFFFFFFFF)).astype(np.int64)
            row, place = row[inside], place[inside]
            new = np.ones(len(inside), bool)
            new[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1) | (row[1:] != row[:-1])
            at = np.nonzero(new)[0]
            last = np.append(at[1:], len(inside)) - 1
            starts, stops = inside[at], inside[last] + 1
            contents = rolling.ranges(starts, stops + depth - 1)
            found.append((starts + low, stops + low, hashes[place[at]], contents, row[at]))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none.astype(U64), none.astype(U64), none
        return [np.concatenate(x) for x in zip(*found, strict=True)]

    def send(self, pass_number: int, block: int, keys: np.ndarray, contents: np.ndarray, docs: np.ndarray) -> pa.Table:
        """Entries, sorted by key, as a row for each bucket."""
        bucket = self.cuts[pass_number].of(keys)
        full, first = np.unique(bucket, return_index=True)
        cuts = [*first.tolist(), len(bucket)]
        parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "block": pa.array(np.full(len(full), block), pa.int64()),
                "keys": pa.array([_packed(keys[p], 5) for p in parts], pa.binary()),
                "contents": pa.array([_packed(contents[p], 6) for p in parts], pa.binary()),
                "docs": pa.array([_planes(docs[p]) for p in parts], pa.binary()),
            }
        )

    def marked(self, answers: pa.Table, pass_number: int, kind: int, keys: np.ndarray) -> np.ndarray:
        """Which entries the buckets' answers name."""
        out = np.zeros(len(keys), bool)
        own = self.cuts[pass_number].of(keys)
        columns = (answers.column(c).to_pylist() for c in ("pass", "kind", "bucket", "places"))
        for number, what, bucket, places in zip(*columns, strict=True):
            if number == pass_number and what == kind:
                out[np.searchsorted(own, bucket) + np.frombuffer(places, "<u4")] = True
        return out

    def first_pass(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.keys[self.sent], self.contents[self.sent], self.least[self.sent]

    def named(self, answers: pa.Table, kind: int) -> np.ndarray:
        """Which entries the first pass names, of those that were sent there."""
        out = np.zeros(len(self.keys), bool)
        out[self.sent] = self.marked(answers, 1, kind, self.keys[self.sent])
        return out

    def windows(self, answers: pa.Table):
        """The windows of stretches whose first document goes on: place, key, content, doc.

        Their key is a hash of the leading digit and the content, so that the windows of a
        common digit spread over all buckets.
        """
        open_entries = self.named(answers, _SINGLE) | self.crowded
        docs = self.docs[self.rows]
        own = np.nonzero(open_entries[self.entry] & (docs == self.least[self.entry]))[0]
        sizes = self.stops[own] - self.starts[own]
        first = np.concatenate(([0], np.cumsum(sizes)))
        places = np.repeat(self.starts[own] - first[:-1], sizes) + np.arange(first[-1])
        contents = np.empty(len(places), U64)
        powers = Rolling(np.zeros(1, np.uint8))._powers[: self.depth]
        for low in range(0, len(places), 1 << 16):
            at = places[low : low + (1 << 16), None] + np.arange(self.depth)
            contents[low : low + len(at)] = mix(((self.data[at].astype(U64) + U64(1)) * powers).sum(axis=1, dtype=U64))
        keys, docs = mix(np.repeat(self.keys[self.entry[own]], sizes) ^ contents), np.repeat(docs[own], sizes)
        order = np.lexsort((docs, contents, keys))
        keys, contents = keys[order], contents[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (contents[1:] != contents[:-1])
        return places[order], keys, contents, docs[order], new

    def covered(self, answers: pa.Table) -> np.ndarray:
        """Which bytes a window of an earlier document covers."""
        later = self.named(answers, _WHOLE)
        gone = later[self.entry] | (self.docs[self.rows] > self.least[self.entry])
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, self.starts[gone], 1)
        np.add.at(change, self.stops[gone] + self.depth - 1, -1)
        places, keys, _, docs, new = self.windows(answers)
        if len(places):
            at = np.nonzero(new)[0]
            entry = np.cumsum(new) - 1
            earlier = self.marked(answers, 2, _WHOLE, keys[at])
            gone = places[earlier[entry] | (docs > docs[at][entry])]
            np.add.at(change, gone, 1)
            np.add.at(change, gone + self.depth, -1)
        return np.cumsum(change, out=change)[:-1] > 0


def _packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _planes(values: np.ndarray) -> bytes:
    """Integers byte by byte, all first bytes first: equal high bytes compress away."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel()


# --- A bucket of leading digits ---------------------------------------------------


def _answer(pass_number: int) -> Callable[[pa.Table], pa.Table]:
    """Order a bucket's entries; name, for each block, those that an earlier document has and
    (in the first pass) the first of each stretch whose leading digit has other stretches."""

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("block", "keys", "contents", "docs")]
        blocks, bucket = columns[0], table.column("bucket")[0].as_py()
        keys = np.concatenate([_unpacked(x, 5) for x in columns[1]])
        contents = np.concatenate([_unpacked(x, 6) for x in columns[2]])
        docs = np.concatenate([_from_planes(x) for x in columns[3]])
        sizes = [len(x) // 5 for x in columns[1]]
        order = np.lexsort((docs, contents, keys))
        keys, contents, sorted_docs = keys[order], contents[order], docs[order]
        new_key = np.ones(len(keys), bool)
        new_key[1:] = keys[1:] != keys[:-1]
        new = new_key.copy()
        new[1:] |= contents[1:] != contents[:-1]
        least = sorted_docs[np.nonzero(new)[0]][np.cumsum(new) - 1]
        found = {_WHOLE: sorted_docs > least}
        if pass_number == 1 and len(keys):
            key_at, key_of = np.nonzero(new_key)[0], np.cumsum(new_key) - 1
            stretches = np.add.reduceat(new.astype(np.int64), key_at)
            several = np.minimum.reduceat(sorted_docs, key_at) != np.maximum.reduceat(sorted_docs, key_at)
            found[_SINGLE] = ((stretches > 1) & several)[key_of] & (sorted_docs == least)
        out: dict[str, list] = {c: [] for c in ("block", "pass", "kind", "bucket", "places")}
        first = np.concatenate(([0], np.cumsum(sizes)))
        for kind, hits in found.items():
            places = np.zeros(len(order), bool)
            places[order] = hits
            for k, block in enumerate(blocks):
                own = np.nonzero(places[first[k] : first[k + 1]])[0]
                if len(own):
                    row = (block, pass_number, kind, bucket, own.astype("<u4").tobytes())
                    for c, value in zip(out, row, strict=True):
                        out[c].append(value)
        del keys, contents, docs, order, sorted_docs, found
        give_back()
        return pa.table(out, schema=_ANSWER_ARROW)

    return run


_ENTRY = "bucket bigint, block bigint, keys binary, contents binary, docs binary"
_ANSWER = "block bigint, pass bigint, kind bigint, bucket bigint, places binary"
_ANSWER_ARROW = pa.schema(
    [("block", pa.int64()), ("pass", pa.int64()), ("kind", pa.int64()), ("bucket", pa.int64()), ("places", pa.binary())]
)


def remove_repeats(
    df: DataFrame,
    depth: int = DEPTH,
    key: int = KEY,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining
    bytes) and kept_text (the characters of which a byte remains)."""
    if not 1 <= key <= depth:
        raise ValueError("key must lie between 1 and depth")
    spark = df.sparkSession
    total = text_bytes_total(df, text)
    blocks, buckets = parts_for(total, block_bytes, spark), parts_for(total, bucket_bytes, spark)
    # Keys of the second pass are mixed, so they lie evenly.
    cuts = {1: _cuts(buckets, depth - key + 1), 2: _cuts(buckets, 1)}
    own = free_name(df.columns, "block")
    number = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(int(_NULL_ID)))
    dealt = F.pmod(F.xxhash64(number), F.lit(blocks))
    small = df.select(dealt.alias("block"), number.alias("doc"), F.col(text).alias("text"))

    def enter(table: pa.Table) -> pa.Table:
        made = _Block(table, depth, key, cuts)
        sent = made.send(1, table.column("block")[0].as_py(), *made.first_pass())
        del made
        give_back()
        return sent

    def open_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _ENTRY_ARROW.empty_table()
        made = _Block(table, depth, key, cuts)
        _, keys, contents, docs, new = made.windows(answers)
        sent = made.send(2, table.column("block")[0].as_py(), keys[new], contents[new], docs[new])
        del made, keys, contents, docs, new
        give_back()
        return sent

    entries = small.groupBy("block").applyInArrow(enter, _ENTRY)
    first = stored(entries.groupBy("bucket").applyInArrow(_answer(1), _ANSWER), "repeats-1")
    still_open = first.where(F.col("kind") == _SINGLE)
    windows = small.groupBy("block").cogroup(still_open.groupBy("block")).applyInArrow(open_windows, _ENTRY)
    second = stored(windows.groupBy("bucket").applyInArrow(_answer(2), _ANSWER), "repeats-2")

    results = {
        "n_bytes": T.LongType(),
        "n_removed": T.LongType(),
        "n_spans": T.LongType(),
        "kept": T.BinaryType(),
        "kept_text": T.StringType(),
    }
    schema = added(df, **results)
    text_name = next(f.name for f in df.schema if f.name.lower() == text.lower())
    helper = free_name([*df.columns, own], "doc")

    empty = to_arrow_schema(schema).empty_table()

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:  # answers to a block are never without its documents
            return empty
        given = {"doc": table.column(helper), "text": table.column(text_name)}
        made = _Block(pa.table(given), depth, key, cuts)
        columns = _cut(made, made.covered(answers))
        table = table.take(pa.array(made.order)).drop_columns([own, helper])
        del made
        give_back()
        for name, column in columns.items():
            at = [x.lower() for x in table.column_names]
            if name.lower() in at:
                table = table.set_column(at.index(name.lower()), name, column)
            else:
                table = table.append_column(name, column)
        return table

    whole = df.withColumns({own: dealt, helper: number})
    return (
        whole.groupBy(own)
        .cogroup(first.unionByName(second).groupBy("block"))
        .applyInArrow(remove, schema)
    )


_ENTRY_ARROW = pa.schema(
    [("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("contents", pa.binary()), ("docs", pa.binary())]
)


def _cut(made: _Block, covered: np.ndarray) -> dict[str, pa.Array]:
    offsets, data = made.offsets, made.data
    sizes = np.diff(offsets)
    before = np.concatenate(([0], np.cumsum(covered)))
    removed = np.diff(before[offsets])
    spans = np.diff(runs(covered, offsets).first)
    kept = pa.Array.from_buffers(
        pa.binary(),
        len(sizes),
        [None, pa.py_buffer((offsets - before[offsets]).astype(np.int32)), pa.py_buffer(data[~covered])],
    )
    # Characters: the bytes from a leading byte to the next.
    leading = np.nonzero((data & 0xC0) != 0x80)[0]
    if len(leading):
        stays = np.logical_or.reduceat(~covered, leading)
        stays = np.repeat(stays, np.diff(np.append(leading, len(data))))
    else:
        stays = ~covered
    left = np.concatenate(([0], np.cumsum(stays)))[offsets]
    text = pa.Array.from_buffers(
        pa.string(), len(sizes), [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data[stays])]
    )
    return {
        "n_bytes": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "n_spans": pa.array(spans, pa.int64()),
        "kept": kept,
        "kept_text": text,
    }
