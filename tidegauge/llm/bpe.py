"""Byte-pair encoding over an index of pair occurrences, and decoding.

The distinct pieces of a batch lie one after another as symbols. An index maps each pair
that has a merge to all positions where it occurs. Ranks that occur ("active" ranks) are
applied in ascending order: one rank is merged at all its positions at once, and the lists
of the pairs that its merges make or break are updated. A piece's merges never depend on
another piece, so this gives what merging piece by piece gives.

Defined results: NULL and empty text give no ids and decode to empty text; long texts are
encoded whole; every row is encoded by itself, so repeated rows get equal results; an empty
table gives an empty table; columns of the input stay, and a column that has the name of a
result is replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import bytesops, pretokens
from tidegauge.llm.frames import lean

SLICE_BYTES = 2 << 20
_KEPT_PIECES = 400_000


@lru_cache(1)
def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as it is, the rest from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """A tokenizer file with a byte-level BPE model."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model = given["model"]
        self._library = Tokenizer.from_file(path)
        self._special = {x["content"]: x["id"] for x in given["added_tokens"]}
        self._spaced = given["normalizer"] is None
        self._joined = given["decoder"] is None
        vocab = model["vocab"]
        self.size = max([*vocab.values(), *self._special.values()]) + 1
        end = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self._byte_of = {c: b for b, c in enumerate(letters)}
        self._inner = np.array([vocab.get(c, -1) for c in letters])
        self._final = np.array([vocab.get(c + end, -1) for c in letters])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs])
        self._made = np.array([vocab[a + b] for a, b in pairs])
        self._left, self._right = keys // self.size, keys % self.size
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        names = [b""] * self.size
        for token, number in [*vocab.items(), *self._special.items()]:
            if self._joined or number in self._special.values():
                names[number] = token.encode() + b" " * self._joined
            else:
                names[number] = bytes(self._byte_of[c] for c in token)
        self._name_bytes = np.frombuffer(b"".join(names), np.uint8)
        self._name_first = np.concatenate(([0], np.cumsum([len(x) for x in names])))
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids, self._ids_first = np.empty(0, np.int64), np.zeros(1, np.int64)

    def _lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces. What ``merge`` finds is kept for the next slices of the same
        worker; once so many pieces are known, they are forgotten and found again."""
        missing = [p for p in pieces if p not in self._known]
        if len(self._known) + len(missing) > _KEPT_PIECES:
            self._forget()
            missing = pieces
        found, first = self.merge(missing)
        self._known.update(zip(missing, range(len(self._known), len(self._known) + len(missing)), strict=True))
        self._ids = np.concatenate((self._ids, found))
        self._ids_first = np.concatenate((self._ids_first, self._ids_first[-1] + first[1:]))
        own = self._known
        picks = np.fromiter(map(own.__getitem__, pieces), np.int64, len(pieces))
        at, begins = bytesops.gathered(self._ids_first, picks)
        return self._ids[at], begins

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 if it has none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (right >= 0), self._ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and where each piece's ids begin."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        if not n:
            return np.empty(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
        symbols = self._inner[raw]
        last = (first[1:] - 1)[sizes > 0]
        symbols[last] = self._final[raw[last]]
        # Neighbours; n stands for none. symbols gets one more, which pairs with nothing.
        symbols = np.append(symbols, -1)
        following = np.arange(1, n + 2)
        following[last] = n
        before = np.arange(-1, n)
        before[first[:-1][sizes > 0]] = n
        alive = np.ones(n + 1, bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            ranks = self._rank(symbols[at], symbols[following[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.concatenate(([0], np.nonzero(np.diff(ranks))[0] + 1, [len(ranks)])).tolist()
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                rank = int(ranks[low])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(at[low:high])

        note(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.sort(np.concatenate(lists))
            at = at[np.append(True, at[1:] != at[:-1])]
            left, right = self._left[rank], self._right[rank]
            at = at[alive[at] & (symbols[at] == left) & (symbols[following[at]] == right)]
            if left == right and len(at) > 1:
                # Of occurrences that overlap in a chain, every other one from the first.
                chained = np.concatenate(([False], following[at[:-1]] == at[1:]))
                place = np.arange(len(at))
                head = np.maximum.accumulate(np.where(chained, 0, place))
                at = at[(place - head) % 2 == 0]
            gone = following[at]
            beyond = following[gone]
            alive[gone] = False
            symbols[at] = self._made[rank]
            following[at] = beyond
            before[beyond] = at
            earlier = before[at]
            note(np.concatenate((at, earlier[earlier < n])))
        kept = alive[:n]
        begins = np.concatenate(([0], np.cumsum(kept)))[first]
        return symbols[:n][kept], begins

    def _split_row(self, text: str) -> list[bytes | int]:
        """A row's pieces by the library's own normaliser and splitter; ids of special tokens."""
        out: list[bytes | int] = []
        while text:
            found = [(text.find(s), s) for s in self._special]
            found = [x for x in found if x[0] >= 0]
            at, token = min(found, default=(len(text), ""))
            part = text[:at]
            if part:
                if self._library.normalizer is not None:
                    part = self._library.normalizer.normalize_str(part)
                for piece, _ in self._library.pre_tokenizer.pre_tokenize_str(part):
                    out.append(bytes(self._byte_of[c] for c in piece))
            if token:
                out.append(self._special[token])
            text = text[at + len(token) :]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after another, and where each row's ids begin."""
        plain = pretokens.plain_rows(data, offsets)
        low = data if self._spaced else bytesops.lower(data)
        spans = pretokens.split(low, offsets, self._spaced)
        inside = plain[spans.rows]
        counts = np.where(plain, np.diff(spans.first), 0)
        kept = bytesops.Words(spans.starts[inside], spans.ends[inside], spans.rows[inside], spans.first)
        pieces, numbers = pretokens.distinct(low, kept)
        odd: dict[int, list[bytes | int]] = {}
        for row in np.nonzero(~plain)[0].tolist():
            odd[row] = self._split_row(data[offsets[row] : offsets[row + 1]].tobytes().decode())
            counts[row] = len(odd[row])
        known: dict[bytes | int, int] = {p: n for n, p in enumerate(pieces)} if odd else {}
        for parts in odd.values():
            for piece in parts:
                if isinstance(piece, bytes) and piece not in known:
                    known[piece] = len(pieces)
                    pieces.append(piece)
        values, first = self._lookup(pieces)
        for special in sorted({p for parts in odd.values() for p in parts if isinstance(p, int)}):
            known[special] = len(first) - 1
            values, first = np.append(values, special), np.append(first, len(values) + 1)
        begins = np.concatenate(([0], np.cumsum(counts)))
        sequence = np.empty(begins[-1], np.int64)
        sequence[np.repeat(plain, counts)] = numbers
        for row, parts in odd.items():
            sequence[begins[row] : begins[row + 1]] = [known[p] for p in parts]
        at, ids_first = bytesops.gathered(first, sequence)
        return values[at], ids_first[begins]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """The text of each row of ids: token texts joined by a space, or their bytes."""
        at, begins = bytesops.gathered(self._name_first, ids)
        raw = self._name_bytes[at]
        cuts = begins[first]
        if self._joined:
            full = first[1:] > first[:-1]
            keep = np.ones(len(raw), bool)
            keep[cuts[1:][full] - 1] = False
            raw = raw[keep]
            cuts = cuts - np.concatenate(([0], np.cumsum(full)))
            buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)]
            return pa.Array.from_buffers(pa.large_string(), len(first) - 1, buffers)
        return pa.array(
            [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
            pa.large_string(),
        )


@lru_cache(4)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def _with(batch: pa.RecordBatch | pa.Table, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [x.lower() for x in batch.schema.names]
    if name.lower() in names:
        return batch.set_column(names.index(name.lower()), name, column)
    return batch.append_column(name, column)


def added(df: DataFrame, **columns: T.DataType) -> T.StructType:
    """The schema of ``df`` with these columns, which replace those of the same name."""
    fields = list(df.schema.fields)
    for name, kind in columns.items():
        at = next((i for i, f in enumerate(fields) if f.name.lower() == name.lower()), len(fields))
        fields[at : at + 1] = [T.StructField(name, kind)]
    return T.StructType(fields)


def _sliced(batches: Iterator[pa.RecordBatch], text: str):
    """Parts of the batches with a bounded number of bytes (or one row), and their text."""
    for batch in batches:
        data, offsets = bytesops.text_bytes(batch.column(batch.schema.get_field_index(text)))
        for low, high in bytesops.slices(offsets, SLICE_BYTES):
            own = offsets[low : high + 1]
            yield batch.slice(low, high - low), data[own[0] : own[-1]], own - own[0]


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(first.astype(np.int32), values.astype(np.int32))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` by the tokenizer file at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _sliced(batches, text):
            values, first = tokenizer(path).encode(data, offsets)
            yield _with(batch, ids, _lists(values, first))

    return df.mapInArrow(lean(run), added(df, **{ids: T.ArrayType(T.IntegerType())}))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; NULL ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids)).cast(pa.large_list(pa.int64()))
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            values = column.flatten().to_numpy(zero_copy_only=False)
            yield _with(batch, decoded, tokenizer(path).decode(values, first).cast(pa.string()))

    return df.mapInArrow(lean(run), added(df, **{decoded: T.StringType()}))


def round_trip(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``df`` with the ids of ``text`` and the text that these ids decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _sliced(batches, text):
            own = tokenizer(path)
            values, first = own.encode(data, offsets)
            batch = _with(batch, ids, _lists(values, first))
            yield _with(batch, decoded, own.decode(values, first).cast(pa.string()))

    return df.mapInArrow(lean(run), added(df, **{ids: T.ArrayType(T.IntegerType()), decoded: T.StringType()}))


def digests(ids: str = "ids", decoded: str = "decoded") -> list[Column]:
    """n_tokens, and the sha256 of the decimal ids joined by one space and of the decoded text."""
    listed = F.array_join(F.col(ids).cast("array<string>"), " ")
    return [
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    ]
