"""Token ids of a corpus as flat binary files, and reading them back.

A folder has three files for each part: ``part-N.bin`` (the ids of all its documents, one
after another, as little-endian unsigned integers of 16 bits if the vocabulary and the end
id fit, else of 32), ``part-N.off`` (where each document begins, in ids, and the end of the
last: 64-bit integers) and ``part-N.doc`` (the documents' ids, 64-bit integers; the least
integer stands for NULL). Parts and the documents in them are in ascending order of doc_id,
NULL first; equal ids are in order of a hash of their text. A part's base, the number of ids
in all parts before it, is a prefix sum over the parts' totals.

Defined results: NULL and empty text give the end id alone; texts are written whole; every
row is a document, so repeated rows are written each; an empty table gives no documents;
other columns are not written, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm import bytesops
from tidegauge.llm.bpe import Bpe
from tidegauge.llm.frames import parts_for, stored, text_bytes_total

PART_BYTES = 64 << 20
SLICE_BYTES = 3 << 20
_GROUP = 500
_NULL_ID = np.iinfo(np.int64).min


class LibraryBpe(Bpe):
    """Rows are split into pieces as bytes; the tokenizers library encodes each distinct one.

    A piece is encoded by itself as it is in its text, since merges never cross pieces.
    """

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode() for p in pieces]
        groups = [texts[k : k + _GROUP] for k in range(0, len(texts), _GROUP)]
        found = self._library.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        first = np.zeros(len(pieces) + 1, np.int64)
        if not found:
            return np.empty(0, np.int64), first
        owners = [np.array(x.word_ids, np.int64) + k * _GROUP for k, x in enumerate(found)]
        np.cumsum(np.bincount(np.concatenate(owners), minlength=len(pieces)), out=first[1:])
        return np.concatenate([np.array(x.ids, np.int64) for x in found]), first


@lru_cache(2)
def _tokenizer(path: str) -> LibraryBpe:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryBpe(path)


# Hadoop's names of file systems, and Arrow's of the same ones.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "webhdfs": "hdfs"}


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there. Spark names some otherwise than Arrow, and
    ``dbfs:`` is a mounted folder."""
    scheme, colon, rest = folder.partition(":")
    if scheme == "dbfs" and colon:
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return fs.LocalFileSystem(), folder


def _kind(path: str, end_id: int) -> np.dtype:
    small = max(_tokenizer(path).size - 1, end_id) < 1 << 16
    return np.dtype("<u2" if small else "<u4")


def write_token_files(
    df: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Write the files to ``folder``, a path or URI that all executors reach.

    Returns the parts: part, documents, tokens, base, folder and width of an id in bytes. A
    part is written to names of its own attempt and then renamed, so an attempt that runs
    again leaves the same files.
    """
    spark = df.sparkSession
    parts = parts_for(text_bytes_total(df, text), part_bytes, spark)
    place, root = _open(folder)
    place.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        tokenizer, kind = _tokenizer(tokenizer_path), _kind(tokenizer_path, end_id)
        there, base = _open(folder)
        names = {x: f"{base}/part-{part:06d}.{x}" for x in ("bin", "off", "doc")}
        tried = {x: f"{base}/_attempt-{attempt}-{part:06d}.{x}" for x in names}
        files = {x: there.open_output_stream(tried[x]) for x in names}
        files["off"].write(np.zeros(1, "<i8").tobytes())
        tokens = documents = 0
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(1))
            numbers = batch.column(0).cast(pa.int64()).fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)
            files["doc"].write(numbers.astype("<i8").tobytes())
            for low, high in bytesops.slices(offsets, SLICE_BYTES):
                own = offsets[low : high + 1]
                values, first = tokenizer.encode(data[own[0] : own[-1]], own - own[0])
                values = np.insert(values, first[1:], end_id)
                ends = first[1:] + np.arange(1, len(first))
                files["bin"].write(values.astype(kind).tobytes())
                files["off"].write((tokens + ends).astype("<i8").tobytes())
                tokens += len(values)
            documents += batch.num_rows
        for x in names:
            files[x].close()
            there.move(tried[x], names[x])
        row = {"part": [part], "documents": [documents], "tokens": [tokens], "width": [kind.itemsize]}
        yield pa.RecordBatch.from_pydict(row)

    ordered = (
        df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    schema = "part bigint, documents bigint, tokens bigint, width bigint"
    written = stored(ordered.mapInArrow(run, schema), "token-parts")
    # A row for each part, so this window is as short as the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    return written.withColumn("base", base).withColumn("folder", F.lit(folder))


def read_token_files(parts: DataFrame) -> DataFrame:
    """A row per document of ``parts`` (from ``write_token_files``): doc_id, start, n_tokens
    and ids (little-endian unsigned 32-bit integers). Local files are memory-mapped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                yield from _documents(part)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    count = max(1, parts.count())
    return parts.repartition(count, "part").mapInArrow(run, schema)


def _mapped(place: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(place, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with place.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _documents(part: dict) -> Iterator[pa.RecordBatch]:
    place, root = _open(part["folder"])
    name = f"{root}/part-{part['part']:06d}"
    ids = _mapped(place, f"{name}.bin", f"<u{part['width']}")
    offsets, documents = _mapped(place, f"{name}.off", "<i8"), _mapped(place, f"{name}.doc", "<i8")
    for low, high in bytesops.slices(offsets, 1 << 20):
        own = offsets[low : high + 1]
        raw = ids[own[0] : own[-1]].astype("<u4").tobytes()
        cuts = ((own - own[0]) * 4).astype(np.int32)
        numbers = documents[low:high]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers, pa.int64(), mask=numbers == _NULL_ID),
                pa.array(own[:-1] + part["base"], pa.int64()),
                pa.array(np.diff(own), pa.int64()),
                pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(cuts), pa.py_buffer(raw)]),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )
