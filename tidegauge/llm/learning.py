"""What the classifiers share: bounded samples to learn from, and scoring of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import bytesops
from tidegauge.llm.bpe import added
from tidegauge.llm.frames import lean

SLICE_BYTES = 1 << 20
RANKED_PARTS = 64
_ARROW = {"double": pa.float64(), "int": pa.int32(), "string": pa.string()}
_SPARK = {"double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType()}


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    per_label: dict | int,
    max_chars: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> list[tuple[str, object]]:
    """Texts and labels to learn from, in order of doc_id, collected by the driver.

    Of the rows of ``labels`` that ``learn`` accepts and whose text is there and no longer than
    ``max_chars``, those with the least hashes of doc_id are taken: up to so many for each key of
    ``per_label``, or up to so many in all, the first of each label before any label's second.
    Of a label that has longer texts only, passages of ``max_chars`` characters are taken, from
    places that a hash of the text gives. So at most their product is collected. Rows of labels
    that repeat count once; of the texts of one doc_id the least hash among the short ones counts.
    """
    long = F.length("text") > max_chars
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    texts = texts.withColumn("long", long)
    known = labels.where(learn & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).distinct()
    known = known.join(texts.groupBy("doc_id").agg(F.min("long").alias("long")), "doc_id")
    order = ["long", F.xxhash64("doc_id"), "doc_id", "label"]
    # Ranked in parts first: a common label's rows never meet in one task.
    most = max(per_label.values()) if isinstance(per_label, dict) else per_label
    parts = Window.partitionBy("label", F.pmod(F.xxhash64("doc_id"), F.lit(RANKED_PARTS)))
    for within in (parts, Window.partitionBy("label")):
        known = known.withColumn("least", F.first("long").over(within.orderBy(*order)))
        known = known.withColumn("nth", F.row_number().over(within.orderBy(*order)))
        known = known.where((F.col("nth") <= most) & (F.col("long") == F.col("least")))
    if isinstance(per_label, dict):
        wanted = [(F.col("label") == k) & (F.col("nth") <= n) for k, n in per_label.items()]
        taken = known.where(reduce(or_, wanted))
    else:
        taken = known.orderBy("nth", *order).limit(per_label)
    # The taken rows are bounded by the parameters, so they may be broadcast.
    found = texts.join(F.broadcast(taken.select("doc_id", "label", "long")), ["doc_id", "long"])
    place = F.pmod(F.xxhash64("text"), F.length("text") - max_chars + 1).cast("int") + 1
    passage = F.when(F.col("long"), F.col("text").substr(place, F.lit(max_chars))).otherwise(F.col("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), passage.alias("text"))).alias("least")
    found = found.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "least.text")
    return [(x.text, x.label) for x in sorted(found.collect(), key=lambda x: (x.doc_id, str(x.label)))]


def with_scores(
    df: DataFrame, text: str, columns: dict[str, str], score: Callable[[np.ndarray, np.ndarray], list]
) -> DataFrame:
    """``df`` with columns (name: double, int or string) that ``score`` makes from the bytes
    and offsets of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(batch.schema.get_field_index(text)))
            for low, high in bytesops.slices(offsets, SLICE_BYTES):
                own = offsets[low : high + 1]
                part = batch.slice(low, high - low)
                made = score(data[own[0] : own[-1]], own - own[0])
                for (name, kind), values in zip(columns.items(), made, strict=True):
                    names = [x.lower() for x in part.schema.names]
                    values = pa.array(values, _ARROW[kind])
                    if name.lower() in names:
                        part = part.set_column(names.index(name.lower()), name, values)
                    else:
                        part = part.append_column(name, values)
                yield part

    return df.mapInArrow(lean(run), added(df, **{k: _SPARK[v] for k, v in columns.items()}))


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    before = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return before[first[1:]] - before[first[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))
