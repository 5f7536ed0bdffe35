"""A quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates.

Tokens are words (runs of letters and digits, case kept) and runs of ASCII punctuation.
Features are single tokens and pairs in a row, hashed to one table, and whether a word and
the next are the same, whichever word it is; a feature's value is its share of the text's
n-grams of that kind. A text's score is a sparse dot product with the table.
Training takes the sample in mini-batches in a fixed order; within a batch each coordinate gets
the sum of its gradients.

Defined results: NULL, empty texts and texts without tokens get the constant's probability;
texts are scored whole; repeated rows score alike; without labelled rows of both kinds
everything scores the share of label 1 (0.5 without any); an empty table gives an empty table;
columns of the input stay, and a column that has the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import bytesops, learning
from tidegauge.llm.bytesops import U64
from tidegauge.llm.frames import held_out

FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
PER_LABEL = 3000
MAX_CHARS = 8000
BUCKETS = 1 << 18
EPOCHS = 12
BATCH = 16
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
SIZES = (1, 2)
# The first buckets tell whether a word and the next are the same; no n-gram falls there.
_SAME, _OTHER, RESERVED = 0, 1, 2


class Model(NamedTuple):
    weights: np.ndarray
    constant: float


def _punctuation_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[33:48] = table[58:65] = table[91:97] = table[123:127] = True
    return table


_PUNCTUATION = _punctuation_table()


def features(data: np.ndarray, offsets: np.ndarray):
    """For each kind of n-gram: buckets, one after another, and where each row's begin."""
    parts = [bytesops.words(data, offsets), bytesops.runs(_PUNCTUATION[data], offsets)]
    starts, ends = (np.concatenate(x) for x in zip(*((p.starts, p.ends) for p in parts), strict=True))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    rolling = bytesops.Rolling(data)
    hashes = rolling.ranges(starts, ends)
    first = np.searchsorted(starts, offsets)
    made = []
    for size in SIZES:
        own = np.full(max(0, len(hashes) - size + 1), size, U64)
        for k in range(size):
            own = bytesops.mix(own + hashes[k : k + len(own)])
        counts = np.maximum(np.diff(first) - size + 1, 0)
        at, begins = _leading(first[:-1], counts)
        made.append(((own[at] % U64(BUCKETS - RESERVED) + U64(RESERVED)).astype(np.int64), begins))
    words = rolling.ranges(parts[0].starts, parts[0].ends)
    same = np.append(words[1:] == words[:-1], False)
    at, begins = _leading(parts[0].first[:-1], np.maximum(np.diff(parts[0].first) - 1, 0))
    made.append((np.where(same[at], _SAME, _OTHER), begins))
    return made


def _leading(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first ``counts`` items from each of ``first`` on, and their begins."""
    begins = np.concatenate(([0], np.cumsum(counts)))
    return np.repeat(first - begins[:-1], counts) + np.arange(begins[-1]), begins


def score_rows(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    logits = np.full(len(offsets) - 1, model.constant)
    for buckets, first in features(data, offsets):
        logits += learning.sums_by(model.weights[buckets], first) / np.maximum(np.diff(first), 1)
    return learning.sigmoid(logits)


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, seed: int = 11) -> Model:
    labels = np.asarray(labels, float)
    if len(np.unique(labels)) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    ids, values, first = _rows(texts)
    # The state of FTRL-proximal: z and n of each coordinate; the constant is the last.
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels).mean())

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    random = np.random.default_rng(seed)
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for low in range(0, len(order), batch):
            rows = order[low : low + batch]
            at, begins = bytesops.gathered(first, rows)
            own, x = np.append(ids[at], BUCKETS), values[at]
            w = weights(own)
            guess = learning.sigmoid(learning.sums_by(w[:-1] * x, begins) + w[-1])
            error = (guess - labels[rows]) * weight[rows]
            found, where = np.unique(own, return_inverse=True)
            gradient = np.bincount(where[:-1], np.repeat(error, np.diff(begins)) * x, len(found))
            gradient[where[-1]] += error.sum()
            w = weights(found)
            sigma = (np.sqrt(n[found] + gradient**2) - np.sqrt(n[found])) / ALPHA
            z[found] += gradient - sigma * w
            n[found] += gradient**2
    final = weights(np.arange(BUCKETS + 1))
    return Model(final[:-1].astype(np.float32), float(final[-1]))


def _rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text with their summed values; the texts are read in slices."""
    data, offsets = bytesops.text_bytes(pa.array(texts, pa.large_string()))
    ids, values, sizes = [np.empty(0, np.int32)], [np.empty(0, np.float32)], [np.zeros(1, np.int64)]
    for low, high in bytesops.slices(offsets, 1 << 20):
        own = offsets[low : high + 1]
        keys, parts = [], []
        for buckets, first in features(data[own[0] : own[-1]], own - own[0]):
            counts = np.diff(first)
            row = np.repeat(np.arange(high - low), counts)
            keys.append(row * BUCKETS + buckets)
            parts.append((1.0 / np.maximum(counts, 1))[row])
        found, where = np.unique(np.concatenate(keys), return_inverse=True)
        ids.append((found % BUCKETS).astype(np.int32))
        values.append(np.bincount(where, np.concatenate(parts), len(found)).astype(np.float32))
        sizes.append(np.bincount(found // BUCKETS, minlength=high - low))
    return np.concatenate(ids), np.concatenate(values), np.cumsum(np.concatenate(sizes))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = FOLDS,
    fold: int = FOLD,
    per_label: int = PER_LABEL,
    max_chars: int = MAX_CHARS,
) -> Model:
    """A model of up to ``per_label`` labelled texts of each kind, none of the held-out fold,
    each of at most ``max_chars`` characters."""
    learn = ~held_out("doc_id", folds, fold)
    rows = learning.sample(docs, labels, label, learn, {0: per_label, 1: per_label}, max_chars)
    return train([t for t, _ in rows], np.array([y for _, y in rows]))


def score(
    df: DataFrame,
    model: Model,
    text: str = "text",
    threshold: float = THRESHOLD,
    names: Sequence[str] = ("score", "predicted"),
) -> DataFrame:
    """``df`` with a score (0 to 1) and a prediction (1 if the score is at least ``threshold``)."""
    scored = learning.with_scores(df, text, {names[0]: "double"}, lambda d, o: [score_rows(model, d, o)])
    return scored.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
