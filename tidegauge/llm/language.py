"""Language of a text by a convolutional network over bytes.

A window of fixed length goes through a byte embedding, convolutions of several widths, max
pooling over the window and a softmax; all of it is trained in numpy on a bounded sample of
labelled text. A text is cut into windows from its first byte to its last (the last one is
padded), all windows of a batch are scored together, and the windows' log-probabilities are
averaged with their lengths as weights.

After training, embedding and convolution become one table for each tap: what a byte adds to
each filter at that place. Scoring adds table rows and takes maxima.

Defined results: ``und`` with score 0 for NULL and texts without a letter; texts are scored
whole; repeated rows score alike; without labelled rows everything is ``und``, with one label
everything with a letter has that label; ties go to the first label in order; an empty table
gives an empty table; columns of the input stay, and a column that has the name of a result is
replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm import bytesops, learning
from tidegauge.llm.frames import held_out

FOLDS, FOLD = 5, 0
SAMPLE = 4000
MAX_CHARS = 8000
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
DIMENSIONS = 8
EPOCHS = 6
BATCH = 64
WINDOWS_EACH = 3
UNKNOWN = "und"
_GROUP = 512


class Model(NamedTuple):
    labels: list[str]
    taps: np.ndarray  # (taps, 256, filters)
    bias: np.ndarray
    dense: np.ndarray
    constant: np.ndarray


def windows(data: np.ndarray, offsets: np.ndarray):
    """Rows of WINDOW bytes, zero-padded, with their text's row and true length."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    first = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(sizes)), counts)
    starts = offsets[row] + (np.arange(first[-1]) - first[row]) * WINDOW
    lengths = np.minimum(WINDOW, offsets[row + 1] - starts)
    return starts, lengths, row, first


def _cut(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts), WINDOW), np.uint8)
    place = np.arange(WINDOW)
    inside = place < lengths[:, None]
    out[inside] = data[(starts[:, None] + place)[inside]]
    return out


def _pooled(taps: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximum of each filter over a window, and where it is."""
    reach = WINDOW - len(taps) + 1
    total = np.take(taps[0], cut[:, :reach], axis=0)
    for k in range(1, len(taps)):
        total += np.take(taps[k], cut[:, k : k + reach], axis=0)
    return total.max(axis=1), total


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def predict_rows(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The label of each row and its probability."""
    rows = len(offsets) - 1
    lettered = has_letter(data, offsets)
    if not model.labels or not rows:
        return [UNKNOWN] * rows, np.zeros(rows)
    low = bytesops.lower(data)
    starts, lengths, row, first = windows(low, offsets)
    logs = np.zeros((len(starts), len(model.labels)))
    for k in range(0, len(starts), _GROUP):
        part = slice(k, k + _GROUP)
        best, _ = _pooled(model.taps, _cut(low, starts[part], lengths[part]))
        logs[part] = _log_softmax(np.maximum(best + model.bias, 0) @ model.dense + model.constant)
    logs *= lengths[:, None]
    total = np.stack([learning.sums_by(x, first) for x in logs.T], axis=1)
    mean = np.exp(_log_softmax(total / np.maximum(np.diff(offsets), 1)[:, None]))
    best = mean.argmax(axis=1)
    labels = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return labels, np.where(lettered, mean.max(axis=1), 0.0)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with an ASCII letter, or else with a letter of another script."""
    lower = data | 0x20
    ascii_letter = (lower >= 97) & (lower <= 122) & (data < 128)
    before = np.concatenate(([0], np.cumsum(ascii_letter)))
    found = before[offsets[1:]] > before[offsets[:-1]]
    other = np.concatenate(([0], np.cumsum(data >= 128)))
    for row in np.nonzero(~found & (other[offsets[1:]] > other[offsets[:-1]]))[0].tolist():
        found[row] = any(c.isalpha() for c in data[offsets[row] : offsets[row + 1]].tobytes().decode())
    return found


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Fit the network by Adam on up to WINDOWS_EACH random windows of each text."""
    names = sorted(set(labels))
    random = np.random.default_rng(seed)
    deepest = max(WIDTHS)
    filters = len(WIDTHS) * FILTERS
    # A filter has no taps beyond its width.
    live = (np.arange(deepest)[:, None] < np.repeat(WIDTHS, FILTERS)).astype(np.float32)
    embedding = random.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32)
    kernel = random.normal(0, 0.3, (deepest, DIMENSIONS, filters)).astype(np.float32) * live[:, None]
    bias = np.zeros(filters, np.float32)
    dense = random.normal(0, 0.1, (filters, len(names))).astype(np.float32)
    constant = np.zeros(len(names), np.float32)
    if len(names) > 1:
        data, offsets = bytesops.text_bytes(pa.array(texts, pa.large_string()))
        data = bytesops.lower(data)
        starts, lengths, row, first = windows(data, offsets)
        pick = random.random(len(starts)).argsort()
        pick = pick[np.argsort(row[pick], kind="stable")]
        nth = np.arange(len(pick)) - first[row[pick]]
        pick = np.sort(pick[nth < WINDOWS_EACH])
        cut, target = _cut(data, starts[pick], lengths[pick]), np.searchsorted(names, labels)[row[pick]]
        given = [embedding, kernel, bias, dense, constant]
        moments = [(np.zeros_like(x), np.zeros_like(x)) for x in given]
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(cut))
            for low in range(0, len(order), BATCH):
                own = order[low : low + BATCH]
                gradients = _gradients(cut[own], target[own], *given, live)
                step += 1
                for x, g, (a, b) in zip(given, gradients, moments, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    x -= 0.01 / (1 - 0.9**step) * a / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    taps = np.einsum("bd,kdf->kbf", embedding, kernel).astype(np.float32)
    return Model(names, np.ascontiguousarray(taps), bias, dense, constant)


def _gradients(cut, target, embedding, kernel, bias, dense, constant, live):
    taps = np.einsum("bd,kdf->kbf", embedding, kernel)
    best, total = _pooled(taps, cut)
    hidden = np.maximum(best + bias, 0)
    error = np.exp(_log_softmax(hidden @ dense + constant))
    error[np.arange(len(cut)), target] -= 1
    error /= len(cut)
    back = (error @ dense.T) * (hidden > 0)
    place = total.argmax(axis=1)
    row, column = np.arange(len(cut))[:, None], np.arange(kernel.shape[2])
    d_embedding, d_kernel = np.zeros_like(embedding), np.zeros_like(kernel)
    for k in range(len(kernel)):
        seen = cut[row, place + k]
        weight = back * live[k]
        d_kernel[k] = np.einsum("nf,nfd->df", weight, embedding[seen])
        np.add.at(d_embedding, seen, weight[..., None] * kernel[k].T[column])
    return d_embedding, d_kernel, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)


def fit(
    docs: DataFrame,
    label: str = "lang",
    folds: int = FOLDS,
    fold: int = FOLD,
    sample: int = SAMPLE,
    max_chars: int = MAX_CHARS,
) -> Model:
    """A network trained on up to ``sample`` labelled texts, none of the held-out fold, each
    of at most ``max_chars`` characters."""
    rows = learning.sample(docs, docs, label, ~held_out("doc_id", folds, fold), sample, max_chars)
    return train([t or "" for t, _ in rows], [str(y) for _, y in rows])


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred (a learned label or ``und``) and score (its probability)."""
    columns = {"lang_pred": "string", "score": "double"}
    return learning.with_scores(df, text, columns, lambda d, o: list(predict_rows(model, d, o)))
