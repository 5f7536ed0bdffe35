"""Toxicity by subword-bag embeddings that are averaged into a linear softmax.

A word is a run of letters and digits, in lower case, and its subwords are the word itself and
its byte n-grams, a word's edges included. Subwords are hashed into one table of vectors, so
an unseen spelling of a word has most of that word's vectors. The vectors of a passage of a few
words are averaged and go through a linear softmax; a document is as toxic as its most toxic
passage, whatever its length. Vectors and softmax are trained together with numpy on a bounded
sample: first with each passage labelled as its document, then with each document's most toxic
passage alone.

Since averaging and the softmax's score difference are both linear, scoring needs one number
for each row of the table.

Defined results: NULL, empty texts and texts without words score 0; texts are scored whole;
repeated rows score alike; without labelled rows of both kinds everything scores 0; an empty
table gives an empty table; columns of the input stay, and a column that has the name of a
result is replaced.
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

FOLDS, FOLD = 4, 2
THRESHOLD = 0.3
NEGATIVES, POSITIVES = 3000, 1500
MAX_CHARS = 8000
WORDS = 5
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIMENSIONS = 8
POSITIVE_SHARE = 0.25
DECAY = 1e-6
PARTS = 8


class Model(NamedTuple):
    """A number for each subword bucket, and the constant."""

    scores: np.ndarray
    constant: float


def _bounded(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes with a blank for all that isn't a word, a blank before and after each
    row, and the words there."""
    low = bytesops.lower(data)
    low = np.where(bytesops._WORD[low], low, np.uint8(32))
    rows = len(offsets) - 1
    padded = np.full(len(low) + rows + 1, 32, np.uint8)
    places = np.ones(len(padded), bool)
    edges = offsets + np.arange(rows + 1)
    places[edges] = False
    padded[places] = low
    return padded, bytesops.words(padded, edges)


def _grams(padded: np.ndarray, rolling: bytesops.Rolling, size: int):
    """Places of n-grams within a word and its two edges, and their buckets."""
    blank = np.concatenate(([0], np.cumsum(padded == 32)))
    count = max(0, len(padded) - size + 1)
    inner = blank[size - 1 : size - 1 + count] - blank[1 : count + 1]
    at = np.nonzero(inner == 0)[0]
    hashes = rolling.windows(size)[at]
    return at, (hashes % U64(BUCKETS)).astype(np.int64)


def passages(words: bytesops.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of each passage (and the end of the last), and the first passage of each row."""
    counts = np.diff(words.first)
    made = -(-counts // size)
    first = np.concatenate(([0], np.cumsum(made)))
    row = np.repeat(np.arange(len(counts)), made)
    begins = words.first[row] + (np.arange(first[-1]) - first[row]) * size
    return np.append(begins, words.first[-1]), first


def score_rows(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of each row's most toxic passage."""
    padded, words = _bounded(data, offsets)
    out = np.zeros(len(offsets) - 1)
    if not len(words.starts):
        return out
    rolling = bytesops.Rolling(padded)
    whole = (rolling.ranges(words.starts, words.ends) % U64(BUCKETS)).astype(np.int64)
    value, count = model.scores[whole].astype(np.float64), np.ones(len(whole))
    for size in GRAMS:
        at, buckets = _grams(padded, rolling, size)
        # An n-gram lies in the word of its second byte (its first may be the word's edge).
        cuts = np.searchsorted(at, np.append(words.starts, len(padded)) - 1)
        value += learning.sums_by(model.scores[buckets], cuts)
        count += np.diff(cuts)
    begins, first = passages(words, WORDS)
    logits = model.constant + np.add.reduceat(value, begins[:-1]) / np.add.reduceat(count, begins[:-1])
    full = np.nonzero(np.diff(first))[0]
    out[full] = learning.sigmoid(np.maximum.reduceat(logits, first[full]))
    return out


class _Features(NamedTuple):
    """Distinct words with their subwords, and passages of word numbers."""

    subwords: np.ndarray
    sub_first: np.ndarray
    numbers: np.ndarray
    begins: np.ndarray
    rows: np.ndarray


def _features(texts: list[str]) -> _Features:
    """The texts are read in slices, and the distinct words then get their subwords."""
    data, offsets = bytesops.text_bytes(pa.array(texts, pa.large_string()))
    hashes, counts, known = [], [], {}
    for low, high in bytesops.slices(offsets, 1 << 20):
        own = offsets[low : high + 1]
        padded, words = _bounded(data[own[0] : own[-1]], own - own[0])
        found = bytesops.Rolling(padded).ranges(words.starts, words.ends)
        hashes.append(found)
        counts.append(np.diff(words.first))
        raw = padded.tobytes()
        for number, at in zip(*np.unique(found, return_index=True), strict=True):
            if number not in known:
                known[number] = raw[words.starts[at] : words.ends[at]]
    ordered, numbers = np.unique(np.concatenate(hashes or [np.empty(0, U64)]), return_inverse=True)
    first = np.concatenate(([0], np.cumsum(np.concatenate(counts or [np.empty(0, np.int64)]))))
    spans = bytesops.Words(*(np.empty(0, np.int64),) * 3, first)
    padded, words = _bounded(*bytesops.text_bytes(pa.array([known[x] for x in ordered], pa.large_binary())))
    rolling = bytesops.Rolling(padded)
    whole = rolling.ranges(words.starts, words.ends)
    parts = [((whole % U64(BUCKETS)).astype(np.int32), np.arange(len(whole), dtype=np.int32))]
    for size in GRAMS:
        gram_at, buckets = _grams(padded, rolling, size)
        word = np.searchsorted(words.starts, gram_at + 1, side="right") - 1
        parts.append((buckets.astype(np.int32), word.astype(np.int32)))
    subwords, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(owner, kind="stable")
    begins, passage_first = passages(spans, WORDS)
    sub_first = np.searchsorted(owner[order], np.arange(len(ordered) + 1))
    rows = np.repeat(np.arange(len(texts)), np.diff(passage_first))
    return _Features(subwords[order], sub_first, numbers, begins, rows)


class _Adam:
    def __init__(self, rate: float) -> None:
        self._rate, self._step, self._moments = rate, 0, {}

    def update(self, name: str, x: np.ndarray, gradient: np.ndarray) -> None:
        first, second = self._moments.setdefault(name, (np.zeros_like(x), np.zeros_like(x)))
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient * gradient - second)
        x -= self._rate / (1 - 0.9**self._step) * first / (np.sqrt(second / (1 - 0.99**self._step)) + 1e-8)

    def step(self) -> None:
        self._step += 1


def train(texts: list[str], labels: np.ndarray, warm: int = 32, rounds: int = 14, steps: int = 6, seed: int = 7) -> Model:
    """Fit vectors and softmax by Adam: ``warm`` steps, each over one of PARTS parts of the
    passages (which bounds memory), then ``rounds`` in which each document's most toxic passage is found and ``steps`` are made over those."""
    labels = np.asarray(labels, float)
    made = _features(texts)
    if not len(made.rows) or len(np.unique(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.1, (DIMENSIONS + 1, 2)).astype(np.float32)
    sizes = np.diff(made.sub_first)
    weight = np.where(labels == 1, POSITIVE_SHARE / labels.sum(), (1 - POSITIVE_SHARE) / (1 - labels).sum())
    full = np.nonzero(np.bincount(made.rows, minlength=len(texts)))[0]
    heads = np.searchsorted(made.rows, full)
    passage_sizes = learning.sums_by(sizes[made.numbers], made.begins)
    adam = _Adam(0.05)

    def step(chosen: np.ndarray, share: np.ndarray) -> None:
        at, begins = bytesops.gathered(made.begins, chosen)
        words, numbers = np.unique(made.numbers[at], return_inverse=True)
        sub_at, sub_begins = bytesops.gathered(made.sub_first, words)
        subwords = made.subwords[sub_at]
        word = np.add.reduceat(vectors[subwords], sub_begins[:-1])
        means = np.add.reduceat(word[numbers], begins[:-1]) / passage_sizes[chosen, None].astype(np.float32)
        logits = means @ softmax[:-1] + softmax[-1]
        error = (learning.sigmoid(logits[:, 1] - logits[:, 0]) - labels[made.rows[chosen]]) * share
        both = np.stack((-error, error), axis=1)
        down = np.concatenate((means.T @ both, both.sum(axis=0)[None])) + DECAY * softmax
        by_word = np.bincount(numbers, np.repeat(error / passage_sizes[chosen], np.diff(begins)), len(words))
        by_bucket = np.bincount(subwords, np.repeat(by_word, np.diff(sub_begins)), BUCKETS).astype(np.float32)
        up = by_bucket[:, None] * (softmax[:-1, 1] - softmax[:-1, 0]) + DECAY * vectors
        adam.step()
        adam.update("vectors", vectors, up)
        adam.update("softmax", softmax, down.astype(np.float32))

    everything = np.arange(len(made.rows))
    share = weight[made.rows] / np.bincount(made.rows, minlength=len(texts))[made.rows]
    for k in range(warm):
        part = everything[k % PARTS :: PARTS]
        step(part, share[part] * PARTS)
    for _ in range(rounds):
        difference = softmax[:, 1] - softmax[:, 0]
        value = (vectors @ difference[:-1])[made.subwords]
        word = np.add.reduceat(value, made.sub_first[:-1])
        toxic = np.add.reduceat(word[made.numbers], made.begins[:-1]) / passage_sizes
        best = np.repeat(np.maximum.reduceat(toxic, heads), np.diff(np.append(heads, len(toxic))))
        hit = np.nonzero(toxic == best)[0]
        chosen = hit[np.unique(made.rows[hit], return_index=True)[1]]
        for _ in range(steps):
            step(chosen, weight[made.rows[chosen]])
    difference = softmax[:, 1] - softmax[:, 0]
    return Model((vectors @ difference[:-1]).astype(np.float32), float(difference[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = FOLDS,
    fold: int = FOLD,
    negatives: int = NEGATIVES,
    positives: int = POSITIVES,
    max_chars: int = MAX_CHARS,
) -> Model:
    """A model of up to so many labelled texts of each kind, none of the held-out fold,
    each of at most ``max_chars`` characters."""
    learn = ~held_out("doc_id", folds, fold)
    rows = learning.sample(docs, labels, label, learn, {0: negatives, 1: positives}, max_chars)
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
