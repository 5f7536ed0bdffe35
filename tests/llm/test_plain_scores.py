"""The classifiers' scores against plain Python over the same models, a row and a byte at a time."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm.llm_helpers import odd_texts
from pyspark.sql import functions as F

from tidegauge.llm import bytesops, language, learning, quality, toxicity

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+")
MASK = (1 << 64) - 1


def mixed(x):
    return int(bytesops.mix(np.array([x & MASK], np.uint64))[0])


def summed(raw):
    return sum((b + 1) * pow(bytesops._BASE, k, 1 << 64) for k, b in enumerate(raw)) & MASK


def word_hash(raw):
    return mixed(summed(raw) + len(raw) * 0xD6E8FEB86659FD93)


def sigmoid(x):
    return 1 / (1 + math.exp(-min(40.0, max(-40.0, x))))


def some_texts(seed):
    pick = random.Random(seed)
    words = ["ab", "Cd", "cd", "ÉÑ", "éñ", "x", "der", "…", "well-known", "42", "!?", "a.b"]
    made = [" ".join(pick.choice(words) for _ in range(pick.randrange(1, 60))) for _ in range(30)]
    return made + [t for _, t in odd_texts() if len(t or "") < 1000]


def scored(module, model, texts):
    data, offsets = bytesops.text_bytes(pa.array(texts, pa.large_string()))
    return module.score_rows(model, data, offsets)


def plain_quality(model, text):
    tokens = TOKEN.findall((text or "").encode())
    hashes = [word_hash(t) for t in tokens]
    logit = model.constant
    for size in quality.SIZES:
        grams = []
        for k in range(len(hashes) - size + 1):
            own = size
            for h in hashes[k : k + size]:
                own = mixed(own + h)
            grams.append(quality.RESERVED + own % (quality.BUCKETS - quality.RESERVED))
        if grams:
            logit += sum(float(model.weights[g]) for g in grams) / len(grams)
    words = WORD.findall((text or "").encode())
    pairs = list(zip(words[:-1], words[1:], strict=True))
    if pairs:
        logit += sum(float(model.weights[0 if a == b else 1]) for a, b in pairs) / len(pairs)
    return sigmoid(logit)


def test_quality():
    texts = some_texts(1)
    model = quality.train(texts, np.array([n % 2 for n in range(len(texts))]))
    wanted = [plain_quality(model, t) for t in texts]
    np.testing.assert_allclose(scored(quality, model, texts), wanted, rtol=1e-6)
    assert len(set(wanted)) > 20


def test_ftrl_steps_by_hand():
    """Two texts of one word each: their gradients are a half at first, and the constant's cancel."""
    place = [quality.RESERVED + mixed(1 + word_hash(w)) % (quality.BUCKETS - quality.RESERVED) for w in (b"a", b"b")]
    one = quality.train(["a", "b"], np.array([1, 0]), epochs=1, batch=2)
    first = (0.5 - 1e-4) / ((1 + 0.5) / 2 + 1e-4)
    assert one.weights[place[0]] == pytest.approx(first, rel=1e-6)
    assert one.weights[place[1]] == pytest.approx(-first, rel=1e-6)
    assert one.constant == 0 and np.count_nonzero(one.weights) == 2

    two = quality.train(["a", "b"], np.array([1, 0]), epochs=2, batch=2)
    gradient = sigmoid(first) - 1
    n = 0.25 + gradient**2
    z = -0.5 + gradient - (math.sqrt(n) - 0.5) / 2 * first
    second = (-z - 1e-4) / ((1 + math.sqrt(n)) / 2 + 1e-4)
    assert two.weights[place[0]] == pytest.approx(second, rel=1e-6)


def test_no_ngram_falls_on_a_reserved_bucket():
    data, offsets = bytesops.text_bytes(pa.array([" ".join(map(str, range(300_000)))]))
    found = quality.features(data, offsets)
    assert all(f[0].min() >= quality.RESERVED and f[0].max() < quality.BUCKETS for f in found[:2])
    assert set(found[2][0].tolist()) == {1}


def plain_toxicity(model, text):
    low = (text or "").encode()
    low = bytesops.lower(np.frombuffer(low, np.uint8)).tobytes() if low else low
    words = WORD.findall(low)
    best = None
    for k in range(0, len(words), toxicity.WORDS):
        total, count = 0.0, 0
        for word in words[k : k + toxicity.WORDS]:
            edged = b" " + word + b" "
            hashes = [word_hash(word)]
            for size in toxicity.GRAMS:
                hashes += [mixed(summed(edged[p : p + size])) for p in range(len(edged) - size + 1)]
            total += sum(float(model.scores[h % toxicity.BUCKETS]) for h in hashes)
            count += len(hashes)
        logit = model.constant + total / count
        best = logit if best is None else max(best, logit)
    return 0.0 if best is None else sigmoid(best)


def test_toxicity():
    texts = some_texts(2)
    model = toxicity.train(texts, np.array([n % 2 for n in range(len(texts))]))
    wanted = [plain_toxicity(model, t) for t in texts]
    np.testing.assert_allclose(scored(toxicity, model, texts), wanted, rtol=1e-5, atol=1e-9)
    assert len(set(wanted)) > 20


def log_softmax(x):
    top = max(x)
    total = math.log(sum(math.exp(v - top) for v in x))
    return [v - top - total for v in x]


def plain_language(model, text):
    raw = (text or "").encode()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    low = bytesops.lower(np.frombuffer(raw, np.uint8)).tobytes()
    taps = model.taps.astype(float)
    total = [0.0] * len(model.labels)
    for start in range(0, len(low), language.WINDOW):
        part = low[start : start + language.WINDOW]
        padded = part + bytes(language.WINDOW - len(part))
        out = model.constant.astype(float).tolist()
        for f in range(taps.shape[2]):
            places = range(language.WINDOW - len(taps) + 1)
            best = max(sum(taps[k, padded[p + k], f] for k in range(len(taps))) for p in places)
            hidden = max(0.0, best + float(model.bias[f]))
            out = [o + hidden * float(d) for o, d in zip(out, model.dense[f], strict=True)]
        total = [t + len(part) * x for t, x in zip(total, log_softmax(out), strict=True)]
    shares = [math.exp(x) for x in log_softmax([t / len(low) for t in total])]
    return model.labels[shares.index(max(shares))], max(shares)


def test_language():
    texts = ["der die das und nicht ein", "the and of that with a", "le la les des est une"] * 20
    model = language.train(texts, ["de", "en", "fr"] * 20)
    asked = [*texts[:3], *some_texts(3)[:8], "der und nicht " * 25, None, "", "42", "中文"]
    data, offsets = bytesops.text_bytes(pa.array(asked, pa.large_string()))
    labels, shares = language.predict_rows(model, data, offsets)
    wanted = [plain_language(model, t) for t in asked]
    assert labels == [w[0] for w in wanted]
    np.testing.assert_allclose(shares, [w[1] for w in wanted], rtol=1e-4)


def test_a_label_of_long_texts_only_gives_passages(spark):
    docs = [(n, f"{n} " + "long words " * 400 + "end", 1) for n in range(20)]
    docs += [(100 + n, "short", 0) for n in range(20)] + [(200, "far too long " * 90, 0)]
    df = spark.createDataFrame(docs, "doc_id int, text string, label int")
    taken = learning.sample(df, df, "label", F.lit(True), {0: 50, 1: 8}, 100)
    assert [t for t, y in taken if y == 0] == ["short"] * 20
    passages = [t for t, y in taken if y == 1]
    assert len(passages) == 8 and {len(t) for t in passages} == {100}
    assert len(set(passages)) > 1
    assert taken == learning.sample(df.repartition(5), df, "label", F.lit(True), {0: 50, 1: 8}, 100)


def test_repeated_ids_give_one_text_each(spark):
    docs = spark.createDataFrame([(n % 10, f"text {n}") for n in range(60)], "doc_id int, text string")
    labels = spark.createDataFrame([(n % 10, n % 2) for n in range(200)] * 2, "doc_id int, label int")
    first = learning.sample(docs, labels, "label", F.lit(True), {0: 4, 1: 3}, 100)
    assert [y for _, y in first].count(0) == 4 and [y for _, y in first].count(1) == 3
    again = learning.sample(docs.orderBy(F.desc("text")).coalesce(1), labels, "label", F.lit(True), {0: 4, 1: 3}, 100)
    assert first == again
