"""Quality, language and toxicity: fitted on part of the rows, held against the others."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from llm.llm_helpers import LONG, fold, kept_columns, odd_texts
from pyspark.sql import functions as F

from tidegauge.llm import bytesops, language, learning, quality, queries, toxicity

SIZED = "/root/testdata/sf0.01"


def scored(module, model, texts):
    data, offsets = bytesops.text_bytes(pa.array(texts, pa.large_string()))
    return module.score_rows(model, data, offsets)


def labelled(spark, label, folds, own):
    docs = spark.read.parquet(f"{SIZED}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SIZED}/labels.parquet").select("doc_id", label)
    found = docs.join(labels, "doc_id").collect()
    return {r.doc_id: r[label] for r in found if fold(r.doc_id, folds) == own}


def area(scores, truth):
    """The share of pairs of a positive and a negative in the right order."""
    positive, negative = scores[truth == 1], scores[truth == 0]
    return (positive[:, None] > negative).mean() + 0.5 * (positive[:, None] == negative).mean()


@pytest.mark.parametrize(
    ("name", "label", "folds", "own", "least"),
    [("op2_quality_ftrl", "quality", 5, 0, 0.97), ("op9_toxicity", "toxic", 4, 2, 0.9)],
)
def test_held_out_rows(spark, sf_dir, name, label, folds, own, least):
    truth = labelled(spark, label, folds, own)
    result = queries.queries()[name](spark, SIZED)
    assert result.dtypes == [
        ("doc_id", "bigint"),
        ("held_out", "boolean"),
        ("score", "double"),
        ("predicted", "int"),
    ]
    found = {r.doc_id: r for r in result.collect()}
    assert all(r.held_out == (fold(n, folds) == own) for n, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    scores = np.array([found[n].score for n in truth])
    wanted = np.array(list(truth.values()))
    assert area(scores, wanted) >= least
    assert ((scores >= 0.3) == (wanted == 1)).mean() >= 0.9


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{SIZED}/documents.parquet").select("doc_id", "lang").collect()
    result = queries.queries()["op3_language_cnn"](spark, SIZED)
    assert result.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {r.doc_id: r for r in result.collect()}
    held = [r for r in docs if fold(r.doc_id, 5) == 0]
    assert all(found[r.doc_id].held_out == (fold(r.doc_id, 5) == 0) for r in docs)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_nothing_is_learned_from_held_out_rows(spark):
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id bigint, toxic int")
    docs = labels.selectExpr("doc_id", "cast(doc_id as string) as text")
    from tidegauge.llm.frames import held_out

    rows = learning.sample(docs, labels, "toxic", ~held_out("doc_id", 4, 2), {0: 1000, 1: 1000}, 100)
    assert [int(t) for t, _ in rows] == [n for n in range(200) if fold(n, 4) != 2]
    few = learning.sample(docs, labels, "toxic", ~held_out("doc_id", 4, 2), {0: 5, 1: 7}, 100)
    assert sorted(y for _, y in few) == [0] * 5 + [1] * 7
    assert learning.sample(docs, labels, "toxic", ~held_out("doc_id", 4, 2), 9, 1) != few


def test_an_unseen_spelling_is_toxic(spark):
    pick = random.Random(2)
    words = ["".join(pick.choice("abcdeilmnorst") for _ in range(pick.randrange(2, 9))) for _ in range(400)]
    texts, labels = [], []
    for n in range(1200):
        text = [pick.choice(words) for _ in range(pick.randrange(10, 80))]
        if n % 3 == 0:
            text.insert(pick.randrange(len(text)), pick.choice(["zugwurm", "zugwurmig", "erzugwurm"]))
        texts.append(" ".join(text))
        labels.append(int(n % 3 == 0))
    model = toxicity.train(texts, np.array(labels))
    clean = [" ".join(pick.choice(words) for _ in range(400)) for _ in range(20)]
    unseen = [f"{t} zugwurmmen {t}" for t in clean]
    scores = np.concatenate([scored(toxicity, model, unseen), scored(toxicity, model, clean)])
    assert area(scores, np.repeat([1, 0], 20)) >= 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_don_t_depend_on_slices(module):
    pick = random.Random(3)
    texts = [t for _, t in odd_texts()]
    texts += [" ".join(pick.choice(["ab", "Cd", "é!", "..."]) for _ in range(30)) for _ in range(40)]
    model = module.train(texts, np.array([n % 2 for n in range(len(texts))]))
    together = scored(module, model, texts)
    apart = np.concatenate([scored(module, model, [t]) for t in texts])
    np.testing.assert_allclose(together, apart, rtol=1e-6, atol=1e-9)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(odd, nothing, module):
    model = module.train(["good text here", "bad word there"], np.array([1, 0]))
    result = module.score(odd, model)
    kept_columns(result, odd)
    found = result.collect()
    assert len(found) == len(odd_texts()) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.text in (None, "")}) == 1
    assert len({r.score for r in found if r.text == LONG}) == 1
    assert module.score(nothing, model).collect() == []
    named = module.score(odd.withColumnRenamed("words", "score"), model, names=("s", "p"))
    assert {r.score for r in named.collect()} == {"kept as it was"}


def test_without_labels(nothing, odd):
    model = toxicity.fit(nothing, nothing)
    assert {r.score < 1e-9 for r in toxicity.score(odd, model).collect()} == {True}
    model = quality.fit(nothing, nothing)
    assert {r.score for r in quality.score(odd, model).collect()} == {0.5}
    model = language.fit(nothing)
    assert {r.lang_pred for r in language.predict(odd, model).collect()} == {"und"}


def test_languages_of_odd_rows(odd, nothing):
    texts = ["der die das und nicht", "the and of that with", "le la les des est"] * 20
    model = language.train(texts, ["de", "en", "fr"] * 20)
    result = language.predict(odd, model)
    kept_columns(result, odd)
    for r in result.collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in {"de", "en", "fr"}) == lettered
        assert (r.lang_pred == "und") == (r.score == 0)
    assert language.predict(nothing, model).collect() == []
    only = language.train(texts, ["xx"] * 60)
    assert {r.lang_pred for r in language.predict(odd, only).collect()} == {"xx", "und"}


def test_every_byte_of_a_text_counts():
    texts = ["aaaa bbbb " * 8, "yyyy zzzz " * 8] * 30
    model = language.train(texts, ["ab", "yz"] * 30)
    tail = "aaaa bbbb " * 30 + "yyyy zzzz " * 400
    data, offsets = bytesops.text_bytes(pa.array([tail]))
    assert language.predict_rows(model, data, offsets)[0] == ["yz"]


def test_other_scripts_have_letters():
    texts = ["中", "…", "٣", "7", "é", "", "🙂", "́"]
    data, offsets = bytesops.text_bytes(pa.array(texts))
    assert language.has_letter(data, offsets).tolist() == [any(c.isalpha() for c in t) for t in texts]


def test_a_sample_has_rare_labels_and_all_short_texts(spark):
    docs = [(n, "word " * (50 if n % 2 else 1), "en" if n % 500 else "nv") for n in range(2000)]
    df = spark.createDataFrame(docs, "doc_id int, text string, lang string").repartition(3)
    every = F.lit(True)
    some = learning.sample(df, df, "lang", every, 40, 1000)
    assert len(some) == 40
    assert sum(label == "nv" for _, label in some) == 4
    short = learning.sample(df, df, "lang", every, 1000, 10)
    assert len(short) == 1000
    assert {text for text, _ in short} == {"word "}
    each = learning.sample(df, df, "lang", every, {"en": 900, "nv": 3}, 10)
    assert [sum(label == x for _, label in each) for x in ("en", "nv")] == [900, 3]


def test_toxicity_learns_from_3000_negatives(spark, monkeypatch):
    counts = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: counts.append((len(texts), int(labels.sum()))))
    labels = spark.range(9000).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as toxic")
    toxicity.fit(labels.selectExpr("doc_id", "cast(doc_id as string) as text"), labels)
    assert counts == [(4500, 1500)]
