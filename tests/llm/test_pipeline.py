"""Each stage of the pipeline on what the one before it kept, against brute force."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from llm.llm_helpers import kept_columns, odd_texts, rows, similar_classes, windows_of
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, toxicity
from tidegauge.llm.frames import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The input and the result of each stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, sf_dir), name)
        out.append((name, docs, made))
        docs = made
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(stages):
    assert [name for name, *_ in stages] == ["toxicity", "near_copies", "repeats", "decontamination", "bpe"]
    assert all(made.columns == COLUMNS for _, _, made in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxic_documents_go(spark, sf_dir, stages):
    _, given, made = stages[0]
    model = toxicity.fit(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(given, model).where("predicted = 0").select(COLUMNS)
    assert rows(made) == rows(scored)
    assert 0 < made.count() < given.count()


def test_one_document_of_each_class_stays(stages):
    _, given, made = stages[1]
    docs = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    firsts = {c for _, c, _ in similar_classes(docs)}
    assert set(by_id(made)) == firsts and len(firsts) < len(docs)
    kept = by_id(given)
    assert all(kept[n] == r for n, r in by_id(made).items())


def test_repeats_are_cut(stages):
    _, given, made = stages[2]
    before, after = by_id(given), by_id(made)
    assert before.keys() == after.keys()
    first = {}
    for n in sorted(before):
        for w in windows_of(before[n].text):
            first.setdefault(w, n)
    for n, r in before.items():
        raw, gone = r.text.encode(), bytearray(len(r.text.encode()))
        for k, w in enumerate(windows_of(r.text)):
            if first[w] < n:
                gone[k : k + 50] = b"\x01" * 50
        kept, at = [], 0
        for c in r.text:
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        assert at == len(raw)
        assert after[n].text == "".join(kept) and after[n].n_chars == len(kept)
        assert (after[n].lang, after[n].source) == (r.lang, r.source)


def test_contaminated_documents_go(duck, stages):
    _, given, made = stages[3]
    cursor = duck.cursor()
    cursor.register("documents", given.toPandas())
    found = {r[0] for r in cursor.execute(decontaminate.contaminated_sql()).fetchall()}
    assert rows(made) == sorted((tuple(r) for n, r in by_id(given).items() if n not in found), key=str)


def test_the_rest_is_encoded(stages):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    _, given, made = stages[4]
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for n, r in by_id(given).items():
        ids = theirs.encode(r.text, add_special_tokens=False).ids
        texts = (" ".join(map(str, ids)), theirs.decode(ids, skip_special_tokens=False))
        wanted.append((n, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    assert rows(made) == sorted(wanted, key=str)


def test_run_is_all_stages(spark, sf_dir, stages):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(stages[-1][2])


def test_odd_rows(spark, sf_dir, odd):
    clashing = odd.withColumns({c: F.lit(1) for c in ("score", "predicted", "class_id", "is_first", "kept", "n_chars")})
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == clashing.columns
        kept_columns(docs, clashing)
    # Exact copies with words go; texts without words stay.
    found = [(r.doc_id, r.text) for r in docs.collect()]
    texts = {t for _, t in odd_texts() if t}
    assert {t for _, t in found if t} == texts
    assert sum(not t for _, t in found) == 3
    assert corpus_pipeline.encode(spark, docs, sf_dir).count() == len(found)


def test_empty_table(spark, sf_dir, nothing):
    docs = nothing.select("doc_id", "text", "lang")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []
