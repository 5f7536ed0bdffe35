from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm.llm_helpers import kept_columns, odd_texts, rows
from pyspark.sql import functions as F

from tidegauge.llm import queries, repeats

LEAST = -(2**63)


def brute_force(docs, depth=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept) with every string of every text in one table."""
    raw = [(LEAST if n is None else n, (t or "").encode()) for n, t in docs]
    first = {}
    for number, text in sorted(raw):
        for k in range(len(text) - depth + 1):
            first.setdefault(text[k : k + depth], number)
    out = []
    for number, text in raw:
        gone = bytearray(len(text))
        for k in range(len(text) - depth + 1):
            if first[text[k : k + depth]] < number:
                gone[k : k + depth] = b"\x01" * depth
        spans = sum(gone[k] > (gone[k - 1] if k else 0) for k in range(len(gone)))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((None if number == LEAST else number, len(text), sum(gone), spans, kept))
    return out


def digests(found):
    return sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in found), key=str)


def result_rows(result):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans")
    return rows(result.select(*columns, F.sha2("kept", 256)))


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    result = queries.queries()["op4_suffix_repeats"](spark, sf_dir)
    assert result.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = rows(result)
    assert found == digests(brute_force([tuple(r) for r in docs]))
    assert sum(r[2] for r in found) > 0


@pytest.mark.parametrize(("seed", "depth", "key"), [(1, 50, 24), (2, 12, 5), (3, 8, 8), (4, 20, 1)])
def test_shuffled_passages(spark, seed, depth, key):
    pick = random.Random(seed)
    base = ["".join(pick.choice("abé ") for _ in range(pick.randrange(160))) for _ in range(12)]
    docs = []
    for _ in range(250):
        parts = [b[pick.randrange(40) : pick.randrange(30, 160)] for b in pick.sample(base, pick.randrange(4))]
        docs.append((pick.choice([None, *range(60)]), pick.choice([None, "", *["".join(parts)] * 6])))
    # Periodic texts have equal strings at overlapping places.
    docs += [(7, "x" * 300), (9, "x" * 200), (2, "xy" * 60), (8, "xy" * 90), (11, "xyx" * 40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    result = repeats.remove_repeats(df, depth=depth, key=key, block_bytes=300, bucket_bytes=100)
    assert result_rows(result) == digests(brute_force(docs, depth))


def test_a_line_in_many_surroundings(spark, monkeypatch, tmp_path):
    """No bucket of either pass grows with the number of documents that hold the line."""
    answer = repeats._answer

    def noted(pass_number):
        run = answer(pass_number)

        def note(table):
            size = sum(len(x) for x in table.column("keys").to_pylist()) // 5
            (tmp_path / f"{pass_number}-{table.column('bucket')[0]}").write_text(str(size))
            return run(table)

        return note

    monkeypatch.setattr(repeats, "_answer", noted)
    pick = random.Random(4)
    line = "Licensed under the terms that the file at the top of this tree has in full."
    docs = []
    for n in range(600):
        words = ["".join(pick.choice("abcdefghij") for _ in range(6)) for _ in range(24)]
        words[12:12] = [line] if n % 3 else [line[: pick.randrange(50, 76)]]
        docs.append((n if n % 50 else None, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    result = repeats.remove_repeats(df, block_bytes=40000, bucket_bytes=200)
    assert result_rows(result) == digests(brute_force(docs))
    for number in (1, 2):
        assert max(int(p.read_text()) for p in tmp_path.glob(f"{number}-*")) < 300


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_crowded_digits_with_few_letters(spark, seed):
    pick = random.Random(seed)
    docs = [(pick.randrange(150), "".join(pick.choice("ab") for _ in range(pick.randrange(90)))) for _ in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    result = repeats.remove_repeats(df, depth=9, key=3, block_bytes=2000, bucket_bytes=100)
    assert result_rows(result) == digests(brute_force(docs, 9))


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 64)
    pick = random.Random(9)
    text = "".join(pick.choice("abcd") for _ in range(700))
    docs = [(1, text), (2, text[100:400] + "zz" + text[350:650]), (3, text[390:]), (4, text)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert result_rows(repeats.remove_repeats(df)) == digests(brute_force(docs))


def test_odd_rows(odd):
    result = repeats.remove_repeats(odd)
    kept_columns(result, odd)
    assert result_rows(result) == digests(brute_force(odd_texts()))


def test_only_whole_characters_go(spark):
    passage = "é" * 30
    df = spark.createDataFrame([(1, "ab" + passage), (2, passage + "cd")], "doc_id int, text string")
    # The strings of the second document that the first has end within no character.
    found = {r.doc_id: r.kept_text for r in repeats.remove_repeats(df, depth=51).collect()}
    assert found == {1: "ab" + passage, 2: "cd"}
    found = {r.doc_id: r.kept_text for r in repeats.remove_repeats(df, depth=60).collect()}
    assert found[2] == "cd"


def test_empty_table_and_arguments(nothing):
    assert repeats.remove_repeats(nothing).collect() == []
    with pytest.raises(ValueError, match="key"):
        repeats.remove_repeats(nothing, depth=10, key=11)


def test_buckets_are_even_and_ascending(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toArrow()
    table = pa.table({"doc": docs.column("doc_id").cast(pa.int64()), "text": docs.column("text")})
    width = repeats.DEPTH - repeats.KEY + 1
    made = repeats._Block(table, repeats.DEPTH, repeats.KEY, {})
    for buckets in (8, 512):
        cuts = repeats._cuts(buckets, width)
        found = cuts.of(made.keys)
        sizes = np.bincount(found, minlength=buckets)
        assert len(sizes) == buckets and (np.diff(found) >= 0).all()
        assert sizes.max() < 2 * sizes.mean() and sizes.min() > 0
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 100_000, np.uint64))
    keys[0], keys[-1] = 0, 2**64 - 1
    for buckets in (1, 3, 4096, 10_000):
        cuts = repeats._cuts(buckets, 1)
        found = cuts.of(keys)
        assert (np.diff(found) >= 0).all() and found[0] == 0
        assert found[-1] == len(cuts.edges) * cuts.each - 1 and len(cuts.edges) * cuts.each >= buckets
        assert np.bincount(found).max() < 3 * len(keys) / buckets + 30
