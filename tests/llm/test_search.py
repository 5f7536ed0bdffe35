"""Top-k search, benchmark passages and licences: by SQL, and by brute force."""

from __future__ import annotations

import itertools
import math
import random
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from llm.llm_helpers import of_sql, odd_texts, rows

from tidegauge.llm import decontaminate, licences, queries, topk


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    result = queries.queries()[name](spark, sf_dir)
    found = rows(result)
    assert found == of_sql(duck, queries.oracle_sql()[name], result.columns)
    assert found


# --- Top k --------------------------------------------------------------------------


def brute_force(data, k, every, scale=256):
    good = []
    for number, vector in data:
        if number is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((number, [math.floor(scale * x) for x in vector]))
    asked = {}
    for number, vector in good:
        if number % every == 0:
            asked[number] = min(vector, asked.get(number, vector))
    out = []
    for number, query in asked.items():
        scores = [
            (-sum(a * b for a, b in zip(query, v, strict=True)), other)
            for other, v in good
            if other != number and len(v) == len(query)
        ]
        out += [(number, r, other, -s) for r, (s, other) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def search(spark, data, k=5, every=5, **options):
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").repartition(3)
    options = {"query_rows": 4, "candidate_rows": 8} | options
    return rows(topk.top_k(df, k=k, every=every, **options))


@pytest.mark.parametrize(("seed", "bins"), [(1, 64), (2, 2), (3, 7)])
def test_random_vectors_with_many_ties(spark, seed, bins):
    pick = random.Random(seed)
    few = [[pick.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)] for _ in range(6)]
    data = [(n, pick.choice(few)) for n in range(60)]
    data += [(100 + n, [pick.gauss(0, 1) for _ in range(3)]) for n in range(30)]
    assert search(spark, data, bins=bins) == brute_force(data, 5, 5)


def test_vectors_that_take_no_part(spark):
    data = [
        (0, [1.0, 2.0]),
        (1, [1.0, None]),
        (2, None),
        (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (5, []),
        (6, [1.0]),
        (10, []),
        (7, [-1.0, 0.0]),
        (8, [1e6, -1e6]),
        (8, [1e6, -1e6]),
        (15, [1.0, 1.0]),
        (15, [0.0, 1.0]),
        (20, [0.5] * 5),
    ]
    found = search(spark, data)
    assert found == brute_force(data, 5, 5)
    assert not [r for r in found if r[0] == 20]


def test_fewer_candidates_than_k_and_none(spark):
    data = [(0, [1.0]), (1, [2.0]), (5, [3.0])]
    assert search(spark, data, k=9) == brute_force(data, 9, 5)
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert search(spark, []) == []


def test_scores_beyond_64_bits(spark):
    data = [(0, [1e300, 1.0]), (1, [1e300, 1e300]), (2, [0.5, 0.25]), (3, [1e9, 1e9]), (4, [-1e300, 0.0])]
    found = [(r[2], r[3]) for r in search(spark, data, every=10)]
    assert [found[k] for k in (0, 3)] == [(1, 2**63 - 1), (4, -(2**63 - 1))]
    assert len(found) == 4


def test_large_scores_are_exact(spark):
    """Up to the last whole number of 64 bits, and held there beyond."""
    pick = random.Random(12)
    far = [2**31 / 256, (2**31 + 1) / 256, 3e9 / 256, -(2**31) / 256, 2**-8, -(2**-8), 2.0**54, 0.0]
    data = [(n, [pick.choice(far), pick.choice(far)]) for n in range(60)]
    data += [(100 + n, [2.0**23 + n * 2**-8, 0.0]) for n in range(8)]
    wanted = []
    for q, v in data:
        if q % 10 == 0:
            scores = []
            for c, w in data:
                if c != q:
                    whole = sum(int(256 * a) * int(256 * b) for a, b in zip(v, w))
                    scores.append((-max(1 - 2**63, min(2**63 - 1, whole)), c))
            wanted += [(q, k, c, -s) for k, (s, c) in enumerate(sorted(scores)[:5], 1)]
    assert search(spark, data, every=10, candidate_rows=16) == sorted(wanted, key=str)


def test_one_vector_that_most_rows_share(spark):
    data = [(n, [0.5, 0.5]) for n in range(300)] + [(300 + n, [0.1 * n, 0.0]) for n in range(10)]
    found = search(spark, data, every=50, candidate_rows=20)
    assert found == brute_force(data, 5, 50)


# --- Benchmark passages ---------------------------------------------------------------


def passages():
    pick = random.Random(6)
    items = [[f"w{pick.randrange(300)}" for _ in range(n)] for n in (40, 25, 12, 20, 4, 3, 0)]
    docs = []
    for n in range(120):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(60))]
        if n % 2:
            part = list(pick.choice(items))
            for _ in range(pick.choice([0, 0, 1, 3, 6])):
                if part:
                    part[pick.randrange(len(part))] = "other"
            at = pick.randrange(len(words) + 1)
            words[at:at] = part[pick.choice([0, 0, 8]) :]
        docs.append((n % 100, ", ".join(words).upper() if n % 3 else " ".join(words)))
    return docs, [(n, " ".join(w)) for n, w in enumerate(items)]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_passages_with_substitutions(spark, duck, limit):
    docs, items = passages()
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id int, text string")
    cursor = duck.cursor()
    cursor.register("documents", frame.toPandas())
    cursor.register("benchmark", tests.toPandas())
    result = decontaminate.contaminated(frame, tests, broadcast_bytes=limit)
    wanted = of_sql(cursor, decontaminate.contaminated_sql(), result.columns)
    assert rows(result) == wanted
    found = {(r[0], r[1]) for r in wanted}
    assert len(found) > 20


def test_both_paths_count_the_same_hits(spark):
    """Also where ids repeat with the same text or another, or are NULL."""
    docs, items = passages()
    docs = [(n if n % 3 else None, text) for n, text in docs + docs[:40]]
    items = [(n if n != 1 else None, text) for n, text in items] + [(0, items[1][1]), (None, items[3][1])]
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id int, text string")
    found = [
        rows(decontaminate.contaminated(frame, tests, broadcast_bytes=limit))
        for limit in (decontaminate.BROADCAST_BYTES, 0)
    ]
    assert found[0] == found[1]
    assert len(found[0]) > 20


def test_an_exact_passage_is_found_and_a_clean_text_is_not(spark):
    passage = " ".join(f"p{n}" for n in range(24))
    docs = [(1, f"before {passage} after"), (2, "p0 p1 p2 p3 and nothing else of it"), (3, None), (None, passage)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    tests = spark.createDataFrame([(9, passage), (9, passage), (None, "x " * 30), (8, None)], "item_id int, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        found = decontaminate.contaminated(frame, tests, broadcast_bytes=limit)
        assert {(r.doc_id, r.item_id, r.n_equal) for r in found.collect()} == {(1, 9, 20), (None, 9, 20)}


def best_windows(words, item, window=20, share=0.8):
    """The most equal tokens in a window of the item that a seed hit in the text is in, or None."""
    masks = [[k for k, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    width, most = min(window, len(item)), 0
    for at, pos in itertools.product(range(len(item)), range(len(words))):
        seeds = [m for m in masks if at + m[-1] < len(item) and pos + m[-1] < len(words)]
        if any(all(item[at + k] == words[pos + k] for k in m) for m in seeds):
            for first in range(max(0, at - width + 1), min(at, len(item) - width) + 1):
                places = [(k, k + pos - at) for k in range(first, first + width)]
                most = max(most, sum(0 <= d < len(words) and item[k] == words[d] for k, d in places))
    return most if most >= math.ceil(share * width) else None


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_every_window_that_holds_a_hit(spark, limit):
    pick = random.Random(11)
    items = [[f"w{pick.randrange(300)}" for _ in range(n)] for n in (50, 50, 30, 20, 12, 5)]
    docs = []
    for _ in range(60):
        item = pick.choice(items)
        at = pick.randrange(max(1, len(item) - 19))
        part = item[at : at + 20]
        for k in pick.sample(range(len(part)), len(part) // 5):
            part[k] = "other"
        before, after = ([f"x{pick.randrange(99)}" for _ in range(pick.choice([0, 30]))] for _ in range(2))
        docs.append(before + part + after)
    frame = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(docs)], "doc_id int, text string")
    tests = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id int, text string")
    best = decontaminate.contaminated(frame, tests, broadcast_bytes=limit)
    found = {(r.doc_id, r.item_id): r.n_equal for r in best.collect()}
    wanted = {(n, m): best_windows(d, i) for n, d in enumerate(docs) for m, i in enumerate(items)}
    assert found == {k: v for k, v in wanted.items() if v is not None}


def test_all_quoted_parts_are_found(spark):
    """Parts of a longer item with up to six tokens of them substituted, in clean text."""
    pick = random.Random(21)
    item = [f"w{n}" for n in range(50)]
    docs, wanted = [], set()
    for n in range(400):
        size, changed = pick.choice([20, 22, 25]), pick.randrange(1, 7)
        at = pick.randrange(len(item) - size + 1)
        part = item[at : at + size]
        for k in pick.sample(range(size), changed):
            part[k] = "other"
        same = [w != "other" for w in part]
        if max(sum(same[k : k + 20]) for k in range(size - 19)) >= 16:
            wanted.add(n)
        docs.append((n, " ".join([*(f"x{pick.randrange(99)}" for _ in range(30)), *part, *(f"y{k}" for k in range(30))])))
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id int, text string")
    found = {r.doc_id for r in decontaminate.contaminated(frame, tests).collect()}
    assert 250 < len(wanted) < 400
    assert wanted <= found


def test_the_pipeline_drops_a_quoted_part(spark, tmp_path):
    words = [f"p{n}" for n in range(50)]
    part = [w if k not in (3, 7, 11, 15) else "other" for k, w in enumerate(words[15:35])]
    quoted = " ".join(["q"] * 30 + part + ["q"] * 30)
    spark.createDataFrame([(1, " ".join(words))], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, quoted), (2, "a clean text")], "doc_id int, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert [r.doc_id for r in kept.collect()] == [2]


def test_odd_documents_and_empty_tables(odd, nothing, spark):
    tests = spark.createDataFrame([(1, odd_texts()[9][1]), (2, "river stone " * 12)], "item_id int, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, tests).collect()}
    assert found == {(10, 1), (8, 2), (9, 2)}
    assert decontaminate.contaminated(nothing, tests).collect() == []
    empty = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contaminated(odd, empty).collect() == []
    with pytest.raises(ValueError, match="mask"):
        decontaminate.contaminated(odd, tests, masks=("0110",))


# --- Licences ---------------------------------------------------------------------------


def test_licence_texts_in_other_dress(spark):
    mit = licences.TEXTS[0][1]
    docs = [
        (1, "Copyright (c) 2001 A. Writer\nAll rights reserved.\n\n" + mit),
        (2, "// " + mit.replace("\n", "\n// ").upper().replace("SUBLICENSE", "SUB-LICENCE")),
        (3, mit + " and more"),
        (4, "text\nThis work is LICENCED under\nReleased under the MIT Licence\n  licensed under CC BY-NC 4.0"),
        (5, None),
        (6, ""),
        (6, "SPDX-License-Identifier: MIT"),
        (None, licences.TEXTS[-1][1]),
    ]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    found = sorted(((r.doc_id, r.license_id, r.notices) for r in licences.scan(frame).collect()), key=str)
    assert found == sorted(
        [
            (1, "MIT", ""),
            (2, "MIT", ""),
            (3, None, ""),
            (4, None, "CC-BY-NC-4.0,MIT"),
            (5, None, ""),
            (6, None, "MIT"),
            (6, None, "MIT"),
            (None, "Apache-2.0", ""),
        ],
        key=str,
    )


def test_whole_licence_texts_of_this_system(spark, tmp_path):
    """The public texts that come with the system, rewrapped, in SQL too."""
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    there = [name for name in names if (folder / name).exists()]
    if not there:
        pytest.skip("no licence texts on this system")
    docs = [(k, (folder / name).read_text().replace("\n\n", "\r\n \t\r\n").upper()) for k, name in enumerate(there)]
    docs += [(100 + k, text + "\nand more") for k, text in docs]
    docs += [(200 + k, f"code\n# {line}\nmore") for k, (_, line) in enumerate(licences.NOTICES)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    rows = licences.scan(frame).select("doc_id", "license_id", "notices", "digest").collect()
    found = {r.doc_id: (r.license_id, r.notices) for r in rows}
    for k, name in enumerate(there):
        assert found[k][0] == names[name]
        assert found[100 + k][0] is None
    assert all(found[200 + k] == (None, i) for k, (i, _) in enumerate(licences.NOTICES))
    frame.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
        wanted = db.execute(f"select doc_id, license_id, notices, digest from ({licences.scan_sql()})").fetchall()
    assert sorted(map(tuple, rows)) == sorted(wanted)


def test_licences_of_odd_rows_and_given_tables(odd, nothing, spark):
    assert licences.scan(odd).count() == len(odd_texts())
    assert licences.scan(nothing).collect() == []
    own = spark.createDataFrame([("X", "The  Word!"), ("W", "the word"), ("E", " ")], "license_id string, text string")
    frame = spark.createDataFrame([(1, "THE WORD."), (2, "")], "doc_id int, text string")
    found = {r.doc_id: r.license_id for r in licences.scan(frame, texts=own, notices=own).collect()}
    assert found == {1: "W", 2: None}
