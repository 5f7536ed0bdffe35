from __future__ import annotations

import numpy as np
import pytest

from tidegauge.llm import queries, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
NAN = float("nan")


def by_numpy(vectors, components=16):
    """x, n, deviations, whitened rows (up to the sign) and shares of the variance."""
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    deviations = [int(((n * v - sums) ** 2).sum()) for v in x]
    mean = (sums / n).astype(np.float64)
    centred = fit.astype(np.float64) - mean
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    rows = (x.astype(np.float64) - mean) @ axes[:, :components]
    return n, deviations, rows, values, values / values.sum()


def test_query_equals_numpy(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, rows, values, shares = by_numpy([r.embedding for r in given])
    result = queries.queries()["op13_whitening"](spark, sf_dir)
    assert result.columns == COLUMNS
    found = result.orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in found] == [(g.vec_id, c) for g in given for c in range(1, 17)]
    assert {r.n for r in found} == {n}
    assert [r.deviation for r in found[::16]] == deviations
    whitened = np.array([r.whitened for r in found]).reshape(-1, 16)
    wanted = rows / np.sqrt(values[:16])
    assert np.allclose(whitened * np.sign((whitened * wanted).sum(axis=0)), wanted, atol=1e-8)
    assert np.allclose([r.explained for r in found[:16]], shares[:16], rtol=1e-9)
    assert {r.identity_error < 1e-9 for r in found} == {True}


def test_blocks_and_hot_vectors(spark, monkeypatch):
    """Blocks of a few rows, and copies of a vector that are joined in pieces."""
    monkeypatch.setattr(whitening, "HOT_ROWS", 10)
    pick = np.random.default_rng(3)
    vectors = [pick.normal(size=3).tolist() for _ in range(90)] + [[0.5, -0.25, 2.0]] * 70
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>").repartition(4)
    found = whitening.whiten(df, components=2, block_rows=16).orderBy("vec_id", "component").collect()
    n, deviations, rows, values, shares = by_numpy(vectors, 2)
    assert n == 91
    assert len(found) == 320
    assert [r.deviation for r in found[::2]] == deviations
    whitened = np.array([r.whitened for r in found]).reshape(-1, 2)
    wanted = rows / np.sqrt(values[:2])
    assert np.allclose(whitened * np.sign((whitened * wanted).sum(axis=0)), wanted, atol=1e-9)


def test_rows_that_take_no_part(spark):
    vectors = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.5]), (2, [0.0, 0.5]), (3, None), (4, []),
        (5, [1.0, None]), (6, [NAN, 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").selectExpr("*", "'k' as x", "1 as piece")
    found = whitening.whiten(df).collect()
    assert sorted(((r.vec_id, r.component) for r in found), key=str) == sorted(
        [(1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (None, 1), (None, 2)], key=str
    )
    assert {r.n for r in found} == {3}
    assert {r.identity_error < 1e-9 for r in found} == {True}


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_varies(spark, vectors):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id int, embedding array<double>")
    found = whitening.whiten(df).collect()
    assert len(found) == 2 * len(vectors)
    assert {tuple(r[2:]) for r in found} == {(1, 0, None, None, None)}


def test_fewer_vectors_than_components(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0])], "vec_id int, embedding array<double>")
    found = sorted(whitening.whiten(df).collect())
    assert [abs(r.whitened) if r.whitened else None for r in found] == pytest.approx([1, None, None] * 2)


def test_deviations_of_far_entries(spark):
    vectors = [[1e9, -1e9], [2e9, 5.0], [-3e9, 1e9]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    found = whitening.whiten(df, components=1).orderBy("vec_id").collect()
    wanted = by_numpy(vectors)[1]
    assert [r.deviation for r in found] == [d if d < 2**63 else None for d in wanted]
    # Entries beyond 2**46 are held there, and nothing overflows.
    df = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id int, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(df).orderBy("vec_id").collect()] == [None, None, 0]


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(df).collect() == []
    assert whitening.whiten(df).columns == COLUMNS
    assert whitening.whiten(df.where("vec_id = 0")).collect() == []
