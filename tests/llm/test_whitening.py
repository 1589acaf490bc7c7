"""Whitening against exact sums and products, and its small cases."""

from fractions import Fraction

import numpy as np
import pytest

from duplexa.llm.embedding_whitening import COMPONENTS, LIMIT, ROWS, add_products, centred, principal, scaled, sliced, whiten

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=COMPONENTS):
    """deviation, |whitened| and explained from whole-numbered covariances (n * n * n times V), one rounding at the end."""
    x = np.floor(1024 * np.asarray(rows, np.float64)).astype(object) + 100_000
    n = len(x)
    away = n * x - x.sum(axis=0)
    v = np.array([[float(Fraction(int(c), n**3)) for c in r] for r in away.T.dot(away)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return (away * away).sum(axis=1), np.abs((away / n).astype(np.float64) @ u / np.sqrt(e)), e / np.trace(v)


def check(got, ids, rows):
    deviation, whitened, explained = brute(rows)
    k = len(explained)
    assert got.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.sort_values(["vec_id", "component"])
    assert len(got) == len(ids) * k and (got.n == len(ids)).all()
    assert got.vec_id.tolist() == np.repeat(sorted(ids), k).tolist() and got.component.tolist() == list(range(1, k + 1)) * len(ids)
    order = np.argsort(ids)
    assert got.deviation.tolist() == np.repeat(deviation[order], k).tolist()
    assert np.allclose(np.abs(got.whitened.to_numpy().reshape(-1, k)), whitened[order], rtol=1e-9, atol=1e-9)
    assert np.allclose(got.explained[:k], explained, rtol=1e-9) and (got.identity_error < 1e-9).all()


def test_equals_brute_force_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.toPandas()
    check(whiten(table.repartition(7)).toPandas(), rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64))


@pytest.mark.parametrize("far", [0.0, 3000.0])
def test_a_far_mean_and_few_dimensions_cost_no_digits(spark, far):
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(300, 5)) * [5, 4, 3, 2, 1] + far).astype(np.float32)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], SCHEMA)
    check(whiten(frame).toPandas(), np.arange(300), rows)


def test_products_of_slices_are_exact():
    rng = np.random.default_rng(1)
    rows = scaled(rng.normal(size=(2 * ROWS + 77, 6)) * 10.0 ** rng.integers(-3, 6, 6))
    mean = [Fraction(int(c), len(rows)) for c in rows.astype(object).sum(axis=0)]
    high = np.array([float(m) for m in mean])
    low = np.array([float(m - Fraction(h)) for m, h in zip(mean, high.tolist())])
    c = centred(rows, (high, low))
    assert all(Fraction(h) + Fraction(b) == sum(Fraction(s[3, 2]) for s in sliced(c[0][:ROWS], c[1][:ROWS])) for h, b in [(c[0][3, 2], c[1][3, 2])])
    total = add_products((np.zeros((6, 6)), np.zeros((6, 6))), *c)
    away = len(rows) * rows.astype(np.int64).astype(object) - rows.astype(np.int64).astype(object).sum(axis=0)
    for i in range(6):
        for j in range(6):
            right = Fraction(int((away[:, i] * away[:, j]).sum()), len(rows) ** 2)
            scale = Fraction(total[0][i, i]) * Fraction(total[0][j, j])
            assert (Fraction(total[0][i, j]) + Fraction(total[1][i, j]) - right) ** 2 <= scale * Fraction(1, 10**54)


def test_vectors_of_near_eigenvalues_are_refined():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = np.concatenate([[1.0, 1.0 - 1e-9, 0.5], rng.uniform(0.01, 0.1, 37)])
    a = (q.astype(np.longdouble) * values) @ q.T.astype(np.longdouble)
    high = a.astype(np.float64)
    found, vectors, trace = principal(high, (a - high).astype(np.float64), 1)
    assert np.allclose(found[:3], values[:3], rtol=1e-14) and trace == pytest.approx(values.sum())
    assert np.abs(np.abs(vectors[:, :3].T @ q[:, :3]) - np.eye(3)).max() < 1e-7
    assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-14


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 0.0]), (4, [float("nan"), 0.0, 1.0]), (5, [float("inf"), 0.0, 1.0]), (6, [0.0, 0.0, 0.0])]
    rows += [(1, [1.0, 2.0, 0.5]), (None, [3.0, 1.0, 4.0]), (7, [2.0]), (8, [])]
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3.0, [1]) for r in rows], SCHEMA + ", id string, n int, component int, deviation double, vector array<int>")
    got = whiten(frame).toPandas()
    assert len(got) == 6 * 3 and (got.n == 6).all()
    assert sorted(got.vec_id.fillna(-1).astype(int).unique().tolist()) == [-1, 1, 6, 7, 8] and (got.vec_id == 1).sum() == 6
    # A vector without components is one of zeros.
    zero, empty = (got[got.vec_id == i].sort_values("component").whitened.tolist() for i in (6, 8))
    assert zero == empty and got.identity_error.max() < 1e-9


def test_without_variance(spark):
    same = whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], SCHEMA)).toPandas()
    assert len(same) == 8 and same.whitened.isna().all() and same.explained.isna().all() and same.identity_error.isna().all() and (same.deviation == 0).all()
    two = whiten(spark.createDataFrame([(1, [0.0] * 9), (2, [1.0] * 9)], SCHEMA)).toPandas()
    assert len(two) == 16 and two[two.component == 1].whitened.abs().tolist() == pytest.approx([1, 1]) and two[two.component > 1].whitened.isna().all()
    assert two.identity_error.max() < 1e-12 and two.explained.max() == pytest.approx(1)
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0 and whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [])], SCHEMA)).count() == 0


def test_huge_entries_are_held(spark):
    got = whiten(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])], SCHEMA)).toPandas()
    assert got[got.vec_id == 1].deviation.max() == LIMIT and got[got.vec_id == 3].deviation.max() == (3 * 5120 - 6144) ** 2
    assert np.isfinite(got[got.component == 1].whitened).all()
