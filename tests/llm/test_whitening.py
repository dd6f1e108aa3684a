"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from riskloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, task long, at int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "other", 7, 1) for i, v in vectors], SCHEMA)


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def brute(vectors):
    """n, sums, eigenvalues and eigenvectors of the distinct integer vectors' covariance."""
    x = np.array(sorted({tuple(integers(v)) for v in vectors}), float)
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.mean(axis=0), values[::-1], axes[:, ::-1].T, np.trace(centred.T @ centred / len(x))


def check(spark, vectors, components=16):
    fitted, rows = whitening.whiten(frame(spark, list(enumerate(vectors))), components=components)
    n, mean, values, axes, trace = brute(vectors)
    assert fitted.n == n
    assert fitted.trace == pytest.approx(trace)
    k = len(fitted.eigenvalues)
    assert np.allclose(fitted.eigenvalues, values[:k], rtol=1e-9)
    assert fitted.identity_error < 1e-9
    found = {r["vec_id"]: r for r in rows.collect()}
    assert len(found) == len(vectors)
    for j in range(k):
        sign = np.sign(fitted.components[j] @ axes[j])
        for i, v in enumerate(vectors):
            x = integers(v)
            expected = sign * (np.array(x) - mean) @ axes[j] / math.sqrt(values[j])
            assert found[i]["whitened"][j] == pytest.approx(expected, abs=1e-6)
    sums = [sum(c) for c in zip(*{tuple(integers(v)) for v in vectors})]
    for i, v in enumerate(vectors):
        exact = sum((n * x - s) ** 2 for x, s in zip(integers(v), sums))
        assert found[i]["deviation"] == (exact if exact < 2**63 else None)
    return fitted


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 24)) * np.linspace(9, 0.5, 24) @ rng.normal(size=(24, 24))).tolist()
    vectors += [vectors[3]] * 100  # a hot vector counts once in the fit
    fitted = check(spark, vectors)
    assert len(fitted.eigenvalues) == 16


def test_badly_scaled(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(200, 5)) * [1e5, 1e4, 100, 1, 0.1]).tolist()
    assert len(check(spark, vectors).eigenvalues) == 5


def test_fewer_directions_than_dimensions(spark):
    rng = np.random.default_rng(7)
    flat = rng.integers(-9, 9, size=(60, 2))
    vectors = [[float(a), float(b), float(a + b), 3.0] for a, b in flat]
    assert len(check(spark, vectors).eigenvalues) == 2
    assert len(check(spark, [[1.0, 2.0, 3.0], [2.0, 2.0, 5.0]]).eigenvalues) == 1


def test_unusable_rows(spark):
    good = [(1, [1.0, 2.0]), (2, [2.0, 5.0]), (None, [0.0, 1.0]), (4, [1.0, 2.0])]
    bad = [(5, None), (6, []), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0])]
    fitted, rows = whitening.whiten(frame(spark, good + bad))
    found = rows.collect()
    assert fitted.n == 3
    assert sorted(str(r["vec_id"]) for r in found) == ["1", "2", "4", "None"]
    assert all(len(r["whitened"]) == 2 for r in found)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[3.0, 4.0]] * 5])
def test_nothing_to_whiten(spark, vectors):
    fitted, rows = whitening.whiten(frame(spark, list(enumerate(vectors))))
    assert len(fitted.eigenvalues) == 0
    assert [r["whitened"] for r in rows.collect()] == [[]] * len(vectors)


def test_large_numbers_stay_exact():
    x = np.array([[1 << 40, 5], [3, 1 << 41]])
    sums = np.array([10**18, 7], object)
    expected = [sum((10**7 * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 10**7, sums) == [v if v < 2**63 else None for v in expected]
    small = whitening.deviations(np.array([[5, 6]]), 3, np.array([10, 20], object))
    assert small == [(15 - 10) ** 2 + (18 - 20) ** 2]


def test_tree_of_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = spark.range(100, numPartitions=9).selectExpr("array(id, 2 * id) x")
    total = whitening.summed(rows, lambda x: x.sum(axis=0).astype(float), (2,))
    assert total.tolist() == [4950, 9900]


def test_triangular_solve():
    rng = np.random.default_rng(8)
    r = np.triu(rng.normal(size=(6, 6))) + 5 * np.eye(6)
    rows = rng.normal(size=(11, 6))
    assert np.allclose(whitening.triangular_solve(rows, r) @ r, rows)


def test_query(spark):
    found = whitening.op13(spark, "/root/testdata/sf0.001")
    assert [f.name for f in found.schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    assert len(rows) == 500 * 16
    assert {r["component"] for r in rows} == set(range(1, 17))
    assert all(r["n"] == 500 and 0 <= r["identity_error"] < 1e-4 for r in rows)
    by = {r["component"]: r["explained"] for r in rows}
    assert all(by[c] >= by[c + 1] for c in range(1, 16))
