"""Whitening against a dense eigendecomposition, exact whole-number arithmetic and hand-made spectra."""

import math

import numpy as np
import pytest

from ringwatch.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string"


def brute(vectors, components=32):
    """Per vector: deviation and coordinates, by formulas as they stand."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-13 * values[0]).sum()))
    return n, deviations, centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, v, 0, "clash") for i, v in enumerate(vectors)], SCHEMA)


def check(spark, table, usable, components=32):
    got = whitening.whitened(table, components).collect()
    n, deviations, coordinates, explained = brute([v for _, v in usable], components)
    assert len(got) == len(usable) * coordinates.shape[1]
    by_key = {}
    for r in got:
        by_key.setdefault((r["vec_id"], r["component"]), []).append(r)
    for k in range(coordinates.shape[1]):
        ours = np.array([by_key[i, k + 1][0]["whitened"] for i, _ in usable])
        assert np.abs(ours * np.sign(ours @ coordinates[:, k]) - coordinates[:, k]).max() < 1e-8
        row = by_key[usable[0][0], k + 1][0]
        assert row["n"] == n and math.isclose(row["explained"], explained[k], rel_tol=1e-10) and row["identity_error"] < 1e-10
    assert all(int(by_key[i, 1][0]["deviation"]) == d for (i, _), d in zip(usable, deviations))
    return by_key


def test_against_a_dense_decomposition_with_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(150, 12)) * np.linspace(2, 0.2, 12)]
    usable = list(enumerate(vectors))
    odd = [None, [], [1.0] * 11 + [None], [math.nan] * 12, [math.inf] + [0.0] * 11, [1.0] * 5]
    by_key = check(spark, frame(spark, vectors).union(frame(spark, odd, 500)).repartition(3), usable)
    assert not any(i >= 500 for i, _ in by_key)


def test_repeated_rows_ties_and_null_ids_count_as_often_as_they_are_there(spark):
    rng = np.random.default_rng(6)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(30, 4))]
    table = frame(spark, vectors).union(frame(spark, vectors[:1] * 20))  # a third of the rows are one vector; ids repeat
    got = whitening.whitened(table).collect()
    assert len(got) == 50 * 4 and {r["n"] for r in got} == {50}
    null_id = spark.createDataFrame([(None, v, 0, "") for v in vectors], SCHEMA)
    assert whitening.whitened(null_id).filter("vec_id IS NULL").count() == 30 * 4


def test_fewer_directions_than_dimensions(spark):
    rng = np.random.default_rng(7)
    vectors = [[4.0 * a, 4.0 * b, 4.0 * (a + b), 1.0] for a, b in rng.integers(-9, 9, size=(60, 2)).tolist()]
    check(spark, frame(spark, vectors), list(enumerate(vectors)))
    assert {r["component"] for r in whitening.whitened(frame(spark, vectors)).collect()} == {1, 2}
    assert whitening.whitened(frame(spark, [[0.5, 0.25]] * 9)).count() == 0  # equal vectors span nothing
    assert whitening.whitened(frame(spark, [[0.5, 0.25]])).count() == 0
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deviation_beyond_a_long_is_exact(spark):
    vectors = [[1e7 * i, -3e6 * i * i, 0.015625 * i] for i in range(40)]
    x = [[math.floor(64 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    wanted = [sum((40 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert max(wanted) > 2 ** 63
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whitened(frame(spark, vectors)).collect()}
    assert [got[i] for i in range(40)] == wanted
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(frame(spark, [[1e30], [1.0]])).count()


@pytest.mark.parametrize("dim, wanted, spectrum", [
    (400, 20, lambda d: 1 / (1 + np.arange(d))),            # far larger than the subspace, so corrections have to do it
    (300, 8, lambda d: np.concatenate([np.full(12, 5.0), np.linspace(1, 0.1, d - 12)])),  # one value many times over
    (300, 10, lambda d: 1 - np.arange(d) * 1e-3),           # hardly any gaps
    (200, 32, lambda d: np.where(np.arange(d) < 5, 1.0, 1e-20))])
def test_eigenpairs_of_hard_spectra(dim, wanted, spectrum):
    values = np.sort(spectrum(dim))[::-1]
    turn, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(dim, dim)))
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenpairs(lambda block: matrix @ block, dim, wanted, values.sum())
    expected = values[:wanted][values[:wanted] > 1e-13 * values[0]]
    assert len(found) == len(expected) and np.abs(found - expected).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
