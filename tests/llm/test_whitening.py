"""Whitening against a full eigendecomposition, and the solver on hard spectra."""

import math

import numpy as np
import pytest

from ridelake.llm import whitening

SF = "/root/testdata/sf0.001"


def plain(rows, components=4):
    usable = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = max((len(v) for _, v in usable), default=0)
    whole = {i: [math.floor(256 * x) for x in v] + [0] * (length - len(v)) for i, v in usable}
    fit = [list(x) for x in dict.fromkeys(tuple(x) for x in whole.values())]
    n = len(fit)
    total = [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[x - s / n for x, s in zip(v, total, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {i: sum((n * x - s) ** 2 for x, s in zip(v, total, strict=True)) for i, v in whole.items()}
    white = {i: (np.array([x - s / n for x, s in zip(v, total, strict=True)]) @ vectors) / np.sqrt(values) for i, v in whole.items()}
    return n, deviation, white, values / np.trace(centred.T @ centred / n)


def test_whitening_is_that_of_a_full_decomposition(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    n, deviation, white, explained = plain([(r.vec_id, r.embedding) for r in vectors.collect()])
    got = whitening.whitened(vectors).collect()
    assert len(got) == 4 * len(deviation)
    sign = {}
    for r in got:
        k = r.component - 1
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert abs(r.explained - explained[k]) <= 1e-10 and r.identity_error <= 1e-10
        assert r.residual <= 1e-11 * r.eigenvalue
        want = white[r.vec_id][k]
        if k not in sign and abs(want) > 0.1:
            sign[k] = np.sign(want) * np.sign(r.whitened)
    assert all(abs(sign[r.component - 1] * r.whitened - white[r.vec_id][r.component - 1]) < 1e-7 for r in got)


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0]),
             (104, []), (105, [0.5]), (106, [0.5, 0.0, 0.0]), (107, [-0.0] * 5), (108, [1.0] * 9)]
    return rows + rows[:7]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS n", "3 AS component")
    n, deviation, white, explained = plain(rows)
    got = whitening.whitened(df).collect()
    assert n == 43  # lengths 0, 1 and 3 are filled up; 104 equals 107, 105 equals 106
    assert {r.vec_id for r in got} == set(range(40)) | {104, 105, 106, 107, 108}
    assert len(got) == 4 * 52
    assert all(r.deviation == deviation[r.vec_id] and r.n == n for r in got)
    assert all(abs(abs(r.whitened) - abs(white[r.vec_id][r.component - 1])) < 1e-8 for r in got)
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-10 and r.identity_error < 1e-10 for r in got)


def test_few_dimensions_constants_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).count() == 0
    flat = whitening.whitened(spark.createDataFrame([(i, [float(i), 3.0]) for i in range(6)], schema)).collect()
    assert {r.component for r in flat} == {1} and abs(sum(r.whitened ** 2 for r in flat) / 6 - 1) < 1e-12
    assert all(abs(r.explained - 1) < 1e-12 for r in flat)


def test_large_and_shifted_values(spark):
    """A mean far above the spread, and entries that end at 64 bits."""
    rng = np.random.default_rng(5)
    rows = [(i, (1e9 + rng.integers(0, 9, 3) / 4).tolist()) for i in range(50)]
    n, deviation, white, _ = plain(rows, 3)
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9 for r in got)
    assert all(abs(abs(r.whitened) - abs(white[r.vec_id][r.component - 1])) < 1e-6 for r in got)
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert all(r.deviation is None and math.isfinite(r.whitened) for r in whitening.whitened(huge).filter("vec_id < 3").collect())


@pytest.mark.parametrize("values", [
    np.linspace(0, 1, 64), np.r_[np.ones(60), 1, 2, 2, 2.0], np.linspace(0.999, 1, 64), np.r_[np.zeros(62), 1e-8, 1],
    np.zeros(8), np.array([3.0]), np.array([1.0, 2, 3]), 1 / np.arange(1, 301.0) ** 2, 10.0 ** -np.arange(40)])
def test_solver_on_hard_spectra(values):
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors, errors = whitening.leading_pairs(lambda b: matrix @ b, len(values))
    want = np.sort(values)[::-1][:4]
    assert len(found) == len(want) and np.abs(found - want).max() <= 1e-12 * max(1e-300, want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() <= 1e-12 * max(1e-300, want[0])
    assert errors.max() <= 1e-12 * max(1e-300, want[0])


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    guess = np.linalg.qr(rng.normal(size=(30, 2)))[0]
    theta = np.array([g @ a @ g for g in guess.T])
    residual = a @ guess - guess * theta
    got = whitening.corrections(lambda b: a @ b, np.zeros((30, 0)), guess, theta, residual, 40)
    for k in range(2):
        p = np.eye(30) - np.outer(guess[:, k], guess[:, k])
        left = p @ (a - theta[k] * np.eye(30)) @ p @ got[:, k] + residual[:, k]
        assert np.linalg.norm(left) <= 0.02 * np.linalg.norm(residual[:, k]) and abs(guess[:, k] @ got[:, k]) < 1e-12
