"""The qd solver and the whitening of embeddings against dense linear algebra."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import whitening
from wattline.llm.whitening import bidiagonal, leading, squared_singular_values, whitened

RNG = np.random.default_rng(7)
Q = np.linalg.qr(RNG.normal(size=(24, 24)))[0]
MATRICES = {
    "plain": RNG.normal(size=(300, 24)),
    "graded": RNG.normal(size=(300, 24)) * 2.0 ** -np.arange(24),
    "few rows": RNG.normal(size=(7, 24)),
    "repeated columns": np.repeat(RNG.normal(size=(30, 6)), 4, axis=1),
    "equal values": Q @ np.diag([5.0] * 5 + [3.0] * 9 + [1.0] * 10) @ np.linalg.qr(RNG.normal(size=(24, 24)))[0],
    "identity": np.eye(24),
    "one column": np.arange(9.0).reshape(-1, 1),
    "zero columns": np.pad(RNG.normal(size=(50, 5)), ((0, 0), (3, 4))),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver(name):
    m = MATRICES[name]
    n = m.shape[1]
    r = np.linalg.qr(m, mode="r")
    r = np.concatenate([r, np.zeros((n - len(r), n))]) if len(r) < n else r
    a, b, v = bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(n), atol=1e-13)
    wanted = np.zeros(n)
    exact = np.linalg.svd(m, compute_uv=False)
    wanted[: len(exact)] = exact**2
    assert np.abs(squared_singular_values(a, b) - wanted).max() <= 1e-13 * wanted[0]
    values, vectors = leading(r, 8)
    assert len(values) == min(8, np.linalg.matrix_rank(m))
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() <= 1e-12 * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-10


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal matrix, whose values a dense solver of the squared matrix loses."""
    a, b = 10.0 ** -np.arange(0, 20, 2.0), 0.5 * 10.0 ** -np.arange(1, 19, 2.0)
    found = np.sqrt(squared_singular_values(a, b))
    assert abs(math.fsum(np.log(found)) - math.fsum(np.log(a))) < 1e-12


def by_hand(rows, components=8):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((x * n - sums) ** 2).sum(axis=1).tolist()
    centred = ((x * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    share = values / np.trace(centred.T @ centred / n)
    return [i for i, _ in rows], deviation, centred @ vectors / np.sqrt(values), share


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MEET", 1)
    monkeypatch.setattr(whitening, "BLOCK", 4096)
    rng = np.random.default_rng(3)
    made = (rng.normal(size=(700, 12)) * np.linspace(1, 0.1, 12) + 0.3).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    rows += [(5, rows[5][1]), (None, rows[6][1])]
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] + [0.0] * 11), (904, [float("inf")] + [0.0] * 11), (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(7).withColumn("component", F.lit("x")).withColumn("n", F.lit(1))
    found = whitened(df).collect()
    numbers, deviation, values, share = by_hand(rows)
    assert len(found) == 8 * len(numbers)
    key = {}
    for row, (number, dev) in enumerate(zip(numbers, deviation, strict=True)):
        key.setdefault((number, dev), []).append(row)
    signs = {}
    for r in found:
        row = key[r.vec_id, r.deviation][0]
        wanted = values[row, r.component - 1]
        if r.component not in signs and abs(wanted) > 0.1:
            signs[r.component] = np.sign(wanted * r.whitened)
    for r in found:
        wanted = values[key[r.vec_id, r.deviation][0], r.component - 1] * signs[r.component]
        assert abs(r.whitened - wanted) < 1e-9 and r.n == len(numbers)
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[0.5, 0.5]] * 40])
def test_without_variance_there_are_no_rows(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert whitened(df).count() == 0


def test_wide_entries_and_few_directions(spark):
    vectors = [[1e6 * (i % 5), 2e6 * (i % 5), 0.0] for i in range(50)] + [[1e300, 0.0, 0.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors[:50])], "vec_id long, embedding array<double>")
    found = whitened(df).collect()
    assert len(found) == 50 and {r.component for r in found} == {1}
    assert max(abs(r.explained - 1) for r in found) < 1e-9
    rows = whitened(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    assert len({r.vec_id for r in rows}) == 51 and all(r.deviation is None for r in rows)
