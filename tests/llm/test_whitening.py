import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqflow.llm import queries, whitening

from .conftest import SF


def brute(vectors, most=8):
    """n, exact deviations, eigenvalues, components and whitened rows by a dense eigen decomposition."""
    dims = max(map(len, vectors))
    x = [[math.floor(1024.0 * c) + whitening.SHIFT for c in v] + [whitening.SHIFT] * (dims - len(v)) for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    keep = [i for i in range(dims)[::-1] if values[i] > 1e-12 * values.sum()][:most]
    return n, deviations, values[keep], values.sum(), centred @ parts[:, keep] / np.sqrt(values[keep])


def holds(rows, ids, vectors, most=8):
    n, deviations, values, total, whitened = brute(vectors, most)
    assert len(rows) == len(vectors) * len(values)
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for j in range(len(values)):
        got = [r for i in dict.fromkeys(ids) for r in sorted(by[(i, j + 1)], key=lambda r: r.deviation)]
        want = [(d, w) for i in dict.fromkeys(ids) for d, w in sorted((deviations[k], whitened[k, j]) for k in range(n) if ids[k] == i)]
        assert [int(r.deviation) for r in got] == [d for d, _ in want]
        assert all(r.n == n and abs(r.explained - values[j] / total) < 1e-10 and r.identity_error < 1e-9 for r in got)
        a, b = np.array([r.whitened for r in got]), np.array([w for _, w in want])
        assert min(abs(a - b).max(), abs(a + b).max()) < 1e-6
    return values


def test_registered_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    done = queries.queries()["op13_embedding_whitening"](spark, SF)
    assert [t for _, t in done.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert len(holds(done.collect(), [r.vec_id for r in table], [r.embedding for r in table])) == 8


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=5).tolist()) for i in range(30)] + [(7, [0.5, 0.25]), (7, [0.5, 0.25]), (8, []), (None, [1.0] * 5), (9, [1e5, 0.0])]
    bad = [(40, None), (41, [1.0, None]), (42, [float("nan")]), (43, [float("-inf"), 1.0]), (None, None), (44, [1e300] * 5)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("id", "n", "component", "whitened", "ids", "data")})
    rows = whitening.whiten(df).collect()
    assert len(holds(rows, [i for i, _ in good], [v for _, v in good])) == 5


@pytest.mark.parametrize("vectors", [
    np.repeat(np.eye(12), 3, 0),  # one eigenvalue eleven times over
    np.vstack([np.full((200, 6), 0.3), np.random.default_rng(2).normal(size=(100, 6))]),  # two thirds are copies
    np.random.default_rng(3).normal(size=(4, 30)),  # fewer rows than dimensions
    np.outer(np.arange(50), [1.0, 0.0, 0.0])])
def test_spaces_that_end_early(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df, most=3).collect()
    n, deviations, values, total, _ = brute(vectors.tolist(), 3)
    assert len(rows) == n * len(values) and {int(r.deviation) for r in rows} == set(deviations)
    w = np.array([[r.whitened for r in sorted(rows, key=lambda r: r.vec_id) if r.component == c + 1] for c in range(len(values))])
    assert np.abs(w @ w.T / n - np.eye(len(values))).max() < 1e-9 and max(r.identity_error for r in rows) < 1e-9
    assert np.allclose(sorted({r.explained for r in rows}), sorted(set(values / total)), rtol=1e-9, atol=0) or len(set(values.round(6))) < len(values)


class Dense:
    def __init__(self, x):
        self.x, (self.n, self.dims), self.calls = x - x.mean(axis=0), x.shape, 0

    def __call__(self, y):
        self.calls += 1
        u = self.x @ y
        return self.x.T @ u, u @ u, np.vdot(self.x, self.x)


def test_bidiagonalisation_stops_when_the_components_stand():
    rng = np.random.default_rng(4)
    x = Dense(rng.normal(size=(4000, 64)) * np.geomspace(1000, 1, 64))
    components, variance, total = whitening.principal(x, 8)
    values, parts = np.linalg.eigh(x.x.T @ x.x / x.n)
    assert x.calls < 40 and np.allclose(variance, values[::-1][:8], rtol=1e-12) and np.isclose(total, values.sum(), rtol=1e-12)
    assert np.abs(np.abs((components * parts[:, ::-1][:, :8]).sum(axis=0)) - 1).max() < 1e-12


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    alike = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], "vec_id long, embedding array<double>")
    nulls = spark.createDataFrame([(1, None), (2, [None])], "vec_id long, embedding array<double>")
    for df in (empty, alike, nulls):
        assert whitening.whiten(df).count() == 0


def test_deviations_beyond_a_long(spark):
    big = [(i, [2000000.0 * (i % 2), float(i)]) for i in range(1000)]
    rows = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert {int(r.deviation) for r in rows} == set(brute([v for _, v in big])[1])
