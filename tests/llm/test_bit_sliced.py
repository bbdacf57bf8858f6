import numpy as np
import pytest
from pyspark.sql import functions as F

from dqflow.llm import bit_sliced, queries

from .conftest import SF


def brute(rows, k, is_query):
    """Every vector against every other, in whole numbers."""
    kept = [(r, i, [int(np.floor(1024.0 * x)) for x in v]) for r, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [x for x in kept if sum(float(s) ** 2 for s in x[2]) < 2.0 ** 62]
    out = []
    for r, i, v in kept:
        if i is None or not is_query(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j, s) for s, j, w in kept if s != r]
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, n, x[2], -x[0]) for n, x in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(df, k, step=100):
    return sorted((tuple(r) for r in bit_sliced.top_k(df, k, F.col("vec_id") % step == 0).collect()), key=str)


def test_registered_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = sorted((tuple(r) for r in queries.queries()["op11_bit_sliced_topk"](spark, SF).collect()), key=str)
    assert got == brute(rows, 10, lambda i: i % 100 == 0) and len(got) == 50


ODD_VECTORS = [
    (0, [0.5, -0.25, 1.0]), (100, [0.5, -0.25, 1.0]), (100, [0.5, -0.25, 1.0]), (200, [0.0, 0.0, 0.0]), (300, []), (400, None), (500, [1.0, None, 0.5]),
    (600, [1.0, float("nan"), 0.5]), (700, [float("inf"), 0.0, 0.0]), (800, [3e38, 0.0, 0.0]), (None, [0.5, -0.25, 1.0]), (None, None), (900, [-100000.0, 2.0]),
    (1, [0.3, 0.3, 0.3, 0.3, 5.0]), (2, [-0.0001, 0.0001, 0.0]), (3, [1e5, -1e5, 1e5]), (-100, [0.1]), (4, [0.5, -0.25, 1.0]),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD_VECTORS, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "row", "steps", "score", "rank", "query")})
    for k in (1, 4, 100):
        assert found(df.repartition(3), k) == brute(ODD_VECTORS, k, lambda i: i % 100 == 0)


@pytest.mark.parametrize("rows,kept", [(64, 3), (100, 8), (7, 1)])
def test_copies_and_small_blocks(spark, monkeypatch, rows, kept):
    """A third of all rows are one vector; blocks are smaller than the group."""
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", rows)
    monkeypatch.setattr(bit_sliced, "KEPT", kept)
    monkeypatch.setattr(bit_sliced, "QUERIES", 2)
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=6) if i % 3 else np.full(6, 0.7)).round(3).tolist()) for i in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(2)
    block = bit_sliced.sliced(np.floor(1024 * np.array([v for _, v in data])).astype(np.int64))
    assert block[1].shape[2] == 7
    assert found(df, 10, 40) == brute(data, 10, lambda i: i % 40 == 0)


def test_selection_reads_slices_from_the_top():
    rng = np.random.default_rng(5)
    steps = rng.integers(-600, 600, (1000, 64))
    low, slices = bit_sliced.sliced(steps)
    block = bit_sliced.Block(np.arange(1000), np.arange(1000), low, slices)
    resolved = []
    exact = block.exact
    block.exact = lambda q, at: resolved.append(len(at)) or exact(q, at)
    for i in range(20):
        at, score = block.best(steps[i], i, 10)
        true = steps @ steps[i]
        assert score.tolist() == sorted(np.delete(true, i), reverse=True)[:10]
    assert max(resolved) < 500  # the slices decide; only rows near the boundary are resolved


def test_empty(spark, empty):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert found(df, 10) == []
