import random

import numpy as np
import pytest

from sparkmart.llm.queries import QUERIES
from sparkmart.llm.whitening import chebyshev, whiten


def _brute(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def _compare(rows, ids, vectors, k):
    n, deviation, whitened, explained = _brute(vectors, k)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(vectors) * k and all(set(by[i]) == set(range(1, k + 1)) for i in ids)
    got = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in ids])
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * sign - whitened).max() < 1e-9
    assert all(by[i][1].deviation == d and by[i][k].n == n for i, d in zip(ids, deviation.tolist()))
    assert np.allclose([by[ids[0]][c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
    assert max(r.identity_error for r in rows) < 1e-9


def test_whole_table_against_eigh(spark):
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(folder + "/embeddings.parquet").collect()
    _compare(QUERIES["op11_embedding_whitening"](spark, folder).collect(), [r.vec_id for r in given], [r.embedding for r in given], 16)


def test_nulls_repeats_lengths_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    good = [[float(v) for v in rng.normal(size=5) * [5, 4, 3, 2, 1]] for _ in range(40)]
    rows = [(i, v, 1) for i, v in enumerate(good)]
    rows += [(100 + i, good[0], 2) for i in range(60)]  # a vector with over half of the rows counts once
    rows += [(200, None, 0), (201, [1.0, None, 0.0, 0.0, 0.0], 0), (202, [float("nan")] * 5, 0), (203, [float("-inf")] * 5, 0), (204, [1.0], 0), (205, [], 0), (206, [1e300] * 5, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").withColumnRenamed("component", "WHITENED").repartition(7)
    _compare(whiten(df).collect(), [r[0] for r in rows[:100]], [r[1] for r in rows[:100]], 5)
    twice = df.where("vec_id < 40").unionByName(df.where("vec_id < 40"))
    assert whiten(twice, wanted=2).count() == 160
    assert whiten(df.withColumn("vec_id", df.vec_id * 0).where("vec_id IS NULL OR vec_id = 0")).count() == 500
    assert whiten(df.limit(0)).count() == 0 and whiten(df.where("vec_id >= 100")).count() == 0


def test_directions_without_variance_and_large_numbers(spark):
    rng = random.Random(2)
    flat = [(i, [float(rng.randint(0, 9)), 1.0, float(rng.randint(0, 3)), 7.0]) for i in range(30)]
    rows = whiten(spark.createDataFrame(flat, "vec_id int, embedding array<float>")).collect()
    assert {r.component for r in rows} == {1, 2} and abs(sum(r.explained for r in rows[:2]) - 1) < 1e-9
    large = [(i, [2.0**45 * rng.random(), float(i)]) for i in range(9)]
    rows = whiten(spark.createDataFrame(large, "vec_id int, embedding array<double>")).collect()
    assert len(rows) == 9 and all(r.deviation is None for r in rows)  # over 64 bits; the other direction is below rounding


@pytest.mark.parametrize("seed", range(3))
def test_chebyshev_against_eigh(seed):
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    values = np.sort(rng.uniform(1, 2, 120))[::-1].copy()
    values[3:6] = values[3]  # a multiple eigenvalue
    v = basis * values @ basis.T
    found, vectors, residual = chebyshev(lambda b: v @ b, 120, 16)
    assert residual < 1e-12 and np.allclose(found, values[:16], rtol=1e-12)
    assert np.abs(v @ vectors - vectors * found).max() < 1e-10
