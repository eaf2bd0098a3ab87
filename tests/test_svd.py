"""The iterative SVD of one-hot histories against the exact Gram matrix."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import encode as E


def frame(spark, rows, cats):
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} string" for c in cats))


def gram(rows):
    cells = sorted({(j, v is not None, v or "") for r in rows for j, v in enumerate(r[1:])})
    at = {c: i for i, c in enumerate(cells)}
    x = np.zeros((len(rows), len(cells)))
    for i, r in enumerate(rows):
        for j, v in enumerate(r[1:]):
            x[i, at[j, v is not None, v or ""]] = 1
    return x


@pytest.mark.parametrize("block_bytes,krylov", [(64 << 20, 8), (700, 4)])
def test_subspace_and_projection(spark, monkeypatch, block_bytes, krylov):
    monkeypatch.setattr(E, "LOADING_BYTES", block_bytes)
    monkeypatch.setattr(E, "KRYLOV_BLOCKS", krylov)
    rnd = random.Random(4)
    level = lambda j: None if rnd.random() < 0.1 else f"v{min(int(rnd.expovariate(0.25 + 0.1 * j)), 12)}"
    rows = [(i, *(level(j) for j in range(4))) for i in range(600)]
    x = gram(rows)
    ix, width = E.category_indices(frame(spark, rows, "abcd"), "id", list("abcd"))
    assert width == x.shape[1]
    value, v = E.leading_vectors(ix, width, 5)
    want_value, want = np.linalg.eigh(x.T @ x)
    assert np.allclose(value, want_value[::-1][:5], rtol=1e-9)
    angle = np.linalg.norm(v - want[:, ::-1][:, :5] @ (want[:, ::-1][:, :5].T @ v), 2)
    assert angle < 1e-6
    got = {r.id: np.array(r[1:]) for r in E.category_history_svd(frame(spark, rows, "abcd"), "id", list("abcd"), k=5, name="h").collect()}
    full = x @ want[:, ::-1][:, :5]
    for j in range(5):
        col = np.array([got[i][j] for i in range(600)])
        assert np.allclose(col, full[:, j], atol=1e-5) or np.allclose(col, -full[:, j], atol=1e-5)
        assert v[np.abs(v[:, j]).argmax(), j] != 0


def test_fewer_levels_than_vectors_nulls_and_empty(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, "b")]
    out = E.category_history_svd(frame(spark, rows, ["c"]), "id", ["c"], k=12, name="h").orderBy("id").collect()
    assert [round(sum(x * x for x in r[1:]), 9) for r in out] == [1, 1, 1, 1] and len(out[0]) == 4
    assert E.category_history_svd(frame(spark, [], ["c"]), "id", ["c"], k=2, name="h").count() == 0


def test_many_categories(spark):
    """A hundred thousand levels: no list of them, no matrix of their square."""
    df = spark.range(200_000).select("id", *[F.when(F.rand(j) < 0.4, F.floor(F.rand(j + 10) * 3)).otherwise(F.floor(F.rand(j + 20) * 60_000)).cast("string").alias(f"c{j}") for j in range(2)])
    ix, width = E.category_indices(df, "id", ["c0", "c1"])
    assert width > 100_000
    value, v = E.leading_vectors(ix, width, 3, tol=1e-8)
    assert v.shape == (width, 3) and (np.diff(value) <= 0).all()
    again = E._gram_times(ix, v)
    assert np.linalg.norm(again - v * value, axis=0).max() < 1e-6 * value[0]
