import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import models, svd


def sparse(n, d, share, seed):
    rng = np.random.default_rng(seed)
    return np.where(rng.random((n, d)) < share, rng.normal(size=(n, d)) * np.linspace(1, 4, d), 0)


@pytest.mark.parametrize("n,d,share,k", [(300, 40, 0.1, 5), (50, 8, 0.5, 8), (200, 60, 0.02, 3), (5, 30, 0.4, 10)])
def test_against_numpy(spark, n, d, share, k):
    x = sparse(n, d, share, n)
    rows = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(x)] + [(n, [], [])]
    df = spark.createDataFrame(rows, "id int, indices array<int>, values array<double>").repartition(4)
    values, vectors = svd.fit(df, d, k)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    want = s[: min(k, int((s > 1e-6 * s[0]).sum()))]
    assert values == pytest.approx(want, rel=1e-6)
    for i in range(len(values)):
        if all(abs(want[i] - want[j]) > 1e-2 * want[0] for j in range(len(want)) if j != i) and (i + 1 < len(want) or len(s) == len(want)):
            assert abs(vectors[:, i] @ vt[i]) == pytest.approx(1, abs=1e-4)
    got = {r.id: r.components for r in svd.project(df, vectors, F.struct("indices", "values")).collect()}
    assert np.allclose([got[i] for i in range(n)], x @ vectors) and not any(got[n])


def test_columns_and_embedding(spark):
    x = sparse(200, 6, 0.3, 3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"c{j} double" for j in range(6)))
    cols = [f"c{j}" for j in range(6)]
    found, values, share = svd.truncated_svd(df, cols, 3)
    want = np.linalg.svd(x)[1]
    assert values == pytest.approx(want[:3]) and 0 < share < 1
    out, explained = models.embed(df, {"s": {"columns_to_embed": cols, "model": {"class": "sklearn.decomposition.TruncatedSVD", "kwargs": {"n_components": 2}}}}, "id")
    scaled = (x - x.mean(0)) / x.std(0)
    s = np.linalg.svd(scaled)[1]
    assert out.columns[-2:] == ["component_0_s", "component_1_s"] and explained["s"] == pytest.approx((s[:2] ** 2).sum() / (s**2).sum(), abs=1e-3)


def test_nothing_but_zeros_and_missing_values(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "a double, b double")
    found, values, share = svd.truncated_svd(df, ["a", "b"], 2)
    assert len(values) == 0 and share is None and [r.components for r in found.collect()] == [[], []]
    with pytest.raises(Exception, match="missing"):
        svd.truncated_svd(spark.createDataFrame([(None, 1.0)], "a double, b double"), ["a", "b"], 1)
