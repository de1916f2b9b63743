import math

import numpy as np
import pytest

from tabwright.operators.neighbour_information import digamma, neighbour_information


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(x, y, k):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        own = np.sort(np.abs(np.delete(x, i)[np.delete(y, i) == y[i]] - x[i]))
        size = len(own) + 1
        kk = min(k, size - 1)
        r = own[kk - 1]
        m = int((np.abs(x - x[i]) < r).sum()) if r > 0 else int((x == x[i]).sum())
        total += psi(kk) - psi(size) - psi(m)
    return max(0.0, psi(len(x)) + total / len(x))


@pytest.mark.parametrize("k,block,width", [(3, 50_000, 100_000), (3, 100, 300), (1, 7, 300), (5, 64, 100_000)])
def test_against_brute_force(spark, monkeypatch, k, block, width):
    from tabwright.operators import stats

    monkeypatch.setattr(stats.running_totals, "__defaults__", (width,))
    rng = np.random.default_rng(2)
    n = 2000
    y = rng.integers(0, 3, n)
    cols = {"tied": rng.integers(0, 12, n) + y, "normal": np.round(rng.normal(size=n) + y, 6), "noise": rng.normal(size=n), "constant": np.zeros(n), "hot": np.where(rng.random(n) < 0.4, 1.0, rng.normal(size=n))}
    y = np.r_[y, 7, 8, 8]  # classes of one and of two rows
    cols = {c: np.r_[v, v[:3]].astype(float) for c, v in cols.items()}
    rows = [(int(a), *map(float, v)) for a, *v in zip(y, *cols.values())] + [(None, *[1.0] * 5), (1, *[None] * 5)]
    df = spark.createDataFrame(rows, "y int, " + ", ".join(f"{c} double" for c in cols)).repartition(6)
    names = list(cols) if block != 7 else ["tied", "normal"]
    got = {r.feature: r.mi for r in neighbour_information(df, names, "y", k, block).collect()}
    assert got == pytest.approx({c: brute(cols[c], y, k) for c in names}, abs=1e-9)


def test_of_nothing(spark):
    assert neighbour_information(spark.createDataFrame([(None, "a"), (1.0, "b")], "x double, y string"), ["x"], "y").first().mi is None


def test_digamma(spark):
    from pyspark.sql import functions as F

    for r in spark.range(1, 400, 7).select("id", digamma(F.col("id")).alias("d")).collect():
        assert r.d == pytest.approx(psi(r.id), abs=1e-12)
    assert spark.range(1).select(digamma(F.lit(10**9))).first()[0] == pytest.approx(math.log(10**9) - 0.5e-9, abs=1e-12)
