import random

import numpy as np
import pytest

from tabwright.operators import quantiles as Q


@pytest.mark.parametrize("by", [None, "g"])
def test_quantiles_against_brute_force(spark, monkeypatch, by):
    """A rough sketch, so that ranks have to be found within it; ties, nulls, a constant column, one without values, and small groups."""
    monkeypatch.setattr(Q, "ACCURACY", 200)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.gauss(0, 1) if rng.random() < 0.9 else None, rng.randint(0, 5), 7.0, None) for _ in range(5000)] + [("c", 1.5, 2, 7.0, None)]
    df = spark.createDataFrame(rows, "g string, `x 1` double, i int, k double, none double")
    qs = [0.0, 0.003, 0.25, 0.5, 0.5001, 0.999, 1.0]
    got = {(r["_by"], r["feature"], r["q"]): r["value"] for r in Q.quantile_rows(df, {c: qs for c in df.columns[1:]}, by).collect()}
    want = {}
    for g in {r[0] for r in rows} if by else {0}:
        for j, c in enumerate(df.columns[1:], 1):
            values = [r[j] for r in rows if r[j] is not None and (not by or r[0] == g)]
            want |= {(g, c, q): np.quantile(values, q) for q in qs if values}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert Q.quantiles(df, {"x": [0.5, 0.9]}) == {"x": [None, None]} and Q.quantiles(df, {}) == {}
    assert Q.quantile_rows(df, {"x": [0.5]}, "g").count() == 0
