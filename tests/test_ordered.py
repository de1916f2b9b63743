"""Operators over ordered values, against brute force, with ranges and blocks small enough for several of each."""

import math
import random

import numpy as np
import pytest

from tabwright.operators import clusters, stats


@pytest.mark.parametrize("cells,parts", [(100_000, 64), (40, 64), (10, 3)])
@pytest.mark.parametrize("kind", ["ties", "hot", "none equal"])
def test_kendall_against_all_pairs(spark, cells, parts, kind):
    rng = random.Random(3)
    draw = {"ties": lambda: (rng.randint(0, 9), rng.randint(0, 9)), "hot": lambda: (rng.choice([0, 0, rng.gauss(0, 1)]), rng.gauss(0, 1)), "none equal": lambda: (x := rng.random(), x * 0.5 + rng.random())}[kind]
    rows = [draw() for _ in range(300)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rows] + [(None, 1.0), (2.0, None)], "a double, b double")
    sign = lambda x: (x > 0) - (x < 0)
    pairs = [(sign(c - a), sign(d - b)) for i, (a, b) in enumerate(rows) for c, d in rows[:i]]
    want = sum(x * y for x, y in pairs) / math.sqrt(sum(x != 0 for x, _ in pairs) * sum(y != 0 for _, y in pairs))
    assert stats.kendall(df, "a", "b", cells, parts) == pytest.approx(want, abs=1e-12)
    assert stats.correlation_pairs(df, ["a", "b"], lambda d, a, b: stats.kendall(d, a, b)).first()["r"] == pytest.approx(want)


def test_kendall_of_constants_and_nothing(spark):
    assert stats.kendall(spark.createDataFrame([], "a double, b double"), "a", "b") is None
    assert stats.kendall(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double"), "a", "b") is None


def test_running_totals_in_ranges(spark):
    rows = [(float(v), v % 3 + 1) for v in random.Random(1).sample(range(1000), 300)]
    got = {r["v"]: r["_upto"] for r in stats.running_totals(spark.createDataFrame(rows, "v double, n bigint"), "v", "n", 50).collect()}
    rows.sort()
    assert got == dict(zip((v for v, _ in rows), np.cumsum([n for _, n in rows]).tolist()))


@pytest.mark.parametrize("held", [10_000, 50])
def test_silhouette_against_all_distances(spark, held):
    rng = np.random.default_rng(0)
    k = rng.integers(0, 3, 200)
    p = rng.standard_normal((200, 2)) + k[:, None]
    p[:30] = p[0]
    k = np.r_[k, 3]  # alone in its cluster
    p = np.r_[p, [[5.0, 5.0]]]
    df = spark.createDataFrame([(i, "abcd"[c], *map(float, x)) for i, (c, x) in enumerate(zip(k, p))], "i int, c string, x double, y double")
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    score = []
    for i in range(len(p)):
        own, others = (k == k[i]).sum(), [d[i, k == c].mean() for c in range(4) if c != k[i]]
        a = d[i, k == k[i]].sum() / (own - 1) if own > 1 else None
        score.append((min(others) - a) / max(min(others), a) if a is not None else 0.0)
    assert clusters.silhouette(df, "c", ["x", "y"], "i", held_rows=held).first()[0] == pytest.approx(np.mean(score), abs=1e-9)
    assert -1 <= clusters.squared_silhouette(df, "c", ["x", "y"]) <= 1


def test_silhouette_leaves_far_clusters_out_and_rows_without_values(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(60, 3)) + 100 * i for i in range(6)] + [np.full((1, 3), -50.0)])
    k = np.r_[np.repeat(np.arange(6), 60), 6]
    sizes = np.bincount(k).astype(float)
    centres = np.stack([x[k == c].mean(0) for c in range(7)])
    spread = np.array([((x[k == c] - centres[c]) ** 2).sum(1).mean() for c in range(7)])
    held = clusters._Held(k, x, centres, spread, sizes)
    assert held.needs.sum(1).max() <= 3 and not held.needs[-1, 6]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    means = np.stack([d[:, k == c].sum(1) / (sizes[c] - (k == c)).clip(1) for c in range(7)], 1)
    a = means[np.arange(len(k)), k]
    means[np.arange(len(k)), k] = np.inf
    b = means.min(1)
    want = np.where(sizes[k] > 1, (b - a) / np.maximum(a, b), 0).mean()
    rows = [(i, f"c{c}", *map(float, p)) for i, (c, p) in enumerate(zip(k.tolist(), x))] + [(900, None, 1.0, 1.0, 1.0), (901, "c1", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "i int, c string, x double, y double, z double").repartition(5)
    for held_rows in (1000, 50):
        assert clusters.silhouette(df, "c", ["x", "y", "z"], "i", held_rows=held_rows).first()[0] == pytest.approx(want, abs=1e-9)


def test_silhouette_of_copies_compares_different_rows_only(spark, monkeypatch):
    """Copies count as often as they come, but are compared once; points far from zero keep their digits."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 2)) * 1e-3 + np.repeat(np.arange(3), 30)[:, None] * 0.01 + 1e4
    k, times = np.repeat(np.arange(3), 30), rng.integers(1, 9, 90)
    rows = [(f"c{c}", *map(float, p)) for c, p, n in zip(k, x, times) for _ in range(n)]
    d, w = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), times.astype(float)
    sizes = np.bincount(k, w)
    means = np.stack([d[:, k == c] @ w[k == c] / (sizes[c] - (k == c)) for c in range(3)], 1)
    a = means[np.arange(90), k]
    means[np.arange(90), k] = np.inf
    b = means.min(1)
    seen = []
    made = clusters._Held.__init__
    monkeypatch.setattr(clusters._Held, "__init__", lambda self, k, *a: seen.append(len(k)) or made(self, k, *a))
    df = spark.createDataFrame(rows, "c string, x double, y double").repartition(4)
    assert clusters.silhouette(df, "c", ["x", "y"], "i").first()[0] == pytest.approx(((b - a) / np.maximum(a, b)) @ w / w.sum(), abs=1e-9)
    assert sum(seen) == 90


def test_distance_sums_of_close_and_far_points():
    rng = np.random.default_rng(4)
    a, b, w = rng.normal(size=(700, 64)), rng.normal(size=(300, 64)), rng.integers(1, 5, 300).astype(float)
    b[:50], b[50:60] = a[:50], a[50:60] + 1e-7
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)) @ w
    assert clusters.distance_sums(a, b, w) == pytest.approx(want, rel=1e-12)
