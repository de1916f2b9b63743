import math
import random

import numpy as np
import pytest

from tabwright.llm import neighbours
from tabwright.llm.neighbours import CONFIDENCE, DIMS, Grid, KdTree, Search, chi_square_quantile, nearest, projection

SCHEMA = "vec_id bigint, embedding array<float>, rank int, label int"


def brute(rows, k, every, width=8):
    """For each asked (id, vector) its nearest other (id, vector) pairs as (distance, id)."""
    points = {(i, tuple(np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    return {q: sorted((math.sqrt(float(((np.array(q[1]) - np.array(c[1])) ** 2).sum())), c[0]) for c in points if c != q)[:k] for q in points if q[0] % every == 0}


def odd_rows(rng):
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(i, [1.0] * 8) for i in range(600, 700)] + [(i, [0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float(i % 3)]) for i in range(700, 730)]
    return rows + [(900, None), (901, []), (902, [0.0] * 8), (903, [None] + [1.0] * 7), (904, [float("nan")] + [1.0] * 7), (905, [float("inf")] * 8), (None, [1.0] * 8), (10, rows[10][1])]


@pytest.mark.parametrize(("rows_a_cell", "block", "fit"), [(10_000, 20_000, 64), (100, 7, 64), (60, 20_000, 1)])
def test_neighbours_against_brute_force(spark, monkeypatch, rows_a_cell, block, fit):
    """One query block and several; cells fitted well, and so badly that some are searched in chunks; the shipped confidence."""
    monkeypatch.setattr(neighbours, "FIT_A_CELL", fit)
    rows = odd_rows(random.Random(4))
    got = nearest(spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA), every=10, cell_rows=rows_a_cell, query_block=block)
    found: dict[int, list] = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id, r.rank))
    want = {q[0]: x for q, x in brute(rows, 10, 10).items()}
    assert found.keys() == want.keys()
    for q, x in found.items():
        assert [r for _, _, r in x] == list(range(1, len(want[q]) + 1))
        assert [(d, i) for d, i, _ in x] == sorted((d, i) for d, i, _ in x)
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert all(d == pytest.approx(dict((i, d) for d, i in want[q]).get(c, d), abs=1e-12) for q, x in found.items() for d, c, _ in x)
    assert [i for _, i, _ in found[600]] == list(range(601, 611)) and [i for _, i, _ in found[690]] == list(range(600, 610))


def test_ids_with_several_vectors_and_lengths(spark):
    """Each vector of an id is a point of its own; other lengths are searched among themselves."""
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(40)] + [(0, [2.0] * 8), (7, [2.0] * 8), (7, [2.5] * 8), (0, [2.0] * 8)]
    short = [(i, [float(i), 1.0]) for i in range(0, 30, 5)] + [(0, [2.0, 2.0])]
    got = nearest(spark.createDataFrame([(i, v, 1, 2) for i, v in rows + short], SCHEMA), k=4, every=10, confidence=0.999999).collect()
    want = sorted((q[0], n + 1, c, d) for some, w in ((rows, 8), (short, 2)) for q, x in brute(some, 4, 10, w).items() for n, (d, c) in enumerate(x))
    assert sorted((a, b, c, round(d, 9)) for a, b, c, d in map(tuple, got)) == sorted((a, b, c, round(d, 9)) for a, b, c, d in want)


def test_few_and_no_vectors(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 2.0], 0, 0)], SCHEMA)).count() == 0
    two = nearest(spark.createDataFrame([(0, [1.0, 2.0], 0, 0), (100, [1.0, 4.0], 0, 0)], SCHEMA)).collect()
    assert sorted(map(tuple, two)) == [(0, 1, 100, 2.0), (100, 1, 0, 2.0)]


def test_tree_grid_and_quantile():
    rng = np.random.default_rng(0)
    p = rng.standard_normal((500, 4))
    tree = KdTree(p, 16)
    leaves = np.flatnonzero(tree.child == 0)
    assert sorted(tree.order.tolist()) == list(range(500)) and (tree.stop - tree.start)[leaves].max() <= 16
    for a, b, low, high in zip(tree.start, tree.stop, tree.low, tree.high):
        assert (tree.points[a:b] >= low).all() and (tree.points[a:b] <= high).all()
    at, leaf, gap = tree.within(p[:20], np.full(20, 1.0))
    every = np.array([[tree.gap(x[None], np.array([i]))[0] for i in leaves] for x in p[:20]])
    assert sorted(zip(at.tolist(), leaf.tolist())) == sorted((i, int(leaves[j])) for i, j in zip(*np.nonzero(every <= 1.0)))
    grid = Grid(p, 8, 4)
    cell = grid.cell(p)
    assert grid.cells == 8 and (p >= grid.low[grid.inner + cell]).all() and (p <= grid.high[grid.inner + cell]).all() and np.bincount(cell).min() > 50
    x = (rng.standard_normal((200_000, 8)) ** 2).sum(1)
    assert abs((x <= chi_square_quantile(0.95, 8)).mean() - 0.95) < 0.003


@pytest.mark.parametrize(("spread", "most"), [(None, 0.8), (0.3, 0.1)])
def test_the_stopping_test_spares_points(spread, most):
    """On directions without any structure the test spares some points, on clustered ones nearly all; recall at the shipped settings is 0.9 or more."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64)) if spread is None else rng.standard_normal((40, 64))[rng.integers(0, 40, 4000)] + spread * rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = projection(64, DIMS, 11)
    s = Search(KdTree(x @ r), x, np.ones(len(x), int), x[:200], x[:200] @ r, 11, chi_square_quantile(CONFIDENCE, DIMS), np.full(200, np.inf)).run()
    exact = np.argsort(((x[:200, None] - x[None]) ** 2).sum(2), 1, kind="stable")[:, :11]
    assert np.mean([len(set(a) & set(b)) / 11 for a, b in zip(s.row.tolist(), exact.tolist())]) >= 0.95
    assert s.verified <= most * 200 * len(x)
