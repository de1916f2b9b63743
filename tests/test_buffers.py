import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import buffers as B
from tabwright.operators import geo
from tabwright.operators import polygons as P
from tests_support import ring_edges

CIRCLE = 32 * math.sin(2 * math.pi / 64)


def away(points, pieces):
    a, b = pieces[:, :2], pieces[:, 2:]
    d = b - a
    t = np.clip(((points[:, None] - a) * d).sum(2) / np.maximum((d**2).sum(1), 1e-300), 0, 1)
    return np.hypot(*np.moveaxis(points[:, None] - a - t[..., None] * d, 2, 0)).min(1)


def check(rings, pieces, inside, radius, seed=0):
    """Points surely nearer or farther than the radius are inside or outside; a circle of 64 corners leaves a small doubt."""
    lo, hi = pieces.reshape(-1, 2).min(0) - 2 * radius, pieces.reshape(-1, 2).max(0) + 2 * radius
    points = np.random.default_rng(seed).uniform(lo, hi, (3000, 2))
    d = np.where(inside(points), 0, away(points, pieces))
    where = P.locate(points, ring_edges(rings), 0)
    assert (where[d < radius * math.cos(math.pi / 64) * (1 - 1e-9)] > 0).all() and (where[d > radius * (1 + 1e-9)] < 0).all()


LINES = {
    "straight": [(0, 0), (10, 0)], "slanted": [(0, 0), (3, 4)], "bent": [(0, 0), (10, 0), (10, 10)], "back": [(0, 0), (10, 0), (2, 0.5), (9, 3)], "crossing": [(0, 0), (10, 10), (10, 0), (0, 10)],
    "loop": [(0, 0), (12, 0), (12, 12), (0, 12), (0, 0)], "point": [(2, 3)], "twice": [(1, 1), (1, 1), (4, 1)], "zigzag": [(i, (i * 7) % 5) for i in range(15)],
}


@pytest.mark.parametrize("name", LINES)
def test_lines_by_distance(name):
    line = np.array(LINES[name], float)
    rings = B.buffer_of([line], 1.5, False)
    pieces = np.hstack([line[:-1], line[1:]]) if len(line) > 1 else np.hstack([line, line])
    check(rings, pieces, lambda p: np.zeros(len(p), bool), 1.5)
    assert len(rings) == {"loop": 2, "crossing": 2}.get(name, len(rings)) and B._signed(rings[0][:-1]) > 0


def test_areas():
    area = lambda rings: sum(B._signed(r[:-1]) for r in rings)
    assert area(B.buffer_of([np.array([(2.0, 3.0)])], 2.0, False)) == pytest.approx(4 * CIRCLE)
    assert area(B.buffer_of([np.array([(0.0, 0.0), (10.0, 0.0)])], 2.0, False)) == pytest.approx(4 * CIRCLE + 40)
    square = np.array([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], float)
    assert area(B.buffer_of([square], 1.0, True)) == pytest.approx(100 + 40 + CIRCLE)
    assert area(B.buffer_of([square[::-1]], 1.0, True)) == pytest.approx(100 + 40 + CIRCLE)
    hole = np.array([(2, 2), (2, 8), (8, 8), (8, 2), (2, 2)], float)
    assert area(B.buffer_of([square, hole], 1.0, True)) == pytest.approx(100 + 40 + CIRCLE - 16)
    assert len(B.buffer_of([square, hole], 3.5, True)) == 1


@pytest.mark.parametrize("seed", range(4))
def test_polygons_by_distance(seed):
    rng = np.random.default_rng(seed)
    angle = np.sort(rng.uniform(0, 2 * math.pi, 9))
    star = np.stack([np.cos(angle), np.sin(angle)], 1) * rng.uniform(3, 12, (9, 1))
    rings = [np.concatenate([star, star[:1]])] + ([np.concatenate([star, star[:1]]) * 0.3] if seed % 2 else [])
    pieces = ring_edges(rings)
    check(B.buffer_of(rings, 0.7, True), pieces, lambda p: P.locate(p, pieces, 0) >= 0, 0.7, seed)


def test_buffers_of_a_table(spark):
    df = spark.createDataFrame([(1, [(3.0, 4.0)]), (2, None), (3, [])], "id int, line array<struct<x:double,y:double>>")
    rows = {r.id: r for r in B.buffer(df, "line", 2.0, False).withColumn("ring", geo.buffer_ring(F.lit(3.0), F.lit(4.0), 2.0)).collect()}
    assert rows[2].buffer is None and rows[3].buffer is None
    sort = lambda r: sorted((round(p.x, 9), round(p.y, 9)) for p in r[:-1])
    assert sort(rows[1].buffer[0]) == sort(rows[1].ring)


@pytest.mark.parametrize("turn", [0.0, 0.3])
def test_convex_shapes_without_an_outline(spark, turn):
    """Convex shapes and segments have the outline's buffer, but are not outlined one by one."""
    c, s = math.cos(turn), math.sin(turn)
    shapes = [[(0, 0), (4, 0), (4, 3), (0, 3)], [(0, 3), (4, 3), (4, 0), (0, 0)], [(0, 0), (2, 0), (4, 0), (4, 3)], [(1, 1), (7, 2), (5, 6), (2, 5), (1, 3)], [(0, 0), (5, 0), (1, 1), (0, 5)]]
    rings = [[(c * x - s * y + 50, s * x + c * y) for x, y in [*p, p[0]]] for p in shapes]
    assert [B._corners(np.array(r)) is None for r in rings] == [False] * 4 + [True]
    area = lambda found: sum(B._signed(np.array(r)[:-1]) for r in found)
    rows = [(i, [r], r[:2]) for i, r in enumerate(rings)]
    df = spark.createDataFrame(rows, f"id int, polygon {P.POLYGON}, side array<struct<x:double,y:double>>")
    got = {r.id: r for r in B.buffer(B.buffer(df, "polygon", 1.5, True, "a"), "side", 1.5, False, "b").collect()}
    for i, r in enumerate(rings):
        line = np.array(r[:2])
        assert area([[(p.x, p.y) for p in x] for x in got[i].a]) == pytest.approx(area(B.buffer_of([np.array(r)], 1.5, True)))
        assert area([[(p.x, p.y) for p in x] for x in got[i].b]) == pytest.approx(area(B.buffer_of([line], 1.5, False)))
        (ring,) = [np.array([(p.x, p.y) for p in x]) for x in got[i].b]
        check([ring], np.hstack([line[:-1], line[1:]]), lambda p: np.zeros(len(p), bool), 1.5)
