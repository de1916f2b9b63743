"""Buffers of lines and polygons: what lies within a distance of them, as one polygon with round joins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.geo import SEGMENTS
from tabwright.operators.polygons import POLYGON

#: How near numbers count as equal, in parts of the geometry's extent.
NEAR = 1e-10


def _circle(radius: float) -> np.ndarray:
    """The corners of a point's buffer, as ``geo.buffer_ring`` has them."""
    angle = np.arange(SEGMENTS) * (2 * math.pi / SEGMENTS)
    return radius * np.stack([np.cos(angle), np.sin(angle)], 1)


def capsule(p: np.ndarray, q: np.ndarray, circle: np.ndarray) -> np.ndarray:
    """A segment's buffer: the circle moved along it. Both are convex, so that its edges are those of the circle and the way there and back, by angle."""
    if (p == q).all():
        return circle + p
    steps = np.concatenate([np.roll(circle, -1, 0) - circle, [q - p], [p - q]])
    angle = np.arctan2(steps[:, 1], steps[:, 0])
    steps = steps[np.argsort(np.where(angle > math.pi - 1e-12, -math.pi, angle), kind="stable")]
    top = lambda x: x[np.lexsort((x[:, 0], x[:, 1]))[-1]]  # noqa: E731  where the step of the least angle begins
    return top(circle) + top(np.stack([p, q])) + np.concatenate([[[0.0, 0.0]], np.cumsum(steps, 0)[:-1]])


def _edges(rings: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.hstack([r, np.roll(r, -1, 0)]) for r in rings])


def _heights(e: np.ndarray, near: float) -> np.ndarray:
    """The heights of all ends and crossings of edges."""
    ax, ay, bx, by = e.T
    dx, dy = bx - ax, by - ay
    crossings = []
    for i in range(0, len(e), 256):  # rows of pairs at a time
        a = slice(i, i + 256)
        turn = dx[a, None] * dy - dy[a, None] * dx
        fx, fy = ax - ax[a, None], ay - ay[a, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (fx * dy - fy * dx) / turn, (fx * dy[a, None] - fy * dx[a, None]) / turn
        row, col = np.nonzero((t > 0) & (t < 1) & (u > 0) & (u < 1))
        crossings.append(ay[a][row] + t[row, col] * dy[a][row])
    ys = np.unique(np.concatenate([ay, by, *crossings]))
    return ys[np.r_[True, np.diff(ys) > near]]


def outline(rings: list[np.ndarray]) -> list[np.ndarray]:
    """The closed rings around the union of counterclockwise rings (holes run clockwise): shells counterclockwise, holes clockwise, shells first.

    Between two neighbouring heights of ends and crossings no edges meet. There, from left to right, the union is where more rings have begun
    than ended; its sides, and what it begins or ends with at a height, are chained to rings."""
    e = _edges(rings)
    near = NEAR * max(np.ptp(e[:, ::2]), np.ptp(e[:, 1::2]))
    ys = _heights(e, near)
    e = e[np.abs(e[:, 3] - e[:, 1]) > near]
    ax, ay, bx, by = e.T
    low, high, down = np.minimum(ay, by), np.maximum(ay, by), np.where(by < ay, 1, -1)
    spans: list[list[tuple[float, float, float, float]]] = []  # of each slab: left and right at its low and its high end
    for y0, y1 in zip(ys, ys[1:]):
        at = np.flatnonzero((low <= (y0 + y1) / 2) & (high >= (y0 + y1) / 2))
        x = lambda y: ax[at] + (bx[at] - ax[at]) * (y - ay[at]) / (by[at] - ay[at])  # noqa: B023, E731
        x0, x1 = x(y0), x(y1)
        order = np.argsort(x0 + x1, kind="stable")
        depth, found = np.cumsum(down[at][order]), []
        begins = np.flatnonzero((depth > 0) & (np.r_[0, depth[:-1]] <= 0))
        ends = np.flatnonzero((depth <= 0) & (np.r_[0, depth[:-1]] > 0))
        for i, j in zip(order[begins], order[ends]):
            if found and abs(found[-1][1] - x0[i]) <= near and abs(found[-1][3] - x1[i]) <= near:
                found[-1] = (found[-1][0], x0[j], found[-1][2], x1[j])
            elif abs(x0[i] - x0[j]) > near or abs(x1[i] - x1[j]) > near:
                found.append((x0[i], x0[j], x1[i], x1[j]))
        spans.append(found)
    follows: dict[tuple[int, int], list[tuple[int, int]]] = {}
    marks: list[np.ndarray] = []  # the different x of each height
    for k in range(len(ys)):
        under, over = spans[k - 1] if k else [], spans[k] if k < len(spans) else []
        xs = np.unique([v for s in under for v in s[2:]] + [v for s in over for v in s[:2]])
        marks.append(xs[np.r_[True, np.diff(xs) > near]] if len(xs) else xs)
    place = lambda k, v: int(np.abs(marks[k] - v).argmin())
    for k, found in enumerate(spans):
        for l0, r0, l1, r1 in found:
            follows.setdefault((k + 1, place(k + 1, l1)), []).append((k, place(k, l0)))
            follows.setdefault((k, place(k, r0)), []).append((k + 1, place(k + 1, r1)))
    for k in range(len(ys)):
        covered = [np.zeros(max(len(marks[k]) - 1, 0), bool) for _ in range(2)]
        for c, of in enumerate((spans[k - 1] if k else [], spans[k] if k < len(spans) else [])):
            for s in of:
                covered[c][place(k, s[2 - 2 * c]) : place(k, s[3 - 2 * c])] = True
        for i in np.flatnonzero(covered[0] != covered[1]).tolist():
            a, b = ((k, i), (k, i + 1)) if covered[1][i] else ((k, i + 1), (k, i))
            follows.setdefault(a, []).append(b)
    out = []
    while follows:
        start = here = next(iter(follows))
        ring = []
        while here in follows:
            ring.append(here)
            then = follows[here].pop()
            if not follows[here]:
                del follows[here]
            here = then
            if here == start:
                break
        out.append(_straight(np.array([(marks[k][i], ys[k]) for k, i in ring]), near))
    out = [r for r in out if len(r) > 2]
    return sorted(out, key=lambda r: -_signed(r))


def _straight(ring: np.ndarray, near: float) -> np.ndarray:
    """A ring without corners on straight lines."""
    while len(ring) > 2:
        a, b = ring - np.roll(ring, 1, 0), np.roll(ring, -1, 0) - ring
        bent = np.abs(a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]) > near * (np.hypot(*a.T) + np.hypot(*b.T))
        bent[np.flatnonzero(~bent)[1:][np.diff(np.flatnonzero(~bent)) == 1]] = True  # never two neighbours at once
        if bent.all():
            break
        ring = ring[bent]
    return ring


def _signed(ring: np.ndarray) -> float:
    x, y = ring.T
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def _corners(ring: np.ndarray) -> np.ndarray | None:
    """The corners of a closed convex ring, counterclockwise and without those on straight sides; None if it isn't one."""
    own = ring[:-1]
    own = own[(own != np.roll(own, 1, 0)).any(1)]
    if len(own) < 3:
        return None
    own = own if _signed(own) > 0 else own[::-1]
    a, b = own - np.roll(own, 1, 0), np.roll(own, -1, 0) - own
    turns = np.arctan2(a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0], (a * b).sum(1))
    if (turns < -1e-12).any() or abs(turns.sum() - 2 * math.pi) > 1e-6:
        return None
    own = own[turns > 1e-12]
    return own if len(own) > 2 else None


def _convex_buffers(corners: np.ndarray, circle: np.ndarray) -> np.ndarray:
    """Closed rings of the buffers of convex shapes of equally many corners, (shapes, corners, 2), counterclockwise, or of segments, which have two.

    The circle moved around a convex shape: the edges of both, by angle, begin where the lowest corners of both meet."""
    n = len(corners)
    sides, arcs = np.roll(corners, -1, 1) - corners, np.roll(circle, -1, 0) - circle
    steps = np.concatenate([np.broadcast_to(arcs, (n, *arcs.shape)), sides], 1)
    angle = np.arctan2(steps[..., 1], steps[..., 0])
    order = np.argsort(np.where(angle < -1e-12, angle + 2 * math.pi, np.maximum(angle, 0.0)), 1, kind="stable")
    steps = np.take_along_axis(steps, order[..., None], 1)
    lowest = lambda x: x[np.lexsort((-x[:, 0], x[:, 1]))[0]]  # noqa: E731  where the step of the least angle begins, or the last of that height
    low = corners[..., 1] == corners[..., 1].min(1, keepdims=True)
    first = np.take_along_axis(corners, np.where(low, corners[..., 0], np.inf).argmin(1)[:, None, None], 1)[:, 0]
    start = first + lowest(circle)
    ring = start[:, None] + np.concatenate([np.zeros((n, 1, 2)), np.cumsum(steps, 1)[:, :-1]], 1)
    return np.concatenate([ring, ring[:, :1]], 1)


def buffer_of(rings: list[np.ndarray], radius: float, closed: bool) -> list[np.ndarray]:
    """Closed rings of the buffer of a line's points, or of a polygon's closed rings: the shell, then the holes that stay."""
    circle, parts = _circle(radius), []
    for i, ring in enumerate(rings):
        if closed:
            own = ring[:-1]
            parts.append(own if (_signed(own) > 0) == (i == 0) else own[::-1])
        parts += [capsule(p, q, circle) for p, q in zip(ring, ring[1:])] or [circle + ring[0]]
    return [np.concatenate([r, r[:1]]) for r in outline(parts)]


def _buffers(radius: float, closed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        for batch in batches:
            out, convex = [], {}
            for at, g in enumerate(batch.column("_g").to_pylist()):
                rings = [np.array([(p["x"], p["y"]) for p in r]) for r in g or [] if r]
                out.append(None)
                corners = None if len(rings) != 1 else _corners(rings[0]) if closed else rings[0] if len(rings[0]) == 2 and (rings[0][0] != rings[0][1]).any() else None
                if corners is not None:  # a convex shape needs no outline: those of the batch are done together
                    convex.setdefault(len(corners), []).append((at, corners))
                elif rings:
                    out[at] = [[{"x": x, "y": y} for x, y in r.tolist()] for r in buffer_of(rings, radius, closed)]
            for found in convex.values():
                for (at, _), ring in zip(found, _convex_buffers(np.stack([c for _, c in found]), _circle(radius)).tolist()):
                    out[at] = [[{"x": x, "y": y} for x, y in ring]]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, kind)], ["_row", "_g"])

    return run


def buffer(df: DataFrame, geometry: str, radius: float, closed: bool, out: str = "buffer") -> DataFrame:
    """``df`` with ``out``, the polygon of all that lies within ``radius`` of a line (an array of (x, y)) or, ``closed``, of a polygon.

    A point's buffer has 64 corners on the circle, the ring that ``geo.buffer_ring`` gives; a line's is that ring moved along it, so that joins and ends
    are round, and a polygon's has what lies inside as well, less holes that are wider than the buffer. No shuffle; a row at a time, whose
    work grows with the square of its corners. A null or empty geometry has a null buffer."""
    g = F.col(f"`{geometry}`").cast(POLYGON) if closed else F.array(F.col(f"`{geometry}`").cast("array<struct<x:double,y:double>>"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), g.alias("_g"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_g", T.DataType.fromDDL(POLYGON))])
    return rows.mapInArrow(_buffers(radius, closed), schema).select("_row.*", F.col("_g").alias(out))
