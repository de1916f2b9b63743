"""Nearest neighbours through low-dimensional stable projections: a kd-tree over them, and a chi-square test that ends the search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import cut, map_arrow

#: Projections (even), and points of a leaf.
DIMS, LEAF = 32, 256
#: Distinct vectors of a cell at most (about), queries of a block, and sampled vectors a cell that the top of the tree is fitted on, all of them at
#: most FIT_MOST (32 MB), or four a cell if that is more.
CELL_ROWS, QUERY_BLOCK, FIT_A_CELL, FIT_MOST = 131_072, 20_000, 64, 1 << 18
#: A true neighbour escapes the stopping test with at most one in ten.
CONFIDENCE = 0.9
_BATCH, _PAIRS = 256, 1 << 20


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi-square of ``dims`` (even) degrees of freedom <= x) = p, by bisection of the closed form."""
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))
    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(width: int, dims: int, seed: int) -> np.ndarray:
    """Gaussian, and so 2-stable: a projected squared distance over the true one is chi-square with ``dims`` degrees of freedom."""
    return np.random.default_rng(seed).standard_normal((width, dims))


class Boxes:
    """A binary tree of boxes: ``low`` and ``high`` by node, and ``child``, the first of a node's two children or 0 for a leaf."""

    low: np.ndarray
    high: np.ndarray
    child: np.ndarray

    def gap(self, p: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distances of points to the boxes of nodes, one by one."""
        out = np.maximum(np.maximum(self.low[node] - p, p - self.high[node]), 0)
        return np.einsum("ij,ij->i", out, out)

    def home(self, p: np.ndarray) -> np.ndarray:
        """The leaf of each point, by descent to the nearer child; the first one of two as near."""
        node = np.zeros(len(p), np.int64)
        while len(inner := np.flatnonzero(self.child[node])):
            first = self.child[node[inner]]
            node[inner] = first + (self.gap(p[inner], first + 1) < self.gap(p[inner], first))
        return node

    def within(self, p: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, leaf, squared gap) of all leaves within each point's limit: a descent that leaves out the nodes beyond it."""
        at, node, out = np.arange(len(p)), np.zeros(len(p), np.int64), []
        while len(at):
            gap = self.gap(p[at], node)
            near = gap <= limit[at]
            at, node, gap = at[near], node[near], gap[near]
            leaf = self.child[node] == 0
            out.append((at[leaf], node[leaf], gap[leaf]))
            at, node = np.repeat(at[~leaf], 2), (self.child[node[~leaf]][:, None] + np.arange(2)).ravel()
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (at, node, np.zeros(0))


class KdTree(Boxes):
    """Median splits of the widest dimension down to leaves. Boxes are those of the points; ``order`` holds each leaf's points side by side."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order, spans, low, high, child = np.arange(len(points)), [(0, len(points))], [], [], []
        for a, b in spans:  # grows while it is read
            own = points[self.order[a:b]]
            low.append(own.min(0))
            high.append(own.max(0))
            wide = high[-1] - low[-1]
            if b - a <= leaf or not wide.any():
                child.append(0)
                continue
            half = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, int(wide.argmax())], half)]
            child.append(len(spans))
            spans += [(a, a + half), (a + half, b)]
        self.low, self.high, self.child = np.array(low), np.array(high), np.array(child)
        self.start, self.stop = np.array(spans).T
        self.points = points[self.order]


class Grid(Boxes):
    """The top of the tree, fitted on a sample: a power of two of half-space cells, nodes in heap order, cells numbered from 0."""

    def __init__(self, points: np.ndarray, cells: int, dims: int):
        self.planes, level = [], [points]
        boxes = [(np.full(dims, -np.inf), np.full(dims, np.inf))]
        while len(self.planes) + 1 < cells:
            below = []
            for p in level:
                dim = int((p.max(0) - p.min(0)).argmax()) if len(p) else 0
                at = float(np.median(p[:, dim])) if len(p) else 0.0
                lo, hi = boxes[len(self.planes)]
                left, right = hi.copy(), lo.copy()
                left[dim], right[dim] = at, at
                boxes += [(lo, left), (right, hi)]
                self.planes.append((dim, at))
                below += [p[p[:, dim] <= at], p[p[:, dim] > at]]
            level = below
        self.inner, self.cells = len(self.planes), len(boxes) - len(self.planes)
        self.low, self.high = (np.array([b[i] for b in boxes]) for i in (0, 1))
        self.child = np.where(np.arange(len(boxes)) < self.inner, 2 * np.arange(len(boxes)) + 1, 0)

    def cell(self, p: np.ndarray) -> np.ndarray:
        return self.home(p) - self.inner

    def others(self, p: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) of the cells within each point's limit, but for its own."""
        found, own, step = [], self.cell(p), max(1, _PAIRS // self.cells)
        for a in range(0, len(p), step):
            at, node, _ = self.within(p[a : a + step], limit[a : a + step])
            found.append((at + a, node - self.inner))
        at, cell = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        away = cell != own[at]
        return at[away], cell[away]


class Search:
    """The nearest rows of ``vectors`` for a batch of queries, by the tree over their projections.

    Leaves come in the order of their projected distance, 1, 2, 4 ... at a time. A point is verified, its true distance taken, while its
    projected squared distance is at most ``stop`` times the squared distance of the k-th neighbour so far (``bound``, which may come
    from elsewhere); a query ends at the first leaf beyond. ``sizes`` says how many ids a row stands for. Of equally near rows the first
    count. ``d`` and ``row`` hold each query's k nearest, infinity and len(vectors) where there are fewer.
    """

    def __init__(self, tree: KdTree, vectors: np.ndarray, sizes: np.ndarray, q: np.ndarray, projected: np.ndarray, k: int, stop: float, bound: np.ndarray):
        self.tree, self.vectors, self.q, self.p, self.k, self.stop, self.bound = tree, vectors, q, projected, k, stop, bound.copy()
        self.sizes, self.d, self.row, self.verified = np.r_[sizes, 0], np.full((len(q), k), np.inf), np.full((len(q), k), len(vectors)), 0
        self.own = vectors[tree.order]
        self.norms, self.p_norms = (np.einsum("ij,ij->i", x, x) for x in (self.own, tree.points))
        self.q_norms, self.qp_norms = (np.einsum("ij,ij->i", x, x) for x in (q, projected))

    def _verify(self, qs: np.ndarray, leaf: int) -> None:
        for a in range(self.tree.start[leaf], self.tree.stop[leaf], LEAF):
            part = slice(a, min(a + LEAF, self.tree.stop[leaf]))
            sums = self.qp_norms[qs, None] + self.p_norms[part]
            test = sums - 2 * (self.p[qs] @ self.tree.points[part].T) <= (self.stop * self.bound[qs])[:, None] + 1e-9 * sums
            self.verified += int(test.sum())
            sums = self.q_norms[qs, None] + self.norms[part]
            i, j = np.nonzero(test & (sums - 2 * (self.q[qs] @ self.own[part].T) <= self.bound[qs, None] + 1e-9 * sums))
            for x in range(0, len(i), 1 << 14):
                at, place = qs[i[x : x + (1 << 14)]], a + j[x : x + (1 << 14)]
                diff = self.own[place] - self.q[at]
                d = np.einsum("ij,ij->i", diff, diff)
                near = d <= self.bound[at]
                if near.any():
                    self._merge(at[near], self.tree.order[place[near]], d[near])

    def _merge(self, at: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        mine = np.unique(at)
        of, d, rows = np.r_[np.repeat(mine, self.k), at], np.r_[self.d[mine].ravel(), d], np.r_[self.row[mine].ravel(), rows]
        order = np.lexsort((rows, d, of))
        of, d, rows = of[order], d[order], rows[order]
        kept = np.arange(len(of)) - np.searchsorted(of, of) < self.k
        self.d[mine], self.row[mine] = d[kept].reshape(-1, self.k), rows[kept].reshape(-1, self.k)
        held = np.cumsum(self.sizes[self.row[mine]], 1) >= self.k
        full, last = held.any(1), held.argmax(1)
        self.bound[mine[full]] = np.minimum(self.bound[mine[full]], self.d[mine[full], last[full]])

    def run(self) -> Search:
        blind, home = np.flatnonzero(np.isinf(self.bound)), np.full(len(self.q), -1)
        home[blind] = self.tree.home(self.p[blind])
        for leaf in np.unique(home[blind]).tolist():
            self._verify(np.flatnonzero(home == leaf), leaf)
        at, leaf, gap = self.tree.within(self.p, self.stop * self.bound)
        new = leaf != home[at]
        at, leaf, gap = at[new], leaf[new], gap[new]
        order = np.lexsort((gap, at))
        at, leaf, gap = at[order], leaf[order], gap[order]
        turn = np.frexp(np.arange(len(at)) - np.searchsorted(at, at) + 1.0)[1]
        for t in range(1, int(turn.max(initial=0)) + 1):
            live = np.flatnonzero((turn == t) & (gap <= self.stop * self.bound[at]))
            live = live[np.argsort(leaf[live], kind="stable")]
            for part in np.split(live, np.flatnonzero(np.diff(leaf[live])) + 1):
                part = part[gap[part] <= self.stop * self.bound[at[part]]]
                if len(part):
                    self._verify(at[part], int(leaf[part[0]]))
        return self


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


_KEY = "key struct<a:bigint,b:bigint>"


def _classes(points: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(key, ids, asked, vec): distinct vectors with their k + 1 smallest ids, and whether any id is a query's. A key is 128 bits of hash."""
    few = points.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("n") <= k + 1)
    few = few.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    return few.join(members.select("key").distinct().withColumn("asked", F.lit(True)), "key", "left").select("key", "ids", F.coalesce("asked", F.lit(False)).alias("asked"), "vec")


def _searcher(width: int, r: np.ndarray, k: int, stop: float):
    """Rows of a partition come by group, candidates before queries: a group's candidates become a tree, and its queries stream past it."""

    def found(s: Search, keys: pa.Array, own_keys: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        at, place = np.nonzero(s.row < len(ids))
        rows = pa.array(s.row[at, place])
        asked, got = keys.take(pa.array(at)), own_keys.take(rows)
        same = np.logical_and(*(np.equal(asked.field(i).to_numpy(), got.field(i).to_numpy()) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([asked, ids.take(rows), pa.array(same), pa.array(np.sqrt(s.d[at, place])), pa.array(s.bound[at])], ["key", "ids", "own", "d", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, tree = None, [], None
        for batch in batches:
            groups, asks = batch.column("g").to_numpy(), batch.column("ask").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[len(groups) > 0, (groups[1:] != groups[:-1]) | (asks[1:] != asks[:-1])])
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(groups)]):
                if groups[a] != group:
                    group, held, tree = groups[a], [], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    held.append((_matrix(part.column("vec"), width), part.column("key"), part.column("ids")))
                elif held:
                    if tree is None:
                        vectors, own_keys, ids = np.concatenate([x[0] for x in held]), *(pa.concat_arrays([x[i] for x in held]) for i in (1, 2))
                        first = np.argsort(ids.flatten().to_numpy()[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()], kind="stable")
                        vectors, own_keys, ids = vectors[first], own_keys.take(pa.array(first)), ids.take(pa.array(first))
                        tree, sizes, held = KdTree(vectors @ r), np.diff(np.asarray(ids.offsets)), [None]
                    q, bound = _matrix(part.column("vec"), width), part.column("bound").to_numpy(zero_copy_only=False)
                    for i in range(0, len(q), _BATCH):
                        some = slice(i, i + _BATCH)
                        yield found(Search(tree, vectors, sizes, q[some], q[some] @ r, k + 1, stop, bound[some]).run(), part.column("key")[some], own_keys, ids)

    return run


class _Dealer:
    """Deals rows into groups (cell, chunk, block): a cell beyond its bound has several chunks of candidates, each its own tree, and its
    queries come in blocks, with a chunk's candidates beside each."""

    def __init__(self, grid: Grid, r: np.ndarray, width: int, candidates: np.ndarray, queries: np.ndarray, cell_rows: int, block: int):
        self.grid, self.r, self.width = grid, r, width
        self.chunks, self.blocks = np.maximum(1, -(-candidates // (2 * cell_rows))), -(-queries // block)
        self.base = np.cumsum(self.chunks * self.blocks) - self.chunks * self.blocks

    def _rows(self, batch: pa.RecordBatch, at: np.ndarray, g: np.ndarray, ask: bool, bound: np.ndarray) -> pa.RecordBatch:
        some = batch.take(pa.array(at))
        ids = pa.array([[]] * len(at), pa.list_(pa.int64())) if ask else some.column("ids")
        return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(np.full(len(at), ask)), some.column("key"), ids, some.column("vec"), pa.array(bound, pa.float64())], ["g", "ask", "key", "ids", "vec", "bound"])

    def candidates(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            at = np.repeat(np.arange(len(cell)), self.blocks[cell])
            block = np.arange(len(at)) - np.searchsorted(at, at)
            chunk = batch.column("key").field(0).to_numpy()[at] % self.chunks[cell[at]]
            for i in range(0, len(at), 4000):
                x = slice(i, i + 4000)
                yield self._rows(batch, at[x], self.base[cell[at[x]]] + chunk[x] * self.blocks[cell[at[x]]] + block[x], False, np.zeros(len(at[x])))

    def queries(self, batches: Iterator[pa.RecordBatch], stop: float | None) -> Iterator[pa.RecordBatch]:
        """To all chunks of their own cells, or with ``stop`` of all others that the test doesn't rule out."""
        for batch in batches:
            bound = batch.column("bound").to_numpy(zero_copy_only=False)
            at, cell = (np.arange(batch.num_rows), batch.column("cell").to_numpy()) if stop is None else self.grid.others(_matrix(batch.column("vec"), self.width) @ self.r, stop * bound)
            block = batch.column("key").field(1).to_numpy()[at] % self.blocks[cell]
            which = np.repeat(np.arange(len(at)), self.chunks[cell])
            chunk = np.arange(len(which)) - np.searchsorted(which, which)
            for i in range(0, len(which), 4000):
                w = which[i : i + 4000]
                yield self._rows(batch, at[w], self.base[cell[w]] + chunk[i : i + 4000] * self.blocks[cell[w]] + block[w], True, bound[at[w]])


def _by_cell(df: DataFrame, cells: int, *counts: str) -> list[np.ndarray]:
    """Sums by cell, one number a cell."""
    out = [np.zeros(cells, np.int64) for _ in counts]
    for row in df.groupBy("cell").agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in counts]).collect():
        for x, c in zip(out, counts):
            x[row["cell"]] = row[c]
    return out


def _search_all(points: DataFrame, members: DataFrame, width: int, k: int, dims: int, confidence: float, cell_rows: int, query_block: int, seed: int) -> DataFrame:
    """(key, ids, own, d): for each asked class of vectors the classes near it, k + 1 ids at least where there are so many."""
    classes, r, stop = cut(_classes(points, members, k)), projection(width, dims, seed), chi_square_quantile(confidence, dims)
    n = classes.count()
    cells = 1 << max(0, math.ceil(math.log2(max(1.0, math.sqrt(n) / 12.8, n / cell_rows))))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = (_matrix(batch.column("vec"), width) @ r).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), dims).cast(pa.list_(pa.float32()))], ["p"])

    sampled = map_arrow(classes.filter(F.pmod("key.a", F.lit(max(n, 1))) < min(FIT_A_CELL * cells, max(FIT_MOST, 4 * cells))).select("vec"), project, "p array<float>").toArrow() if cells > 1 else None
    grid = Grid(_matrix(sampled.column("p").combine_chunks(), dims) if cells > 1 else np.zeros((0, dims)), cells, dims)
    run, groups = _searcher(width, r, k, stop), "g bigint, ask boolean, key struct<a:bigint,b:bigint>, ids array<bigint>, vec " + points.schema["vec"].dataType.simpleString() + ", bound double"
    results = f"{_KEY}, ids array<bigint>, own boolean, d double, bound double"
    context = points.sparkSession.sparkContext
    shared = context.broadcast(grid)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = shared.value.cell(_matrix(batch.column("vec"), width) @ r)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    placed = cut(map_arrow(classes, place, f"{_KEY}, ids array<bigint>, asked boolean, vec {points.schema['vec'].dataType.simpleString()}, cell bigint"))
    held, asked = _by_cell(placed.withColumn("n", F.lit(1)), cells, "n", "asked")

    def visit(queries: DataFrame, counts: np.ndarray, at_most: float | None) -> DataFrame:
        dealer = context.broadcast(_Dealer(grid, r, width, held, counts, cell_rows, query_block))
        left = map_arrow(placed.select("key", "ids", "vec", "cell"), lambda it: dealer.value.candidates(it), groups)
        right = map_arrow(queries.select("key", "ids", "vec", "cell", "bound"), lambda it: dealer.value.queries(it, at_most), groups)
        return map_arrow(left.unionByName(right).repartition("g").sortWithinPartitions("g", "ask"), run, results)

    queries = placed.filter("asked")
    first = cut(visit(queries.withColumn("bound", F.lit(float("inf"))), asked, None))
    if cells == 1:
        return first
    # a bound that rounding puts a little too low could shut out a tie
    reached = first.groupBy("key").agg((F.min("bound") * (1 + 1e-12)).alias("bound"))
    bounded = cut(queries.join(reached, "key"))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            total += np.bincount(shared.value.others(_matrix(batch.column("vec"), width) @ r, stop * batch.column("bound").to_numpy())[1], minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["cell", "n"])

    (visits,) = _by_cell(map_arrow(bounded.select("vec", "bound"), numbers, "cell bigint, n bigint"), cells, "n")
    return first.unionByName(visit(bounded, visits, stop))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, dims: int = DIMS, confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS, query_block: int = QUERY_BLOCK, seed: int = 11,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``, by Euclidean distance.

    Equal vectors are one point with its k + 1 smallest ids. The top of the kd-tree deals all vectors into cells, some 13 square roots of
    their number and never over ``cell_rows`` each (a fuller cell is searched in chunks); it is fitted on a sample of FIT_A_CELL
    vectors a cell, FIT_MOST in all. A cell's task builds the rest of the tree. A query first searches its own cell; the distance reached there bounds the search of
    every other cell whose box passes the chi-square test. A true neighbour fails the test with a probability of at most 1 - ``confidence``.

    Left out: vectors that are null, zero, or hold null, NaN or infinity, and rows without an id. Vectors of different lengths have no
    distance, so each length is searched on its own. Repeated rows (same id and vector) count once; an id with several vectors is
    several points: each is asked on its own, with ranks from 1, and each is a candidate, for the others of its id, too. Ties go to the
    smaller id; a table of one vector has no neighbours; an empty table gives no rows; further columns are ignored.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(kind).alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(~bad & F.exists("vec", lambda x: x != 0)).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0).cast(kind[6:-1])))
    v = v.withColumn("key", F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit(1), "vec").alias("b"))).withColumn("width", F.size("vec"))
    members = cut(v.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "key", "width").distinct())
    widths = [w for (w,) in members.select("width").distinct().orderBy("width").collect()]
    if not widths:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    points = v.select("key", "id", "vec", "width").distinct()
    found = reduce(DataFrame.unionByName, [_search_all(points.filter(F.col("width") == w).drop("width"), members.filter(F.col("width") == w), w, k, dims, confidence, cell_rows, query_block, seed) for w in widths])
    top = found.select("key", F.explode("ids").alias("vec_id"), "own", "d").withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("d", "vec_id"))).filter(F.col("n") <= k + 1).drop("n")
    ranked = members.drop("width").join(top, "key").filter("NOT (own AND query_id = vec_id)").withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy("d", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("d").alias("score"))
