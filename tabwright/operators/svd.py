"""Truncated singular value decomposition of sparse rows: uncentred, matrix-free, a few passes over the table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.written import cut

#: Vectors multiplied at once beyond those that are wanted, and passes at most.
MORE, PASSES = 8, 8


def nonzeros(cols: list[str]) -> Column:
    """The columns' values other than zero, as arrays (indices, values) of a row; a missing value is an error."""
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(cols)])
    some = F.filter(entries, lambda e: F.coalesce(e.v, F.raise_error(F.lit("a value is missing"))) != 0)
    return F.struct(F.transform(some, lambda e: e.i).alias("indices"), F.transform(some, lambda e: e.v).alias("values"))


def _times(batch: pa.RecordBatch, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows times q, and each entry's row, column and value)."""
    of, values = batch.column("indices").flatten().to_numpy(zero_copy_only=False), batch.column("values").flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(batch.num_rows), batch.column("indices").value_lengths().to_numpy(zero_copy_only=False))
    out = np.stack([np.bincount(row, values * q[of, c], batch.num_rows) for c in range(q.shape[1])], 1).astype(float)  # of no entries it counts in whole numbers
    return out, row, of, values


def _gram(held):
    """(i, parts): rows of A'A q, from the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = held.value
        total = np.zeros(q.shape)
        for batch in batches:
            y, row, of, values = _times(batch, q)
            for c in range(q.shape[1]):
                total[:, c] += np.bincount(of, values * y[row, c], len(q))
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * q.shape[1], pa.int32()), pa.array(total[some].ravel()))], ["i", "parts"])

    return run


def fit(df: DataFrame, size: int, k: int, indices: str = "indices", values: str = "values", seed: int = 1, passes: int = PASSES, more: int = MORE) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, the right singular vectors as columns) of the k largest, of sparse rows (indices below ``size``, values).

    A block Krylov method: each pass multiplies A'A with a few vectors, where every task keeps what its own rows add and Spark sums that by column;
    ``size`` times a few numbers come to the driver, never a row. Values that lie close together take more passes. Vectors' signs are such that
    their largest entry is positive; fewer than k come back where the rank is less.
    """
    k = min(k, size)
    rows, context = cut(df.select(F.col(indices).cast("array<int>").alias("indices"), F.col(values).cast("array<double>").alias("values"))), df.sparkSession.sparkContext
    width = min(size, k + more)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    basis, products = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(passes):
        held = context.broadcast(q)
        sums = [F.sum(F.col("parts")[c]).alias(f"p{c}") for c in range(q.shape[1])]
        found = rows.mapInArrow(_gram(held), "i bigint, parts array<double>").groupBy("i").agg(*sums).toPandas().to_numpy()
        product = np.zeros(q.shape)
        product[found[:, 0].astype(int)] = found[:, 1:]
        basis, products = np.hstack([basis, q]), np.hstack([products, product])
        rest = product
        for _ in range(2):  # twice is enough to be orthogonal
            rest = rest - basis @ (basis.T @ rest)
        u, s, _ = np.linalg.svd(rest, full_matrices=False)
        q = u[:, s > 1e-10 * max(np.abs(product).max(initial=0), 1e-300)][:, : size - basis.shape[1]]
        if not q.shape[1]:
            break
    inner = basis.T @ products
    w, v = np.linalg.eigh((inner + inner.T) / 2)
    top = np.argsort(-w)[:k]
    top = top[w[top] > 1e-12 * max(w.max(initial=0), 1e-300)]
    vectors = basis @ v[:, top]
    if vectors.shape[1]:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return np.sqrt(w[top]), vectors


def _projected(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = held.value.shape[1]
        for batch in batches:
            y = _times(batch, held.value)[0] if k else np.zeros((batch.num_rows, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * k, pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "components"])

    return run


def project(df: DataFrame, vectors: np.ndarray, entries: Column, out: str = "components") -> DataFrame:
    """``df`` with ``out``, the array of its rows' components along the vectors; ``entries`` is a struct of indices and values."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), entries.alias("e")).select("row", "e.indices", "e.values")
    schema = packed.select("row", F.col("values").alias("components")).schema
    held = df.sparkSession.sparkContext.broadcast(vectors)
    return packed.mapInArrow(_projected(held), schema).select("row.*", F.col("components").alias(out))


def truncated_svd(df: DataFrame, cols: list[str], k: int, out: str = "components", **how) -> tuple[DataFrame, np.ndarray, float | None]:
    """(``df`` with its components, the singular values, the components' share of the columns' variance) of numeric columns, most of them zero."""
    entries = nonzeros(cols)
    values, vectors = fit(df.select(entries.alias("e")).select("e.indices", "e.values"), len(cols), k, **how)
    found = project(df, vectors, entries, out)
    spread = found.agg(*[F.var_pop(F.col(out)[i]).alias(f"c{i}") for i in range(len(values))], *[F.var_pop(F.col(f"`{c}`").cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]).first()
    total = sum(spread[f"x{i}"] or 0.0 for i in range(len(cols)))
    return found, values, sum(spread[f"c{i}"] or 0.0 for i in range(len(values))) / total if total else None
