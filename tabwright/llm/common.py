"""What the operators share: tables, files in the shared folder, Arrow batches and connected components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.written import cut, own_dir, shared_dir  # noqa: F401  operators take them from here

#: ASCII white space of the word and line rules: a space and \x09 to \x0D, which is also what ``bytes.split()`` splits at.
WHITE = b" \t\n\x0b\x0c\r"

#: Rows and bytes of an Arrow batch: the same for all operators, so that none changes the batches of another's lazy plan. An executor's JVM
#: holds a batch several times over outside its heap, in buffers of the next power of two, and its C library keeps most of what such buffers took.
BATCH_ROWS, BATCH_BYTES = 2_000, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class _Released:
    """A batch function whose task gives unused memory back at its end: workers live on from stage to stage. What tasks of another operator
    have left in the worker goes before it begins, unless the function keeps things there itself."""

    def __init__(self, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], trims: bool, keeps: bool, piece: int, together: int = 0):
        self.f, self.trims, self.keeps, self.piece, self.together = f, trims, keeps, piece, together

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _cached and not self.keeps:
            _cached.clear()
            _trim()
        if self.together:
            batches = gathered(batches, self.together)
        try:
            yield from self.f(pieces(batches, self.piece) if self.piece else batches)
        finally:
            if self.trims:
                _trim()
            else:
                pa.default_memory_pool().release_unused()


def pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in runs of about ``size`` bytes, one row at least; unused memory is given back after each."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
            _trim()


def gathered(batches: Iterator[pa.RecordBatch], size: int, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """All rows in batches of up to ``size`` bytes and ``rows`` rows, if no batch that comes has more; none is empty."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and (sum(x.num_rows for x in held) + batch.num_rows > rows or sum(x.nbytes for x in held) + batch.nbytes > size):
            yield pa.concat_batches(held)
            held = []
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def map_arrow(
    df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, trims: bool = True, keeps: bool = False, piece: int = 0, together: int = 0
) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes as well as rows, so that very long texts don't add up in a worker. A function that keeps most
    of its memory from task to task needn't give the rest back (``trims``); one that calls ``worker_cache`` has to say so (``keeps``).
    One that needs many times a batch's memory gets it in pieces of about so many bytes (``piece``), and no empty ones. One whose results
    are the fewer the more rows it sees at once gets batches put together up to so many bytes (``together``).

    Spark takes the bounds from the session as a plan begins to run, so they stay set there."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    _importable(df.sparkSession)
    return df.mapInArrow(_Released(f, trims, keeps, piece, together), schema)


def _importable(spark: SparkSession) -> None:
    """On a local master workers find this package wherever the driver was started; a cluster has it installed or sent along."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), root)))


_cached: dict[Hashable, Any] = {}


def worker_cache(owner: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task of one operator; the next task of another operator, cached or not, drops it.

    It has to be reached by a function of a module: a function inside another travels with copies of the globals it names."""
    if owner not in _cached:
        _cached.clear()
        _cached[owner] = make()
    return _cached[owner]


def small_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A table of what the driver has, as Arrow. Of a list of rows Spark would make one by Python workers with an environment of their own, beside the others."""
    return spark.createDataFrame(pa.table(columns))


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A binary column with null as empty."""
    return [x if x is not None else b"" for x in batch.column(name).to_pylist()]


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and UTF-8 text of the rows that have an id; other columns, whatever their names, stay behind."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).filter("doc_id IS NOT NULL")


def merged(df: DataFrame) -> DataFrame:
    """A side of a join whose rows grow with the input: sorted and merged. Spark would go by the size of written files, which may be a tenth or
    a hundredth of that of their rows, and broadcast them through the driver."""
    return df.hint("merge")


#: Parts that a node's neighbours are dealt into, in the joins of ``components``.
_SALTS = 16


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least neighbour of u. The minimum is found by partial aggregation; it is joined back by node and part of
    the neighbours, so that a hub's edges don't meet in one task."""
    salt = F.pmod(F.xxhash64("v"), F.lit(_SALTS)).cast("int")
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return edges.withColumn("s", salt).join(merged(least), ["u", "s"]).drop("s")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of (u, v) bigint edges as (node, root): root is the smallest node; roots themselves are left out.

    Alternates large-star and small-star steps. Each step is a few joins and aggregations over all edges, written to the shared
    folder; the driver sees only a count and a checksum per step.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e, before = cut(e), None
    for _ in range(most_rounds):
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        large = _with_least(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = cut(large.filter("u <> v").distinct())
        near = _with_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = cut(small.unionByName(near.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
