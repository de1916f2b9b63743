"""Mutual information of numeric columns with classes by nearest neighbours (Ross, 2014), over tables of any length."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import stats
from tabwright.operators.ordering import numbered
from tabwright.written import cut

#: Neighbouring values that one task looks at, besides those on its borders.
VALUES_A_BLOCK = 50_000


def digamma(n: Column) -> Column:
    """Of positive numbers: by recurrence to beyond 8, then by its asymptotic series."""
    z = n.cast("double") + 8
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * F.pow(z, 2)) + 1 / (120 * F.pow(z, 4)) - 1 / (252 * F.pow(z, 6)) + 1 / (240 * F.pow(z, 8)) - 1 / (132 * F.pow(z, 10))
    return series - sum((1 / (n.cast("double") + j) for j in range(8)), F.lit(0.0))


def _of_column(df: DataFrame, col: str, target: str, k: int, block: int) -> float | None:
    x = F.col(f"`{col}`").cast("double") + F.lit(0.0)  # one zero
    values = df.select(F.col(f"`{target}`").cast("string").alias("y"), x.alias("x")).filter("y IS NOT NULL AND x IS NOT NULL AND NOT isnan(x)").groupBy("y", "x").agg(F.count("*").alias("n"))
    values = cut(values)
    sizes = values.groupBy("y").agg(F.sum("n").alias("size")).filter("size > 1")
    values = cut(numbered(values.join(F.broadcast(sizes), "y"), "y", "x"))
    # --- k values to either side of each, in blocks with a border of k values
    at = F.col("_at")
    own = F.floor(at / block)
    blocks = F.array_distinct(F.array(own, F.greatest(F.floor((at - k) / block), F.lit(0)), F.floor((at + k) / block)))
    near = Window.partitionBy("_block").orderBy("_at")
    dealt = values.withColumn("_block", F.explode(blocks))
    around = [F.struct(F.col("y"), F.col("x"), F.col("n"))]
    sides = [f(around[0], j).over(near).alias(f"{name}{j}") for name, f in (("a", F.lag), ("b", F.lead)) for j in range(1, k + 1)]
    seen = dealt.select("*", *sides).filter(F.col("_block") == own)
    others = F.filter(F.array(*[F.col(f"{s}{j}") for s in "ab" for j in range(1, k + 1)]), lambda o: o.isNotNull() & (o.y == F.col("y")))
    ways = F.array_sort(F.concat(F.array(F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("n"), F.col("x").alias("x"))), F.transform(others, lambda o: F.struct(F.abs(F.col("x") - o.x).alias("d"), o.n.alias("n"), o.x.alias("x")))))
    wanted = F.least(F.lit(k), F.col("size") - 1)
    # the distance at which the neighbours up to it are enough
    found = F.aggregate(ways, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("d")), lambda s, w: F.struct((s.n + w.n).alias("n"), F.when(s.d.isNotNull(), s.d).when(s.n + w.n >= wanted, w.d).alias("d")), lambda s: s.d)
    radius = seen.select("y", "x", "n", "size", wanted.alias("k"), ways.alias("ways"), found.alias("r"))
    end = lambda below: F.array_max(F.transform(F.filter("ways", lambda w: (w.d == F.col("r")) & ((w.x < F.col("x")) if below else (w.x > F.col("x")))), lambda w: w.x))
    # neighbours at the distance itself are the ends, so that no rounding moves them inside
    points = cut(radius.select("x", "n", "size", "k", "r", F.when(F.col("r") == 0, F.col("x")).otherwise(F.coalesce(end(True), F.col("x") - F.col("r"))).alias("low"), F.when(F.col("r") == 0, F.col("x")).otherwise(F.coalesce(end(False), F.col("x") + F.col("r"))).alias("high")))
    # --- rows of any class between the ends: running totals of all values and ends
    all_values = values.select(F.col("x").alias("v"), "n").unionByName(points.select(F.explode(F.array("low", "high")).alias("v"), F.lit(0).cast("bigint").alias("n")))
    totals = cut(stats.running_totals(cut(all_values.groupBy("v").agg(F.sum("n").alias("n"))), "v", "n"))
    low = totals.select(F.col("v").alias("low"), F.col("_upto").alias("upto_low"), F.col("n").alias("n_low"))
    high = totals.select(F.col("v").alias("high"), (F.col("_upto") - F.col("n")).alias("below_high"))
    inside = F.when(F.col("r") == 0, F.col("n_low")).otherwise(F.col("below_high") - F.col("upto_low"))
    parts = points.join(low, "low").join(high, "high").select("n", "size", "k", inside.alias("m"))
    of = lambda c: F.sum(F.col("n") * digamma(F.col(c)))
    n, by_k, by_size, by_m = parts.agg(F.sum("n"), of("k"), of("size"), of("m")).first()
    return None if not n else max(0.0, _digamma(n) + (by_k - by_size - by_m) / n)


def _digamma(n: int) -> float:
    z = n + 8
    return math.log(z) - 1 / (2 * z) - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6) + 1 / (240 * z**8) - sum(1 / (n + j) for j in range(8))


def neighbour_information(df: DataFrame, cols: list[str], target: str, k: int = 3, block: int = VALUES_A_BLOCK) -> DataFrame:
    """(feature, mi): an estimate of each numeric column's mutual information with the classes of ``target``, in nats, at least 0.

    A row's radius is the distance to its k-th nearest row of its class, and m counts the rows of any class nearer than that, itself included (with
    a radius of 0, the rows of its value): digamma(n) + mean digamma(k) - mean digamma(class size) - mean digamma(m). Classes of one row are left
    out; in classes of k rows or fewer the farthest one is taken. Nothing is random: equal values are neighbours at distance 0.

    Equal values are one record with a number, sorted over all partitions; neighbours are found in blocks of ``block`` of them with k more on either
    border, counts from running totals. No task holds a column, and no value is a hot key. Rows that lack the column or the target are left out;
    a column without any has null.
    """
    return stats.frame(df.sparkSession, [(c, _of_column(df, c, target, k, block)) for c in cols], "feature string, mi double")
