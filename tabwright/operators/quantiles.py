"""Exact interpolated quantiles of many columns, of a whole table or by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Relative accuracy of the first look, and how many of its errors around a wanted rank are searched exactly.
ACCURACY, MARGIN = 10_000, 5


def quantile_rows(df: DataFrame, wanted: dict[str, list[float]], by: str | None = None) -> DataFrame:
    """(_by, feature, q, value): interpolated quantiles of each column, nulls left out; none for a column without values. ``_by`` is 0 without groups.

    A sketch of every column (and group) narrows each wanted rank down to a thousandth of the values; those are counted by value and only
    they are put in order. Both are aggregations that tasks begin by themselves: no column and no group meets whole in one task.
    """
    cols, edge = list(wanted), MARGIN / ACCURACY
    asked = [(i, q) for i, c in enumerate(cols) for q in wanted[c]]
    spark, found = df.sparkSession, "_by {}, feature string, q double, value double"
    base = df.select((F.col(f"`{by}`") if by else F.lit(0)).alias("_by"), *[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if not asked:
        return spark.createDataFrame([], found.format(base.schema["_by"].dataType.simpleString()))
    ends = [F.array(*[F.lit(x) for q in wanted[c] for x in (max(0.0, q - edge), min(1.0, q + edge))]) for c in cols]
    looks = [x for i, c in enumerate(cols) if wanted[c] for x in (F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", ends[i], ACCURACY).alias(f"e{i}"))]
    sketch = base.groupBy("_by").agg(*looks)
    if by:
        near = base.join(sketch.withColumnRenamed("_by", "_g"), F.col("_by").eqNullSafe(F.col("_g")))
        value = lambda name: F.col(name)
    else:
        row = sketch.first()
        if row is None:
            return spark.createDataFrame([], found.format("int"))
        near = base
        value = lambda name: F.lit(row[name]) if name[0] == "n" else F.array(*[F.lit(x) for x in row[name]]) if row[name] else F.lit(None).cast("array<double>")
    parts, place = [], dict.fromkeys(range(len(cols)), 0)
    for j, (i, q) in enumerate(asked):
        v, lo, hi = F.col(f"v{i}"), value(f"e{i}")[2 * place[i]], value(f"e{i}")[2 * place[i] + 1]
        few = value(f"n{i}") < ACCURACY  # too few for a margin of several ranks, and few enough to order all
        lo, hi = F.when(few, F.lit(float("-inf"))).otherwise(lo), F.when(few, F.lit(float("inf"))).otherwise(hi)
        place[i] += 1
        parts.append(F.when(v <= hi, F.struct(F.lit(j).alias("j"), (F.lit(float(q)) * (value(f"n{i}") - 1)).alias("at"), F.when(v >= lo, v).alias("v"))))
    counts = near.select("_by", F.explode(F.array_compact(F.array(*parts))).alias("x")).groupBy("_by", "x.j", "x.at", "x.v").count()
    upto = F.sum("count").over(Window.partitionBy("_by", "j", "at").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = lambda rank: F.min(F.when(F.col("_upto") > rank, F.coalesce("v", F.lit(float("-inf")))))
    low, high, share = F.col("low"), F.col("high"), F.col("at") - F.floor("at")
    rows = counts.withColumn("_upto", upto).groupBy("_by", "j", "at").agg(first(F.floor("at")).alias("low"), first(F.ceil("at")).alias("high"))
    # a rank below or beyond the counted values would be an error of the sketch
    sound = F.when(low.isNull() | high.isNull() | (low == float("-inf")), F.raise_error(F.lit("the sketch missed a rank")).cast("double"))
    exact = F.coalesce(sound, F.when(low == high, low).otherwise((F.ceil("at") - F.col("at")) * low + share * high))
    names, qs = F.array(*[F.lit(cols[i]) for i, _ in asked]), F.array(*[F.lit(float(q)) for _, q in asked])
    return rows.select("_by", names[F.col("j")].alias("feature"), qs[F.col("j")].alias("q"), exact.alias("value"))


def quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """The quantiles of each column in the order asked for, None without values: a few numbers a column."""
    got = {(r["feature"], r["q"]): r["value"] for r in quantile_rows(df, wanted).collect()}
    return {c: [got.get((c, float(q))) for q in qs] for c, qs in wanted.items()}
