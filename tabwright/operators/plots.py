"""Figures as data: bins, series and matrices that a chart draws; and a small HTML report of tables."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import stats


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, n) of equal width from the least to the largest value, empty bins included."""
    lo, hi = df.agg(F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double"))).first()
    schema = "bin int, low double, high double, n bigint"
    if lo is None:
        return df.sparkSession.createDataFrame([], schema)
    width = (hi - lo) / bins or 1.0
    at = F.least(F.floor((F.col(col).cast("double") - lo) / width), F.lit(bins - 1)).cast("int")
    n = df.filter(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), (lo + F.col("id") * width).alias("low"), (lo + (F.col("id") + 1) * width).alias("high"))
    return edges.join(F.broadcast(n), "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def heatmap(df: DataFrame, cols: list[str], method: str = "pearson") -> DataFrame:
    """The lower triangle of the correlation matrix in long form."""
    return stats.correlation_pairs(df, cols, method).select(F.col("feature_j").alias("row"), F.col("feature_i").alias("col"), "r")


def predicted_and_actual(df: DataFrame, time: str, actual: str, predicted: str) -> DataFrame:
    """(time, series, value), one row a line's point."""
    return df.unpivot([time], [actual, predicted], "series", "value")


def html_report(title: str, tables: dict[str, DataFrame], path: str, most_rows: int = 200) -> str:
    """Write a page with the first ``most_rows`` of each table through Spark's file system, and return its text; a longer table says that it goes on."""
    parts = [f"<h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        rows = df.limit(most_rows + 1).collect()
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in row) + "</tr>" for row in rows[:most_rows])
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>" + (f"<p>The first {most_rows} rows; there are more.</p>" if len(rows) > most_rows else ""))
    text = f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body>{''.join(parts)}</body></html>"
    spark = next(iter(tables.values())).sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return text
