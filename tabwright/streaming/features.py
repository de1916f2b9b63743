"""The operators' stateless steps on a stream, and windowed features with bounded state."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalised(stream: DataFrame, steps: dict[Callable[[Column], Column], Iterable[str]]) -> DataFrame:
    """Column functions applied to columns of a stream, function by function."""
    for f, cols in steps.items():
        stream = stream.withColumns({c: f(F.col(f"`{c}`")) for c in cols})
    return stream


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str = "4 hours", late: str = "1 hour", value: str | None = None) -> DataFrame:
    """Counts, and least and mean of a value, by tumbling window and keys. Rows later than ``late`` are dropped, and with them old state."""
    aggs = [F.count("*").alias("n")] + ([F.min(value).alias(f"min_{value}"), F.avg(value).alias(f"mean_{value}")] if value else [])
    out = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("start"), *[c for c in out.columns if c != "w"])
