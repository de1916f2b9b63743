"""Places in an order over all partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.written import cut


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``_at``, their places from 0 in an order over all partitions, and written."""
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.monotonically_increasing_id()))
    part = F.shiftright("_p", 33)
    before = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row a partition
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("_at", F.col("_before") + F.col("_p").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_p", "_before")
