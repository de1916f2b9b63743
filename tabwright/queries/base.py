"""The registry, and the tables that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Both sides see the same sum of floating-point numbers only up to the order of addition; figures are compared at this many digits.
DIGITS = 4


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function by its name, with the SQL that gives the same rows."""
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


MASTER_SQL = """
SELECT c_custkey AS customer_id, c_acctbal, c_mktsegment, c_nationkey, coalesce(n_orders, 0) AS n_orders, total_spend, avg_spend, max_spend,
  CASE WHEN last_order < TIMESTAMP '1998-03-01' THEN 1 ELSE 0 END AS churn
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_spend, avg(o_totalprice) AS avg_spend,
  max(o_totalprice) AS max_spend, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey"""


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: balance, segment, nation, order aggregates, and whether the last order lies before a date."""
    spend = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total_spend"), F.avg("o_totalprice").alias("avg_spend"), F.max("o_totalprice").alias("max_spend"), F.max("o_orderdate").alias("last_order"))
    return table(spark, sf_dir, "customer").join(spend, "c_custkey", "left").select(
        F.col("c_custkey").alias("customer_id"), "c_acctbal", "c_mktsegment", "c_nationkey", F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"), "total_spend", "avg_spend", "max_spend",
        F.when(F.col("last_order") < F.lit("1998-03-01").cast("timestamp"), 1).otherwise(0).alias("churn"))


def rounded(df: DataFrame, digits: int = DIGITS, but: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded for comparison, without negative zeros; columns in ``but`` stay as they are."""
    return df.select(*[(F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") and c not in but else F.col(f"`{c}`") for c, t in df.dtypes])
