"""All registered queries of the customer analytics operators, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.queries import base, clusters, files, functions, geo, learning, selection, tables  # noqa: F401  they register their queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
