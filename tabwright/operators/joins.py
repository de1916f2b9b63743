"""Joins of feature tables and of rankings by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_left(keys: str | list[str], *dfs: DataFrame) -> DataFrame:
    """Left joins from the first table on keys as text; repeated keys on the right repeat rows."""
    keys = [keys] if isinstance(keys, str) else keys
    texts = [d.withColumns({k: F.col(f"`{k}`").cast("string") for k in keys}) for d in dfs]
    return reduce(lambda a, b: a.join(b, keys, "left"), texts)


def join_outer(key: str, left: DataFrame, right: DataFrame, fill: float = 0) -> DataFrame:
    """Full outer join by one key, missing numbers filled."""
    return left.join(right, key, "full").fillna(fill)


def join_rankings(key: str, *dfs: DataFrame) -> DataFrame:
    """Full outer joins of rankings, missing votes 0, best first by all value columns in turn. Value columns of one name get _x and _y."""
    def merged(a: DataFrame, b: DataFrame) -> DataFrame:
        same = (set(a.columns) & set(b.columns)) - {key}
        return a.withColumnsRenamed({c: f"{c}_x" for c in same}).join(b.withColumnsRenamed({c: f"{c}_y" for c in same}), key, "full")

    out = reduce(merged, dfs).fillna(0)
    return out.orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in out.columns if c != key])


def side_by_side(row_id: str, *dfs: DataFrame) -> DataFrame:
    """The columns of several tables beside each other, row by row: rows meet by an explicit number, since a table has no order of its own.

    A row that a table lacks is null there; a column name that two tables share is an error."""
    names = [c for d in dfs for c in d.columns if c != row_id]
    if len(set(names)) < len(names):
        raise ValueError(f"columns {sorted({c for c in names if names.count(c) > 1})} come more than once")
    return reduce(lambda a, b: a.join(b, row_id, "full"), dfs)
