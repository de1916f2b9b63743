"""Outlier rules by fixed range, quantile range, interquartile range and upper quantile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.quantiles import quantiles

METHODS = ("set_nan", "drop", "clip")


def _outside(col: str, lo: float | None, hi: float | None) -> Column:
    """True where a value is out of bounds; a null value or bound is never out."""
    tests = ([F.col(col) < F.lit(lo)] if lo is not None else []) + ([F.col(col) > F.lit(hi)] if hi is not None else [])
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def range_outliers(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]], method: str = "set_nan") -> DataFrame:
    """``set_nan`` masks values out of bounds, ``drop`` drops rows with any, ``clip`` moves them to the bound. Nulls stay null."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    if method == "drop":
        return df.filter(~reduce(lambda a, b: a | b, [_outside(c, *b) for c, b in bounds.items()], F.lit(False)))
    out = {}
    for c, (lo, hi) in bounds.items():
        if method == "set_nan":
            out[c] = F.when(~_outside(c, lo, hi), F.col(c))
        else:
            low = F.col(c) if lo is None else F.when(F.col(c) < lo, F.lit(lo)).otherwise(F.col(c))
            out[c] = low if hi is None else F.when(F.col(c) > hi, F.lit(hi)).otherwise(low)
    return df.withColumns(out)


def quantile_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> dict[str, tuple[float | None, float | None]]:
    """Exact interpolated quantiles of all columns."""
    return {c: tuple(x) for c, x in quantiles(df, {c: list(b) for c, b in bounds.items()}).items()}


def quantile_outliers(df: DataFrame, bounds: dict[str, tuple[float, float]], method: str = "set_nan") -> DataFrame:
    for c, (lo, hi) in bounds.items():
        if not 0 <= lo <= hi <= 1:
            raise ValueError(f"quantiles of {c} must be within [0, 1] and ordered")
    return range_outliers(df, quantile_bounds(df, bounds), method)


def iqr_outliers(df: DataFrame, cols: list[str], bounds: tuple[float, float] = (0.25, 0.75), multiplier: float = 1.5, method: str = "set_nan") -> DataFrame:
    fences = {}
    for c, (lo, hi) in quantile_bounds(df, {c: bounds for c in cols}).items():
        fences[c] = (None, None) if lo is None else (lo - multiplier * (hi - lo), hi + multiplier * (hi - lo))
    return range_outliers(df, fences, method)


def apply_outlier_rule(df: DataFrame, rule: str, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """``clip``, or ``drop``, which masks values here; a missing bound is no bound."""
    if rule not in ("clip", "drop"):
        raise ValueError(f"rule must be clip or drop, not {rule!r}")
    return range_outliers(df, bounds, "clip" if rule == "clip" else "set_nan")


def outlier_detection(df: DataFrame, cols: list[str], quantile: float, id_col: str) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Rows whose id exceeds the quantile in no column, the removed ids' rows, and the quantiles. Every row of a bad id goes."""
    found = quantile_bounds(df, {c: (quantile, quantile) for c in cols})
    tops = {c: hi for c, (_, hi) in found.items()}
    bad = df.filter(reduce(lambda a, b: a | b, [_outside(c, None, t) for c, t in tops.items()], F.lit(False))).select(id_col).distinct()
    return df.join(bad, id_col, "left_anti"), df.join(bad, id_col, "left_semi"), tops
