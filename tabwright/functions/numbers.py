"""Numbers, dates, booleans, casts and missing values as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a missing value in text, and as true and false.
MISSING = ("nan", "NaN", "Nan")
TRUE, FALSE = ("yes", "true", "t", "1", "on", "1.0"), ("no", "false", "f", "0", "off", "0.0")
#: A number as Python's float() reads it: no type suffix, single underscores between digits.
FLOAT = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
NUMERIC_KINDS = {"double": "numeric", "float": "numeric", "bigint": "numeric", "int": "numeric", "smallint": "numeric", "string": "categorical"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_float(c: Column | str) -> Column:
    """Text to double by Python's rules, with inf and nan as missing; null where it is no number."""
    text = _col(c).cast("string")
    return F.when(text.rlike(FLOAT), F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double"))


def is_floatable(c: Column | str) -> Column:
    text = F.lower(F.trim(_col(c).cast("string")))
    return _col(c).cast("string").rlike(FLOAT) | text.rlike("^[+-]?(inf|infinity|nan)$")


def us_number(c: Column | str, strict: bool = True) -> Column:
    """``1,234.56`` to 1234.56. The fraction is always added, so ``-1,234.56`` is -1233.44; not ``strict``, it takes the sign.

    A text with commas needs exactly one point; others are null."""
    text = F.replace(_col(c).cast("string"), F.lit(" "), F.lit(""))
    parts = F.split(text, r"\.")
    whole, digits = to_float(F.replace(parts[0], F.lit(","), F.lit(""))), parts[1]
    fraction = to_float(digits) / F.pow(F.lit(10.0), F.length(digits))
    signed = fraction if strict else F.when(F.startswith(text, F.lit("-")), -fraction).otherwise(fraction)
    return F.coalesce(to_float(c), F.when(F.size(parts) == 2, whole + signed))


def abscissa(c: Column | str) -> Column:
    """``12+345`` to 12.345: the second part is the fraction's digits."""
    parts = F.split(F.replace(_col(c), F.lit(" "), F.lit("")), r"\+")
    return to_float(parts[0]) + to_float(parts[1]) / F.pow(F.lit(10.0), F.length(parts[1]))


def decimal_degrees(c: Column | str, axis: str) -> Column:
    """``d-m-s`` to degrees; ``latitud`` is north, any other axis west and so negative."""
    parts = F.split(_col(c), "-")
    value = to_float(parts[0]) + to_float(parts[1]) / 60 + to_float(parts[2]) / 3600
    return value if axis == "latitud" else -value


def bool_number(c: Column | str) -> Column:
    """1 and 0 of the words for true and false; nan is missing, and anything else, null as well, is an error."""
    low = F.lower(_col(c).cast("string"))
    return F.when(low.isin(*TRUE), F.lit(1.0)).when(low.isin(*FALSE), F.lit(0.0)).when(low == "nan", F.lit(None).cast("double")).otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(low, F.lit("null")))))


def to_bool(c: Column | str) -> Column:
    """``bool_number`` as boolean, where a missing value is true."""
    return F.coalesce(bool_number(c).cast("boolean"), F.lit(True))


def cast_kind(c: Column | str, kind: str) -> Column:
    """numeric, categorical (missing becomes ``nan``), boolean or datetime; values that don't fit are errors under ANSI mode."""
    x = _col(c)
    if kind == "numeric":
        return x.cast("double")
    if kind == "categorical":
        return F.coalesce(x.cast("string"), F.lit("nan"))
    if kind == "boolean":
        return to_bool(x)
    if kind == "datetime":
        return x.cast("timestamp")
    raise ValueError(f"kind must be numeric, categorical, boolean or datetime, not {kind!r}")


def enforce_schema(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    if absent := [c for c in kinds if c not in df.columns]:
        raise KeyError(f"columns {absent} are not in the table")
    return df.withColumns({c: cast_kind(F.col(f"`{c}`"), k) for c, k in kinds.items()})


def convert_to_float(df: DataFrame) -> DataFrame:
    """Each text column whose values all are numbers becomes double; one null or other text keeps it. One aggregation finds out for all."""
    strings = [c for c, t in df.dtypes if t == "string"]
    others = [c for c, t in df.dtypes if t in ("bigint", "int", "smallint", "float", "boolean", "tinyint") or t.startswith("decimal")]
    tests = [F.coalesce(F.every(F.coalesce(is_floatable(F.col(f"`{c}`")), F.lit(False))), F.lit(True)).alias(f"s{i}") for i, c in enumerate(strings)]
    tests += [F.coalesce(F.every(F.col(f"`{c}`").isNotNull()), F.lit(True)).alias(f"n{i}") for i, c in enumerate(others)]
    if not tests:
        return df
    row = df.agg(*tests).first()
    change = {c: to_float(F.col(f"`{c}`")) for i, c in enumerate(strings) if row[f"s{i}"]}
    change |= {c: F.col(f"`{c}`").cast("double") for i, c in enumerate(others) if row[f"n{i}"]}
    return df.withColumns(change) if change else df


def id_text(c: Column | str) -> Column:
    """An id by way of a whole number to text: 12.0 is ``12``."""
    return _col(c).cast("double").cast("bigint").cast("string")


def cast_id(df: DataFrame, id_col: str) -> DataFrame:
    return df.withColumn(id_col, id_text(F.col(f"`{id_col}`")))


def type_dictionary(df: DataFrame, id_col: str) -> dict:
    """Columns by kind: numeric, categorical (text) and other; the id is in none."""
    kinds = {c: NUMERIC_KINDS.get(t, "other") for c, t in df.dtypes if c != id_col}
    return {f"{k}_features" if k != "other" else "other_type": [c for c, x in kinds.items() if x == short] for k, short in (("numerical", "numeric"), ("categorical", "categorical"), ("other", "other"))} | {"customer_id_col": id_col}


def no_missing_marks(c: Column | str, kind: str) -> Column:
    """Texts for missing, NaN and infinities become null."""
    x = _col(c)
    if kind == "string":
        return F.when(~x.isin(*MISSING), x)
    if kind in ("float", "double"):
        return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return x


def nulls_for_missing(df: DataFrame) -> DataFrame:
    return df.select(*[no_missing_marks(F.col(f"`{c}`"), t).alias(c) for c, t in df.dtypes])


def fill_missing(df: DataFrame, value: float | int | str = 0) -> DataFrame:
    """All nulls, marks for missing and infinities become ``value``, as text in text columns; dates and the like keep their nulls."""
    def filled(c: str, t: str) -> Column:
        x = no_missing_marks(F.col(f"`{c}`"), t)
        if t == "string":
            return F.coalesce(x, F.lit(str(value)))
        return F.coalesce(x, F.lit(value).cast(t)) if t in NUMERIC_KINDS else x

    return df.select(*[filled(c, t).alias(c) for c, t in df.dtypes])


def churn_flag(df: DataFrame, churn_col: str) -> DataFrame:
    """``churn``, by that name: 1 where the column is a number above 0, else 0."""
    return df.withColumn("churn", (F.coalesce(no_missing_marks(F.col(f"`{churn_col}`").cast("double"), "double"), F.lit(0.0)) > 0).cast("int"))


def date_text(c: Column | str) -> Column:
    """The first ten characters as a date, written again as yyyy-MM-dd."""
    return F.date_format(F.to_date(F.substring(_col(c).cast("string"), 1, 10)), "yyyy-MM-dd")


def cluster_baseline_percent(k: int) -> float:
    """A cluster's share, in percent, if all were of one size."""
    return round(100 / k, 2)


def int_params(params: dict, names: list[str]) -> dict:
    return params | {n: int(params[n]) for n in names if n in params}


def round_even(c: Column, digits: int) -> Column:
    """Halves to the even digit."""
    return F.rint(c * 10**digits) / 10**digits


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
