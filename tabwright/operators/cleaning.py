"""Projections, null handling, duplicates, one-hot encoding and imputation of wide tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.numbers import cast_id, churn_flag, convert_to_float, nulls_for_missing, to_float, type_dictionary
from tabwright.functions.text import standardise_name, standardise_names
from tabwright.operators.quantiles import quantiles

#: Aggregate expressions of one pass; wider tables take more passes, so that generated code stays within its limits.
MOST_AGGREGATES = 300


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def aggregate(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Values of named aggregates, all in one pass over the data as far as their number allows."""
    names, out = list(exprs), {}
    for i in range(0, len(names), MOST_AGGREGATES):
        part = names[i : i + MOST_AGGREGATES]
        row = df.agg(*[exprs[n].alias(f"a{k}") for k, n in enumerate(part)]).first()
        out |= {n: row[f"a{k}"] for k, n in enumerate(part)}
    return out


def select_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """The columns, each once, in the order given."""
    return df.select(*[_c(c) for c in dict.fromkeys(cols)])


def remove_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Without these columns; absent ones are ignored."""
    return df.drop(*cols)


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if "Unnamed" in c])


def id_first(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(_c(id_col), *[_c(c) for c in df.columns if c != id_col])


def null_percent(df: DataFrame) -> dict[str, float]:
    """Percent of nulls by column; 0 on an empty table."""
    found = aggregate(df, {c: F.avg(_c(c).isNull().cast("int")) * 100 for c in df.columns})
    return {c: v or 0.0 for c, v in found.items()}


def drop_null_columns(df: DataFrame, threshold: float = 99) -> DataFrame:
    """Without the columns that have more than ``threshold`` percent nulls."""
    return df.drop(*[c for c, v in null_percent(df).items() if v > threshold])


def merge_same_names(df: DataFrame) -> DataFrame:
    """Columns of one name become one: the first value that isn't null in each row, in the first one's type. Columns come out sorted by name."""
    groups: dict[str, list[int]] = {}
    for i, c in enumerate(df.columns):
        groups.setdefault(c, []).append(i)
    types, unique = [t for _, t in df.dtypes], df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return unique.select(*[F.coalesce(*[F.col(f"_{i}").cast(types[at[0]]) for i in at]).alias(c) for c, at in sorted(groups.items())])


def deduplicate(df: DataFrame, subset: list[str], order: list[str] | None = None, keep: str | bool = "first") -> DataFrame:
    """One row of each key, the first or last by ``order`` (all columns by default, nulls last), or with ``keep=False`` only keys of one row."""
    keys = Window.partitionBy(*[_c(c) for c in subset])
    if keep is False:  # by partial counts: a key of very many rows never comes together
        row = F.any_value(F.struct(*[_c(c) for c in df.columns]))
        return df.groupBy(*[_c(c) for c in subset]).agg(F.count("*").alias("_n"), row.alias("_row")).filter("_n = 1").select("_row.*")
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first', 'last' or False")
    by = [_c(c).asc_nulls_last() if keep == "first" else _c(c).desc_nulls_first() for c in order or df.columns]
    return df.withColumn("_n", F.row_number().over(keys.orderBy(*by))).filter("_n = 1").drop("_n")


def drop_nulls(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def filter_churned(df: DataFrame, id_col: str = "customer_id", churn_col: str = "churn", apply: bool | str = True) -> tuple[DataFrame, DataFrame]:
    """Rows that have not churned, and the ids of none of them. Any text but an empty one means ``apply``, "False" too."""
    if not bool(apply):
        return df, df.select(_c(id_col)).limit(0)
    active = df.filter(_c(churn_col) == 0)
    return active, df.select(_c(id_col)).distinct().join(active.select(_c(id_col)).distinct(), id_col, "left_anti")


def split_by_ids(df: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is among ``ids``, the others)."""
    keys = ids.select(_c(id_col)).distinct()
    return df.join(keys, id_col, "left_semi"), df.join(keys, id_col, "left_anti")


#: Values that become columns at most: more don't make a table that anything can read.
MOST_VALUES = 5_000


def category_values(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Distinct values, sorted; each becomes a column, so more than MOST_VALUES of them are an error. Tasks begin to drop repeats by themselves."""
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _c(c).cast("string").alias("v")) for i, c in enumerate(cols)]))
    rows = df.select(pairs.alias("x")).select("x.*").filter("v IS NOT NULL").distinct().limit(MOST_VALUES * len(cols) + 1).collect()
    found = {c: sorted(r["v"] for r in rows if r["i"] == i) for i, c in enumerate(cols)}
    if wide := [c for c, v in found.items() if len(v) > MOST_VALUES]:
        raise ValueError(f"columns {wide} have too many values to become columns")
    return found


def one_hot(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """A 0/1 column for each value of each column, named ``column_value`` in standard form and sorted. A null is 0 in all.

    Where two values lead to one name only the first counts. No columns give an empty selection beside ``keep``.
    """
    named: dict[str, Column] = {}
    for c, values in category_values(df, cols).items():
        for v in values:
            named.setdefault(standardise_name(f"{c}_{v}"), F.when(_c(c).cast("string") == v, F.lit(1.0)).otherwise(F.lit(0.0)))
    return df.select(*[_c(c) for c in keep or []], *[e.alias(n) for n, e in sorted(named.items())])


def unpivot(df: DataFrame, agg_cols: list[str], col_name: str, value_name: str) -> DataFrame:
    """Wide to long; the columns come as keys, value, name."""
    values = [c for c in df.columns if c not in agg_cols]
    return df.unpivot(agg_cols, values, col_name, value_name).select(*[_c(c) for c in agg_cols], value_name, col_name)


def impute(df: DataFrame, numeric: list[str], categorical: list[str], numeric_how: str = "mean", categorical_how: str = "most_frequent", fill_value: float | str | None = None) -> DataFrame:
    """Missing numbers by mean, median, most frequent value or a constant; missing texts by the most frequent (smallest on ties) or a constant.

    All statistics come from one aggregation for numbers and one pass for each column that needs its most frequent value.
    """
    df = nulls_for_missing(df)
    fills: dict[str, Column] = {}
    if numeric_how in ("mean", "median"):
        found = aggregate(df, {c: F.avg(_c(c)) for c in numeric}) if numeric_how == "mean" else medians(df, numeric)
        fills |= {c: F.lit(v) for c, v in found.items() if v is not None}
    wanted = [c for c, how in [*((c, numeric_how) for c in numeric), *((c, categorical_how) for c in categorical)] if how == "most_frequent"]
    fills |= {c: F.lit(v) for c, v in most_frequent(df, wanted).items() if v is not None}
    for c, how in [*((c, numeric_how) for c in numeric), *((c, categorical_how) for c in categorical)]:
        if how == "constant":
            fills[c] = F.lit(fill_value)
    types = dict(df.dtypes)
    kinds = {c: "double" if c in numeric and types[c] != "double" and numeric_how in ("mean", "median") else types[c] for c in fills}
    return df.withColumns({c: F.coalesce(_c(c).cast(kinds[c]), v.cast(kinds[c])) for c, v in fills.items()})


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: q for c, (q,) in quantiles(df, {c: [0.5] for c in cols}).items()}


def most_frequent(df: DataFrame, cols: list[str]) -> dict:
    """The value that occurs most in each column, the smallest of equals; null where there is none."""
    out: dict = {}
    for c in cols:
        row = df.filter(_c(c).isNotNull()).groupBy(_c(c).alias("v")).count().orderBy(F.desc("count"), "v").first()
        out[c] = row["v"] if row else None
    return out


def format_master(df: DataFrame, id_col: str, churn_col: str = "churn", null_threshold: float = 99) -> tuple[DataFrame, dict]:
    """The first step on a raw customer table: names, numbers, same names, empty columns, rows without id, churn flag, id first; and its columns by kind."""
    id_col, churn_col = standardise_name(id_col), standardise_name(churn_col)
    named = standardise_names(df)
    single = [c for c in named.columns if named.columns.count(c) == 1]
    if len(single) == len(named.columns):
        named = convert_to_float(named)
    else:  # columns of a shared name are merged as they are
        parts = named.toDF(*[c if c in single else f"{i}|{c}" for i, c in enumerate(named.columns)])
        done = convert_to_float(parts.select(*map(_c, single)))
        kinds = dict(done.dtypes)
        strings = dict(parts.dtypes)
        named = parts.select(*[(to_float(_c(c)) if strings[c] == "string" else _c(c).cast("double")).alias(c) if c in single and kinds[c] == "double" else _c(c).alias(c.partition("|")[2] or c) for c in parts.columns])
    out = merge_same_names(named)
    out = drop_null_columns(out, null_threshold).na.drop(subset=[id_col])
    out = id_first(churn_flag(out, churn_col) if churn_col in out.columns else out, id_col)
    return out, type_dictionary(out, id_col)


def encode(df: DataFrame, types: dict) -> dict[str, DataFrame]:
    """Views of one table: encoded, original, numerical, categorical and one-hot categorical columns, ids as text."""
    id_col = types["customer_id_col"]
    numeric, text = types["numerical_features"], types["categorical_features"]
    with_id = cast_id(df, id_col)
    hot = one_hot(with_id, text, keep=[id_col])
    numerical = merge_same_names(with_id.select(_c(id_col), *map(_c, numeric)))
    values = [c for c in hot.columns if c != id_col]
    encoded = merge_same_names(one_hot(with_id, text, keep=[id_col, *numeric])) if values else numerical
    return {"mdt_encoded": encoded, "original": df, "numerical": numerical, "categorical": merge_same_names(with_id.select(_c(id_col), *map(_c, text))), "categorical_encoded": hot}


def useful_columns(df: DataFrame, id_col: str, useful: list[str], targets: list[str]) -> DataFrame:
    return select_cols(df, [id_col, *useful, *targets])


def row_aggregate(df: DataFrame, features: dict[str, dict]) -> DataFrame:
    """New columns from others of the same row: sum, mean, min, max, count, median or std over the values that aren't null; a sum of none is 0."""
    out = {}
    for name, how in features.items():
        cols = [_c(c).cast("double") for c in how["agg_cols"]]
        some = F.array_compact(F.array(*cols))
        total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
        n = F.size(some)
        mean = F.when(n > 0, total / n)
        kinds = {"sum": total, "mean": mean, "min": F.array_min(some), "max": F.array_max(some), "count": n.cast("bigint")}
        if how["agg_type"] == "std":
            spread = F.aggregate(some, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
            kinds["std"] = F.when(n > 1, F.sqrt(spread / (n - 1)))
        if how["agg_type"] == "median":
            ordered = F.array_sort(some)
            kinds["median"] = F.when(n > 0, (F.element_at(ordered, F.floor((n + 1) / 2).cast("int")) + F.element_at(ordered, F.floor(n / 2 + 1).cast("int"))) / 2)
        if how["agg_type"] not in kinds:
            raise ValueError(f"agg_type {how['agg_type']!r} is not known")
        out[name] = kinds[how["agg_type"]]
    return df.withColumns(out)
