"""Data and tag dictionaries: validated metadata tables, held on the driver and given out as DataFrames, with the graph of tag dependencies."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.numbers import enforce_schema
from tabwright.operators.cleaning import deduplicate
from tabwright.written import cut

# Kinds of data and marks of the dictionaries.
DATA_TYPES = ("int", "float", "bool", "str", "date", "timestamp")
TAG_KINDS = ("input", "output", "state", "control", "on_off")
TAG_TYPES = ("int64", "object", "int32", "datetime", "float32", "float64", "geometry", "int8", "bool")
MARKS = ("Y", "N", None)
_REQUIRED = ("column_id", "feature_group", "business_name", "data_type")
_TAG_REQUIRED = ("tag", "name", "tag_type", "data_type", "unit", "range_min", "range_max", "on_off_dependencies", "derived")


class DataDictError(Exception):
    """A data dictionary breaks its rules."""


class TagDictError(Exception):
    """A tag dictionary breaks its rules."""


def _rows(data: DataFrame | list[dict]) -> list[dict]:
    """Metadata is one row a column or tag, so it fits the driver; NaN becomes None."""
    rows = data if isinstance(data, list) else [r.asDict() for r in data.collect()]
    return [{k: None if isinstance(v, float) and v != v else v for k, v in r.items()} for r in rows]


def check_required(rows: list[dict], required: tuple[str, ...], error: type[Exception]) -> None:
    if missing := [c for c in required if rows and c not in rows[0]]:
        raise error(f"columns are missing: {missing}")


def check_unique(rows: list[dict], cols: tuple[str, ...], error: type[Exception]) -> None:
    seen: set = set()
    for r in rows:
        key = tuple(r.get(c) for c in cols)
        if key in seen:
            raise error(f"{cols} is not unique: {key}")
        seen.add(key)


def check_legal(rows: list[dict], col: str, error: type[Exception]) -> None:
    """No commas, and no white space at the ends."""
    if bad := [r[col] for r in rows if isinstance(r.get(col), str) and re.search(r",|^\s|\s$", r[col])]:
        raise error(f"{col} holds illegal names: {bad}")


def check_known(rows: list[dict], col: str, known: tuple, error: type[Exception]) -> None:
    if bad := [r.get(col) for r in rows if (r.get(col).lower() if isinstance(r.get(col), str) and known is DATA_TYPES else r.get(col)) not in known]:
        raise error(f"{col} holds unknown values: {bad}")


class _Keyed:
    key: str

    def __init__(self, rows: list[dict]):
        self.rows = rows

    def __contains__(self, key: str) -> bool:
        return any(r[self.key] == key for r in self.rows)

    def __getitem__(self, key: str) -> dict:
        for r in self.rows:
            if r[self.key] == key:
                return r
        raise KeyError(key)

    def keys(self) -> list[str]:
        return [r[self.key] for r in self.rows]

    def select(self, col: str, condition: Any = None) -> list[str]:
        """Keys of rows where the column equals ``condition``, fulfils it, or, with none (0 and "" are none as well), is above 0."""
        def fits(v: Any) -> bool:
            if callable(condition):
                return bool(condition(v))
            return v == condition if condition else v is not None and not isinstance(v, str) and v > 0

        return [r[self.key] for r in self.rows if fits(r[col])]

    def to_dict(self) -> list[dict]:
        return [dict(r) for r in self.rows]

    def to_json(self) -> str:
        return json.dumps(self.rows)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows)


class DataDict(_Keyed):
    """One row a column, with Y marks of features, targets and keys for a use case."""

    key = "column_id"

    def __init__(self, data: DataFrame | list[dict], use_case: str):
        self.use_case = use_case
        super().__init__(_rows(data))
        self.validate()

    def validate(self) -> None:
        marks = tuple(f"{self.use_case}:{m}" for m in ("feature", "target", "key"))
        check_required(self.rows, (*_REQUIRED, *marks), DataDictError)
        check_unique(self.rows, ("column_id",), DataDictError)
        check_legal(self.rows, "column_id", DataDictError)
        check_known(self.rows, "data_type", DATA_TYPES, DataDictError)
        for m in marks:
            check_known(self.rows, m, MARKS, DataDictError)
        if len(self._marked("feature")) < 2:
            raise DataDictError("a use case needs two features at least")
        for m in ("target", "key"):
            if len(self._marked(m)) != 1:
                raise DataDictError(f"a use case needs exactly one {m}")

    def _marked(self, mark: str) -> list[str]:
        return [r["column_id"] for r in self.rows if r.get(f"{self.use_case}:{mark}") == "Y"]

    def features(self, kinds: list[str] | None = None) -> list[str]:
        wanted = None if kinds is None else {k.lower() for k in kinds}
        return [c for c in self._marked("feature") if wanted is None or self[c]["data_type"].lower() in wanted]

    def variable(self, mark: str) -> str | None:
        """The target, key, date or target_switch column; none if no column has the mark."""
        return next(iter(self._marked(mark)), None)

    def name(self, key: str) -> str:
        return self[key].get("business_name") or key

    def add(self, row: dict) -> None:
        """A row with a new key comes in; a known key changes nothing."""
        if row["column_id"] not in self:
            self.rows.append(dict.fromkeys(self.rows[0] if self.rows else row) | row)

    @classmethod
    def from_json(cls, text: str, use_case: str) -> DataDict:
        return cls(json.loads(text), use_case)

    def schema_kinds(self) -> dict[str, str]:
        """Columns of the use case by the kind that ``enforce_schema`` casts to."""
        kind = {"int": "numeric", "float": "numeric", "str": "categorical", "bool": "boolean", "date": "datetime", "timestamp": "datetime"}
        return {r["column_id"]: kind[r["data_type"].lower()] for r in self.rows}


def create_data_dict(data: DataFrame | list[dict], params: dict) -> DataDict:
    return DataDict(data, params["use_case_id"])


def enforce_dictionary_schema(df: DataFrame, data_dict: DataDict) -> DataFrame:
    """The dictionary's features cast to the kinds that it gives them; one that the table lacks is an error."""
    kinds = data_dict.schema_kinds()
    return enforce_schema(df, {c: kinds[c] for c in data_dict.features()})


def deduplicate_by_dictionary(df: DataFrame, data_dict: DataDict, order: list[str] | None = None, keep: str | bool = "first") -> DataFrame:
    """One row of each value of the dictionary's key column."""
    return deduplicate(df, [data_dict.variable("key")], order, keep)


class DependencyGraph:
    """Directed edges from a tag to the tags it depends on."""

    def __init__(self) -> None:
        self.to: dict[str, set[str]] = {}

    def add(self, tag: str, on: str) -> None:
        self.to.setdefault(tag, set()).add(on)

    def remove(self, tag: str, on: str) -> None:
        self.to.get(tag, set()).discard(on)

    @staticmethod
    def _reach(edges: dict[str, set[str]], start: str) -> set[str]:
        seen, todo = set(), [start]
        while todo:
            todo += [n for n in edges.get(todo.pop(), ()) if n not in seen and not seen.add(n)]
        return seen - {start}

    def dependencies(self, tag: str) -> set[str]:
        return self._reach(self.to, tag)

    def dependents(self, tag: str) -> set[str]:
        back: dict[str, set[str]] = {}
        for a, bs in self.to.items():
            for b in bs:
                back.setdefault(b, set()).add(a)
        return self._reach(back, tag)


class TagDict(_Keyed):
    """One row a tag, with the on/off tags that it depends on."""

    key = "tag"

    def __init__(self, data: DataFrame | list[dict]):
        super().__init__(_rows(data))
        self.validate()

    def validate(self) -> None:
        check_required(self.rows, _TAG_REQUIRED, TagDictError)
        for r in self.rows:
            on = r["on_off_dependencies"]
            r["on_off_dependencies"] = [x.strip() for x in on.split(",") if x.strip()] if isinstance(on, str) else list(on or [])
        if bad := [c for c in ("tag", "name", "tag_type", "data_type") if any(r[c] is None for r in self.rows)]:
            raise TagDictError(f"columns are incomplete: {bad}")
        check_unique(self.rows, ("tag", "source"), TagDictError)
        check_unique(self.rows, ("name", "source"), TagDictError)
        check_legal(self.rows, "tag", TagDictError)
        check_known(self.rows, "tag_type", TAG_KINDS, TagDictError)
        check_known(self.rows, "data_type", TAG_TYPES, TagDictError)
        kinds = {r["tag"]: r["tag_type"] for r in self.rows}
        self.graph = DependencyGraph()
        for r in self.rows:
            for on in r["on_off_dependencies"]:
                if kinds.get(on) != "on_off":
                    raise TagDictError(f"{r['tag']} depends on {on}, which is no on_off tag")
                self.graph.add(r["tag"], on)

    def name(self, key: str) -> str:
        return self[key].get("name") or key

    def dependencies(self, tag: str) -> list[str]:
        return sorted(self.graph.dependencies(self[tag]["tag"]))

    def dependents(self, tag: str) -> list[str]:
        return sorted(self.graph.dependents(self[tag]["tag"]))

    def add(self, row: dict) -> None:
        if row["tag"] not in self:
            self.rows.append(dict.fromkeys(self.rows[0] if self.rows else row) | row)
            self.validate()

    def filter(self, conditions: dict[str, Any]) -> TagDict:
        """Only rows that fulfil all conditions: a list of values, or one value."""
        if unknown := [c for c in conditions if self.rows and c not in self.rows[0]]:
            raise KeyError(f"columns are unknown: {unknown}")
        self.rows = [r for r in self.rows if all(r[c] in v if isinstance(v, list) else r[c] == v for c, v in conditions.items())]
        return self

    def change_tag(self, col: str) -> TagDict:
        """Another column becomes the tag."""
        self.rows = [r | {"tag": r[col]} for r in self.rows]
        self.validate()
        return self


def _reached(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) for every tag reached from another, or from itself, over one edge or more: joins by doubling path lengths until nothing is new, each written."""
    paths = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct())
    n = paths.count()
    while True:
        longer = paths.join(paths.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        paths = cut(paths.unionByName(longer).distinct())
        if (m := paths.count()) == n:
            return paths
        n = m


def transitive_closure(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) for every tag reached from another over one edge or more, itself left out."""
    return _reached(edges, a, b).filter("a <> b").select(F.col("a").alias(a), F.col("b").alias(b))


def add_absent(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows whose key is absent come below."""
    return table.unionByName(new.join(table.select(key), key, "left_anti"), allowMissingColumns=True)


def filter_rows(df: DataFrame, col: str, condition: Any = None) -> DataFrame:
    """Rows where the column equals a value, fulfils a function from column to column, or, by default, is above 0."""
    if callable(condition):
        return df.filter(condition(F.col(col)))
    return df.filter(F.col(col) == condition) if condition else df.filter(F.col(col) > 0)


def violations(df: DataFrame, required: list[str], unique: list[str], name: str, known: dict[str, tuple]) -> DataFrame:
    """(rule, n) counted over a dictionary table of any size: nulls, surplus rows of a key, illegal names, unknown values."""
    illegal: Callable[[Column], Column] = lambda c: c.rlike(r",|^\s|\s$")
    aggs = [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in required]
    aggs += [(F.count("*") - F.count_distinct(F.struct(*unique))).alias("surplus"), F.count_if(illegal(F.col(name))).alias("illegal")]
    aggs += [F.count_if(~F.col(c).isin(*v) & F.col(c).isNotNull()).alias(f"unknown:{c}") for c, v in known.items()]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("n")) for c in one.columns])).alias("x")).select("x.*")


def tag_dependencies(tags: DataFrame) -> DataFrame:
    """(tag, dep): one row for each name in the comma lists of ``on_off_dependencies``."""
    return tags.select("tag", F.explode(F.split("on_off_dependencies", ",")).alias("dep")).select("tag", F.trim("dep").alias("dep")).filter("dep <> ''")


def tag_violations(tags: DataFrame) -> DataFrame:
    """(rule, n): how often a tag table of any size breaks the rules of ``TagDict``, a job of joins and aggregates.

    Nulls, illegal and unknown values as in ``violations``; surplus rows of a tag, and of a name, of one source; dependencies on tags that the table
    lacks (``dep_unknown``) and on tags that aren't on_off (``dep_kind``, of a repeated tag the first kind by name); and tags that depend on
    themselves over any number of others (``cycle``). A table without ``source`` has one source."""
    if missing := [c for c in _TAG_REQUIRED if c not in tags.columns]:
        raise TagDictError(f"columns are missing: {missing}")
    tags = tags if "source" in tags.columns else tags.withColumn("source", F.lit(""))
    rules = violations(tags, ["tag", "name", "tag_type", "data_type"], ["tag", "source"], "tag", {"tag_type": TAG_KINDS, "data_type": TAG_TYPES})
    rules = rules.withColumn("rule", F.when(F.col("rule") == "surplus", "surplus:tag").otherwise(F.col("rule")))
    names = tags.agg((F.count("*") - F.count_distinct(F.struct("name", "source"))).alias("n")).select(F.lit("surplus:name").alias("rule"), "n")
    deps = cut(tag_dependencies(tags))
    kinds = tags.filter("tag IS NOT NULL").groupBy(F.col("tag").alias("dep")).agg(F.min("tag_type").alias("kind"), F.lit(True).alias("there"))
    met = deps.join(kinds, "dep", "left").agg(F.count_if(F.col("there").isNull()).alias("u"), F.count_if(F.col("there") & ~F.col("kind").eqNullSafe("on_off")).alias("k"))
    of_deps = met.select(F.explode(F.array(F.struct(F.lit("dep_unknown").alias("rule"), F.col("u").alias("n")), F.struct(F.lit("dep_kind").alias("rule"), F.col("k").alias("n")))).alias("x")).select("x.*")
    cycles = _reached(deps, "tag", "dep").filter("a = b").agg(F.count("*").alias("n")).select(F.lit("cycle").alias("rule"), "n")
    return rules.unionByName(names).unionByName(of_deps).unionByName(cycles)
