"""Steps that are fitted on one table and applied to others, as Spark ML estimators and models over named columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import outliers
from tabwright.operators.cleaning import medians, most_frequent, nulls_for_missing
from tabwright.operators.cleaning import aggregate as _aggregate
from tabwright.operators.dictionaries import DataDict
from tabwright.operators.models import fit_scaler, scale


class SelectColumns(Transformer):
    """Only these columns, in their order; a missing one is an error."""

    def __init__(self, features: Iterable[str]):
        super().__init__()
        self.features = list(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if absent := [c for c in self.features if c not in dataset.columns]:
            raise KeyError(f"columns {absent} are not in the table")
        return dataset.select(*[F.col(f"`{c}`") for c in self.features])

    def get_feature_names(self) -> list[str]:
        return list(self.features)


class BoundsModel(Model):
    """Outlier bounds found at fitting."""

    def __init__(self, bounds: dict, method: str):
        super().__init__()
        self.bounds, self.method = bounds, method

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return outliers.range_outliers(dataset, self.bounds, self.method)


class RangeOutliers(Estimator):
    """Fixed bounds by column."""

    def __init__(self, bounds: dict, method: str = "set_nan"):
        super().__init__()
        self.bounds, self.method = bounds, method

    def _fit(self, dataset: DataFrame) -> BoundsModel:
        return BoundsModel(self.bounds, self.method)


class QuantileOutliers(Estimator):
    """Bounds at quantiles of the training table, in one aggregation; with ``multiplier`` that many interquartile ranges beyond them."""

    def __init__(self, quantiles: dict, method: str = "set_nan", multiplier: float = 0.0):
        super().__init__()
        self.quantiles, self.method, self.multiplier = quantiles, method, multiplier

    def _fit(self, dataset: DataFrame) -> BoundsModel:
        if any(not 0 <= lo <= hi <= 1 for lo, hi in self.quantiles.values()):
            raise ValueError("quantiles must be within [0, 1] and ordered")
        found = outliers.quantile_bounds(dataset, self.quantiles)
        wide = {c: (None, None) if lo is None else (lo - self.multiplier * (hi - lo), hi + self.multiplier * (hi - lo)) for c, (lo, hi) in found.items()}
        return BoundsModel(wide, self.method)


class FillModel(Model):
    def __init__(self, fills: dict):
        super().__init__()
        self.fills = fills

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df, types = nulls_for_missing(dataset), dict(dataset.dtypes)
        kind = lambda c, v: "double" if isinstance(v, float) and types[c] != "string" else types[c]
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast(kind(c, v)), F.lit(v).cast(kind(c, v))) for c, v in self.fills.items() if c in df.columns and v is not None})


class Imputer(Estimator):
    """Missing values by the training table's mean, median or most frequent value, or by a constant."""

    def __init__(self, features: Iterable[str], strategy: str = "mean", fill_value=None):
        super().__init__()
        if strategy not in ("mean", "median", "most_frequent", "constant"):
            raise ValueError(f"strategy {strategy!r} is not known")
        self.features, self.strategy, self.fill_value = list(features), strategy, fill_value

    def _fit(self, dataset: DataFrame) -> FillModel:
        df = nulls_for_missing(dataset)
        if self.strategy == "constant":
            return FillModel(dict.fromkeys(self.features, self.fill_value))
        if self.strategy == "most_frequent":
            return FillModel(most_frequent(df, self.features))
        return FillModel(_aggregate(df, {c: F.avg(F.col(f"`{c}`")) for c in self.features}) if self.strategy == "mean" else medians(df, self.features))


class ScaleModel(Model):
    def __init__(self, scaler: dict):
        super().__init__()
        self.scaler = scaler

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return scale(dataset, self.scaler)


class Scaler(Estimator):
    def __init__(self, features: Iterable[str], kind: str = "standard"):
        super().__init__()
        self.features, self.kind = list(features), kind

    def _fit(self, dataset: DataFrame) -> ScaleModel:
        return ScaleModel(fit_scaler(dataset, self.features, self.kind))


#: The steps that configuration can name.
STEPS = {"RangeOutliers": RangeOutliers, "QuantileOutliers": QuantileOutliers, "Imputer": Imputer, "SimpleImputer": Imputer, "Scaler": Scaler, "StandardScaler": Scaler}


def fit_transformer(train: DataFrame, params: dict, features: list[str] | None = None) -> Model:
    """The step that ``class`` names, with ``transformer_kwargs``, fitted on the training table. A target column, if named, must be there."""
    if "class" not in params:
        raise ValueError("params must name a class")
    short = params["class"].rpartition(".")[2]
    if short not in STEPS:
        raise ValueError(f"{params['class']} is not among the known steps: {sorted(STEPS)}")
    target = params.get("target_variable_col")
    if target and target not in train.columns:
        raise KeyError(f"target {target} is not in the table")
    kwargs = dict(params.get("transformer_kwargs") or {})
    if features and STEPS[short] in (Imputer, Scaler):
        kwargs["features"] = features
    return STEPS[short](**kwargs).fit(train)


def apply_fitted(model: Transformer, df: DataFrame, features: list[str] | None = None, drop_other_features: bool = False) -> DataFrame:
    """The transformed table, with all its columns or only the named ones."""
    out = model.transform(df)
    return out.select(*[F.col(f"`{c}`") for c in features]) if features and drop_other_features else out


def apply_to_all(model: Transformer, params: dict, *dfs: DataFrame) -> list[DataFrame]:
    return [apply_fitted(model, df, **params) for df in dfs]


def features_to_impute(params: dict, data_dict: DataDict) -> list[str]:
    """The named features, or the dictionary's of the kind."""
    kinds = {"numeric": ["int", "float"], "categorical": ["str"]}
    if params["data_type"] not in kinds:
        raise ValueError("only numeric or categorical data can be imputed")
    return params["features"] if params.get("features") is not None else data_dict.features(kinds[params["data_type"]])


def cols_to_skip(data_dict: DataDict) -> list[str]:
    key = data_dict.variable("key")
    return [key] if key else []


def model_input_sets(inputs: dict | None) -> list[str]:
    """train_data and test_data, which must be there, and valid_data if it is."""
    if inputs is None:
        return ["train_data", "test_data"]
    if absent := [s for s in ("train_data", "test_data") if s not in inputs]:
        raise ValueError(f"inputs lack {absent}; valid_data is optional")
    return [s for s in ("train_data", "test_data", "valid_data") if inputs.get(s)]
