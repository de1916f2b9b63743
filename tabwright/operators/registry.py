"""Estimators by name from an allow-list: configuration can choose among them, and import nothing else."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml import classification, clustering, feature, regression

# Names that configurations use, and their parameters' names in Spark ML.
ESTIMATORS: dict[str, Callable[..., Any]] = {
    "KMeans": clustering.KMeans, "BisectingKMeans": clustering.BisectingKMeans, "GaussianMixture": clustering.GaussianMixture,
    "RandomForestClassifier": classification.RandomForestClassifier, "RandomForestRegressor": regression.RandomForestRegressor,
    "DecisionTreeClassifier": classification.DecisionTreeClassifier, "DecisionTreeRegressor": regression.DecisionTreeRegressor,
    "LogisticRegression": classification.LogisticRegression, "LinearRegression": regression.LinearRegression,
    "StandardScaler": feature.StandardScaler, "MinMaxScaler": feature.MinMaxScaler, "PCA": feature.PCA,
}
ALIASES = {"sklearn.mixture.GaussianMixture": "GaussianMixture", "sklearn.decomposition.PCA": "PCA", "sklearn.linear_model.LogisticRegression": "LogisticRegression", "sklearn.linear_model.Lasso": "LinearRegression", "Lasso": "LinearRegression"}
PARAMETERS = {"n_clusters": "k", "n_components": "k", "random_state": "seed", "n_estimators": "numTrees", "max_depth": "maxDepth", "max_iter": "maxIter", "min_samples_leaf": "minInstancesPerNode", "C": "regParam", "alpha": "regParam", "l1_ratio": "elasticNetParam"}
#: Parameters that say nothing about the result, and are left out.
IGNORED = {"n_jobs", "verbose"}


def load_object(params: dict, **more: Any) -> Any:
    """``{"class": name, "kwargs": {...}}`` to an estimator. A dotted name stands for its last part; a parameter that the estimator has no counterpart for is an error.

    ``penalty`` "l1" and "l2" stand for the ends of ``elasticNetParam``, and C is the inverse of ``regParam``."""
    name = params["class"]
    short = ALIASES.get(name, name.rpartition(".")[2])
    if short not in ESTIMATORS:
        raise ValueError(f"{name} is not among the known estimators: {sorted(ESTIMATORS)}")
    kwargs = {k: v for k, v in (params.get("kwargs") or {}).items() if k not in IGNORED and v is not None}
    if (penalty := kwargs.pop("penalty", None)) is not None:
        if penalty not in ("l1", "l2"):
            raise ValueError(f"penalty {penalty!r} is not known")
        kwargs["elasticNetParam"] = float(penalty == "l1")
    if "C" in kwargs:
        kwargs["C"] = 1.0 / kwargs["C"]
    if name.rpartition(".")[2] == "Lasso":
        kwargs = {"elasticNetParam": 1.0, "alpha": 1.0} | kwargs
    kwargs = {PARAMETERS.get(k, k): v for k, v in kwargs.items()}
    made = ESTIMATORS[short](**more)
    if unknown := [k for k in kwargs if not made.hasParam(k)]:
        raise ValueError(f"{name} has no counterpart of {unknown}")
    return made.setParams(**kwargs)
