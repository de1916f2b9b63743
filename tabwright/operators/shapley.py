"""Shapley values of tree models: exact, path-dependent, for every row, with Spark's own forests."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import models, stats
from tabwright.operators.registry import load_object
from tabwright.operators.trees import boosted, tree_nodes
from tabwright.written import cut

#: Leaves that are broadcast at once: a forest of more of them passes the rows group by group of its trees. One tree fits the driver, which fitted it.
GROUP_LEAVES = 50_000


@dataclass
class Leaf:
    """A leaf's value for each class (one for a regression), and what its path asks of each feature: an interval (above low, up to high) or a
    set of categories, with the share of rows that go the same way where the feature isn't known."""

    values: np.ndarray
    share: float  # of the tree's rows that end here
    features: list[int] = field(default_factory=list)
    lows: list[float] = field(default_factory=list)
    highs: list[float] = field(default_factory=list)
    sets: list[np.ndarray | None] = field(default_factory=list)
    shares: list[float] = field(default_factory=list)


def _classes(model) -> int:
    """Outputs of a model: a probability for each class, or one number (a regression's, or a boosted classifier's margin)."""
    return 1 if boosted(model) else getattr(model, "numClasses", 1)


def leaves(nodes: list, classes: int) -> list[Leaf]:
    """The leaves of one tree, from its node rows."""
    of = {n.id: n for n in nodes}
    size = lambda n: sum(n.stats) if classes > 1 else n.stats[0]
    out, stack = [], [(of[0], Leaf(np.zeros(0), 1.0))]
    while stack:
        node, path = stack.pop()
        if node.left < 0:
            values = np.array(node.stats) / max(sum(node.stats), 1e-300) if classes > 1 else np.array([node.prediction])
            path.values = values * node.weight
            out.append(path)
            continue
        for side, child in ((0, of[node.left]), (1, of[node.right])):
            share = size(child) / size(node)
            features, lows, highs, sets, shares = (list(x) for x in (path.features, path.lows, path.highs, path.sets, path.shares))
            if node.feature not in features:
                features.append(node.feature)
                lows.append(-math.inf)
                highs.append(math.inf)
                sets.append(None)
                shares.append(1.0)
            i = features.index(node.feature)
            shares[i] *= share
            if node.categories < 0:
                lows[i], highs[i] = (lows[i], min(highs[i], node.split[0])) if side == 0 else (max(lows[i], node.split[0]), highs[i])
            else:
                left = np.array(node.split)
                ways = left if side == 0 else np.setdiff1d(np.arange(float(node.categories)), left)
                sets[i] = ways if sets[i] is None else np.intersect1d(sets[i], ways)
            stack.append((child, Leaf(np.zeros(0), path.share * share, features, lows, highs, sets, shares)))
    return out


def subset_weights(met: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """(rows, features) Shapley values of a leaf of value 1, from whether each of its features' conditions is met (rows, features).

    A set S of known features gives the leaf the weight of the product of met conditions in S and of shares outside. Over all S without i these
    products, by the size of S, are the coefficients of the polynomial whose factors are share + met * t; sizes have the weights k! (d - 1 - k)! / d!.
    """
    rows, d = met.shape
    weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
    out = np.zeros((rows, d))
    for i in range(d):
        c = np.zeros((rows, d))
        c[:, 0] = 1.0
        for j in range(d):
            if j != i:
                c[:, 1:] = c[:, 1:] * shares[j] + c[:, :-1] * met[:, j : j + 1]
                c[:, 0] *= shares[j]
        out[:, i] = (c @ weight) * (met[:, i] - shares[i])
    return out


def _add_leaf(total: np.ndarray, x: np.ndarray, leaf: Leaf) -> None:
    """Add a leaf's part to (rows, classes, features) values. Rows that meet the same conditions share one polynomial."""
    d = len(leaf.features)
    if not d:
        return
    met = np.stack([(x[:, f] > lo) & (x[:, f] <= hi) if ways is None else np.isin(x[:, f], ways) for f, lo, hi, ways in zip(leaf.features, leaf.lows, leaf.highs, leaf.sets)], 1)
    kinds, which = np.unique(met @ (1 << np.arange(d, dtype=np.int64)), return_inverse=True)
    parts = subset_weights((kinds[:, None] >> np.arange(d) & 1).astype(float), np.array(leaf.shares))[which]
    for c, value in enumerate(leaf.values.tolist()):
        if value:
            total[:, c, leaf.features] += parts * value


def _explain(held, classes: int, n_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, before = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float) for c in ("_x", "_shap"))
            total = before.reshape(-1, classes, n_features).copy()
            for leaf in held.value:
                _add_leaf(total, x.reshape(-1, n_features), leaf)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * classes * n_features, pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_x"), lists], ["_row", "_x", "_shap"])

    return run


def shapley_values(model, df: DataFrame, cols: list[str], group_leaves: int = GROUP_LEAVES) -> tuple[DataFrame, list[float]]:
    """``df`` with ``_shap``, an array of arrays: for each class (a regression has one) the value of each column; and the classes' mean outputs.

    Values of a row add up to its output less the mean output: the probabilities of a tree or forest of classes, the number of a regression,
    the margin of boosted classes. What a tree gives where a column isn't known follows the shares of its training rows (path-dependent).
    ``model`` is a fitted tree model whose vectors were assembled from ``cols``. Trees are broadcast in groups of about ``group_leaves``
    leaves, and each group adds to the rows as they pass: no shuffle, whatever the forest's size. Rows that lack a column have null.
    """
    classes, n = _classes(model), len(cols)
    spark = df.sparkSession
    by_tree: dict[int, list] = {}
    for r in tree_nodes(model).collect():  # a fitted model has already been on the driver
        by_tree.setdefault(r.tree, []).append(r)
    groups: list[list[Leaf]] = [[]]
    for _, nodes in sorted(by_tree.items()):
        own = leaves(nodes, classes)
        if groups[-1] and len(groups[-1]) + len(own) > group_leaves:
            groups.append([])
        groups[-1] += own
    mean = sum((leaf.values * leaf.share for g in groups for leaf in g), np.zeros(classes))
    whole, rest = models.split_complete(df, cols)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    rows = whole.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), x.alias("_x"), F.array_repeat(F.lit(0.0), classes * n).alias("_shap"))
    for g in groups:
        rows = rows.mapInArrow(_explain(spark.sparkContext.broadcast(g), classes, n), rows.schema)
    by_class = F.array(*[F.slice("_shap", 1 + c * n, n) for c in range(classes)])
    out = rows.select("_row.*", by_class.alias("_shap"))
    return out.unionByName(rest.withColumn("_shap", F.lit(None).cast("array<array<double>>"))), mean.tolist()


def shapley_importance(df: DataFrame, cols: list[str], target: str, classes: bool = False, model: dict | None = None, descriptions: dict[str, str] | None = None, seed: int = 1) -> DataFrame:
    """(feature, value, description, order): the mean absolute Shapley value of each column, summed over the classes, and its place from 0.

    ``model`` names a tree model by class and kwargs, a random forest by default; it is fitted to the rows that have the target. Rows that lack a
    column are left out of both; ties are ordered by name."""
    params = model or {"class": "RandomForestClassifier" if classes else "RandomForestRegressor", "kwargs": {"random_state": seed}}
    data = cut(models.split_complete(df.select(target, *cols), cols)[0])
    fitted = load_object(params, featuresCol="_features", labelCol="_label").fit(models.labelled(data, cols, target, classes))
    values, _ = shapley_values(fitted, data, cols)
    of = lambda i: F.aggregate("_shap", F.lit(0.0), lambda s, c: s + F.abs(c[i]))
    means = values.agg(*[F.avg(of(i)).alias(f"v{i}") for i in range(len(cols))]).first()
    ranked = sorted(range(len(cols)), key=lambda i: (-(means[i] or 0.0), cols[i]))
    rows = [(cols[i], float(means[i] or 0.0), (descriptions or {}).get(cols[i]), place) for place, i in enumerate(ranked)]
    return stats.frame(df.sparkSession, rows, "feature string, value double, description string, order int")
