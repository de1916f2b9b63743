"""Classifiers of trees with balanced classes, feature and row shares, least splits and cost-complexity pruning, on top of Spark's."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.registry import load_object
from tabwright.written import own_dir

#: Parameters that this module adds to those of Spark's estimators.
ADDED = ("class_weight", "ccp_alpha", "max_features", "max_samples", "min_samples_split")


def tree_nodes(model, counts: bool = False) -> DataFrame:
    """(tree, id, prediction, stats, left, right, feature, split, categories, weight) of a fitted tree, forest or boosted trees, from the files of the
    saved model; with ``counts`` also the nodes' rows and impurity."""
    spark = SparkSession.active()
    path = f"{own_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    weights = [float(w) for w in getattr(model, "treeWeights", None) or [1.0]]
    total = 1.0 if boosted(model) else sum(weights)
    weight = F.element_at(F.array(*[F.lit(w / total) for w in weights]), F.col("tree") + 1)
    return data.select(
        "tree", "id", "prediction", F.col("impurityStats").alias("stats"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("split"), F.col("split.numCategories").alias("categories"), weight.alias("weight"),
        *([F.col("rawCount").alias("rows"), "impurity"] if counts else []),
    )


def boosted(model) -> bool:
    return type(model).__name__.startswith("GBT")


@dataclass
class Node:
    stats: list[float]  # weighted rows by class
    rows: int
    impurity: float
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None

    @property
    def leaves(self) -> int:
        return 1 if self.left is None else self.left.leaves + self.right.leaves

    @property
    def cost(self) -> float:
        """Impurity times weight of the leaves below."""
        return self.impurity * sum(self.stats) if self.left is None else self.left.cost + self.right.cost

    def cut(self) -> None:
        self.left = self.right = None


def tree_of(model) -> Node:
    """The nodes of a fitted tree of classes with numeric features, or of a forest of one."""
    of = {r.id: r for r in tree_nodes(model, counts=True).collect()}

    def node(i: int) -> Node:
        r = of[i]
        made = Node(list(r.stats), r.rows, r.impurity)
        if r.left >= 0:
            if r.categories >= 0:
                raise ValueError("trees over categories are not pruned")
            made.feature, made.threshold, made.left, made.right = r.feature, r.split[0], node(r.left), node(r.right)
        return made

    return node(0)


def require_rows(tree: Node, least: int) -> None:
    """Nodes of fewer rows become leaves: what growing with that limit gives, as a tree grows from the top."""
    if tree.left is not None:
        if tree.rows < least:
            tree.cut()
        else:
            require_rows(tree.left, least)
            require_rows(tree.right, least)


def prune(tree: Node, alpha: float) -> None:
    """Minimal cost-complexity pruning: the inner node whose leaves save least impurity a leaf is cut, again and again, while that is at most
    ``alpha`` of the whole tree's weight. What is left has the least cost + alpha * leaves of all subtrees, and is the smallest such."""
    total = sum(tree.stats)

    def weakest(node: Node) -> tuple[float, Node] | None:
        if node.left is None:
            return None
        own = (node.impurity * sum(node.stats) - node.cost) / total / (node.leaves - 1)
        return min([(own, node), *filter(None, (weakest(node.left), weakest(node.right)))], key=lambda x: x[0])

    while (found := weakest(tree)) is not None and found[0] <= alpha + 1e-15:
        found[1].cut()


def classify(tree: Node, features: Column) -> Column:
    """The class of a row, an array of its features, as an expression of nested conditions."""
    if tree.left is None:
        return F.lit(float(max(range(len(tree.stats)), key=lambda c: (tree.stats[c], -c))))
    return F.when(features[tree.feature] <= tree.threshold, classify(tree.left, features)).otherwise(classify(tree.right, features))


class PrunedTree:
    """A tree that labels tables as a fitted Spark model does."""

    def __init__(self, tree: Node, features: str, prediction: str):
        self.tree, self.features, self.prediction = tree, features, prediction

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_x", vector_to_array(self.features)).withColumn(self.prediction, classify(self.tree, F.col("_x"))).drop("_x")


def with_balanced_weights(df: DataFrame, label: str, out: str = "_weight") -> DataFrame:
    """Rows weighted so that all classes weigh the same, and all rows together their number."""
    counts = df.groupBy(label).count().collect()
    n, k = sum(r["count"] for r in counts), len(counts)
    weight = reduce(lambda w, r: w.when(F.col(label) == r[label], n / (k * r["count"])), counts, F.when(F.lit(False), 0.0))
    return df.withColumn(out, weight)


def fit_classifier(df: DataFrame, model: dict, features: str = "_features", label: str = "_label", prediction: str = "prediction"):
    """A fitted classifier by class and kwargs, whose ``transform`` adds ``prediction``.

    Besides what ``load_object`` knows: ``class_weight`` "balanced"; ``max_features`` and ``max_samples``, shares in (0, 1] of the features tried at a
    split and of the rows of a tree; for one tree ``min_samples_split``, the least rows of a node that is split, and ``ccp_alpha``, pruning.
    """
    kwargs = dict(model.get("kwargs") or {})
    added = {k: kwargs.pop(k) for k in ADDED if kwargs.get(k) is not None}
    short, more = model["class"].rpartition(".")[2], {"featuresCol": features, "labelCol": label, "predictionCol": prediction}
    if added.get("class_weight") is not None:
        if added["class_weight"] != "balanced":
            raise ValueError(f"class_weight {added['class_weight']!r} is not known")
        df, more = with_balanced_weights(df, label), more | {"weightCol": "_weight"}
    one = short == "DecisionTreeClassifier"
    if not one and (bad := {"ccp_alpha", "min_samples_split"} & added.keys()):
        raise ValueError(f"{short} has no counterpart of {sorted(bad)}")
    share = lambda x: str(min(1.0, max(1e-9, float(x))))
    if "max_features" in added:
        more["featureSubsetStrategy"] = share(added["max_features"]) if float(added["max_features"]) < 1 else "all"
        if one:  # a forest of one tree over all rows
            short, kwargs = "RandomForestClassifier", kwargs | {"n_estimators": 1}
            more |= {"bootstrap": False}
    if "max_samples" in added:
        more["subsamplingRate"] = float(share(added["max_samples"]))
    fitted = load_object({"class": short, "kwargs": kwargs}, **more).fit(df)
    if not {"ccp_alpha", "min_samples_split"} & added.keys():
        return fitted
    tree = tree_of(fitted)
    require_rows(tree, math.ceil(added.get("min_samples_split", 2)))
    if added.get("ccp_alpha", 0.0) > 0:
        prune(tree, added["ccp_alpha"])
    return PrunedTree(tree, features, prediction)
