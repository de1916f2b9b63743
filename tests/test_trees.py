import copy
import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import models, trees


def grown(rng, depth):
    """A random tree whose children's rows add up."""

    def node(rows, d):
        a = rng.randrange(rows + 1)
        stats = [float(a), float(rows - a)]
        gini = 1 - sum((s / rows) ** 2 for s in stats)
        made = trees.Node(stats, rows, gini)
        if d and rows > 4 and rng.random() < 0.85:
            k = rng.randrange(1, rows)
            made.left, made.right = node(k, d - 1), node(rows - k, d - 1)
            made.stats = [x + y for x, y in zip(made.left.stats, made.right.stats)]
            made.impurity = 1 - sum((s / rows) ** 2 for s in made.stats)
        return made

    return node(120, depth)


def subtrees(node):
    """(cost, leaves) of every subtree with the same root."""
    out = [(node.impurity * sum(node.stats), 1)]
    if node.left is not None:
        out += [(a + b, m + n) for a, m in subtrees(node.left) for b, n in subtrees(node.right)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_pruned_trees_cost_least_of_all_subtrees(seed):
    tree = grown(random.Random(seed), 4)
    every, total, before = subtrees(tree), sum(tree.stats), None
    for alpha in (0.0, 0.001, 0.005, 0.02, 0.1, 1.0):
        own = copy.deepcopy(tree)
        trees.prune(own, alpha)
        least = min(c / total + alpha * n for c, n in every)
        assert own.cost / total + alpha * own.leaves == pytest.approx(least, abs=1e-12)
        assert own.leaves == min(n for c, n in every if c / total + alpha * n <= least + 1e-12)
        assert before is None or own.leaves <= before
        before = own.leaves
    assert before == 1


def data(spark, n=600):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        x = [round(rng.random(), 3) for _ in range(3)]
        rows.append((i, *x, float((x[0] > 0.8) != (rng.random() < 0.1))))
    return models.assemble(spark.createDataFrame(rows, "id int, a double, b double, c double, _label double"), ["a", "b", "c"])


def test_size_falls_with_alpha_and_labels_follow_the_tree(spark):
    df, sizes = data(spark), []
    plain = trees.fit_classifier(df, {"class": "DecisionTreeClassifier", "kwargs": {"max_depth": 6}})
    for alpha in (1e-9, 0.002, 0.01, 0.5):
        fitted = trees.fit_classifier(df, {"class": "DecisionTreeClassifier", "kwargs": {"max_depth": 6, "ccp_alpha": alpha}})
        sizes.append(fitted.tree.leaves)
        if alpha == 1e-9:
            same = plain.transform(df).select("id", F.col("prediction").alias("p")).join(fitted.transform(df).select("id", "prediction"), "id")
            assert same.filter("p <> prediction").count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[2] >= 2 and sizes[3] == 1


def test_least_rows_of_a_split(spark):
    def inner(node):
        return [] if node.left is None else [node.rows, *inner(node.left), *inner(node.right)]

    fitted = trees.fit_classifier(data(spark), {"class": "DecisionTreeClassifier", "kwargs": {"max_depth": 6, "min_samples_split": 80}})
    assert inner(fitted.tree) and min(inner(fitted.tree)) >= 80


def test_balanced_classes_and_shares(spark):
    df = data(spark)
    weights = {r._label: (r.w, r.n) for r in trees.with_balanced_weights(df, "_label").groupBy("_label").agg(F.sum("_weight").alias("w"), F.count("*").alias("n")).collect()}
    assert weights[0.0][0] == pytest.approx(300) and weights[1.0][0] == pytest.approx(300) and weights[0.0][1] > weights[1.0][1]
    found = {}
    for name, kwargs in {"plain": {}, "balanced": {"class_weight": "balanced"}}.items():
        fitted = trees.fit_classifier(df, {"class": "DecisionTreeClassifier", "kwargs": {"max_depth": 1, "max_features": 0.4, "random_state": 1} | kwargs})
        found[name] = fitted.transform(df).filter("prediction = 1").count()
    assert found["balanced"] >= found["plain"]
    forest = trees.fit_classifier(df, {"class": "RandomForestClassifier", "kwargs": {"n_estimators": 3, "max_features": 0.5, "max_samples": 0.5, "class_weight": "balanced", "random_state": 1}})
    assert forest.getOrDefault("subsamplingRate") == 0.5 and forest.getOrDefault("featureSubsetStrategy") == "0.5"
    for kwargs in ({"ccp_alpha": 0.1}, {"class_weight": "odd"}):
        with pytest.raises(ValueError):
            trees.fit_classifier(df, {"class": "RandomForestClassifier", "kwargs": kwargs})


def test_search_over_pruning(spark):
    df = data(spark, 300).drop("_features", "_label").withColumn("y", (F.col("a") > 0.8).cast("int"))
    out = models.optimise_classifier(df, ["a", "b", "c"], "y", "id", "DecisionTreeClassifier", {"max_depth": (1, 4), "ccp_alpha": (0.0, 0.05), "min_samples_split": (2, 30), "max_features": (0.5, 1.0)}, k=2, fixed={"class_weight": "balanced"}, first=2, rounds=1).collect()
    assert len(out) == 3 and max(r.score for r in out) > 0.9 and all(0 <= r.parameters["ccp_alpha"] <= 0.05 for r in out)
