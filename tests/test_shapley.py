import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import models, shapley
from tabwright.operators.registry import load_object


def table(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 3)
    y = x[:, 0] * (x[:, 1] > 0) + 2 * (x[:, 2] > 0.3) + 0.1 * rng.normal(size=n)
    rows = [(i, *map(float, r), float(t), int(t > 0.5) + int(t > 1.5)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, x0 double, x1 double, x2 double, x3 double, x4 double, y double, k int")


COLS = [f"x{i}" for i in range(5)]


def expected(nodes, x, known, classes, i=0):
    """A tree's output where only some columns are known: other splits go both ways by the training rows' shares."""
    n = nodes[i]
    if n.left < 0:
        return (np.array(n.stats) / sum(n.stats) if classes > 1 else np.array([n.prediction])) * n.weight
    if n.feature in known:
        left = x[n.feature] <= n.split[0] if n.categories < 0 else x[n.feature] in n.split
        return expected(nodes, x, known, classes, n.left if left else n.right)
    size = lambda m: sum(m.stats) if classes > 1 else m.stats[0]
    return sum(size(nodes[c]) / size(n) * expected(nodes, x, known, classes, c) for c in (n.left, n.right))


def brute(trees, x, classes):
    d, out = len(x), np.zeros((classes, len(x)))
    value = lambda s: sum(expected(t, x, s, classes) for t in trees)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for s in combinations(others, k):
                out[:, i] += math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) * (value({*s, i}) - value(set(s)))
    return out


@pytest.mark.parametrize("name,kwargs,target,classes,group", [
    ("DecisionTreeRegressor", {"max_depth": 4}, "y", 1, 1000), ("RandomForestRegressor", {"n_estimators": 3, "max_depth": 4, "random_state": 1}, "y", 1, 10),
    ("RandomForestClassifier", {"n_estimators": 3, "max_depth": 4, "random_state": 1}, "k", 3, 1000), ("GBTRegressor", {"n_estimators": 3, "max_depth": 3}, "y", 1, 1),
])
def test_values_against_all_subsets(spark, name, kwargs, target, classes, group):
    df = table(spark)
    vectors = models.assemble(df, COLS)
    try:
        params = load_object({"class": name, "kwargs": kwargs}, featuresCol="_features", labelCol=target)
    except (TypeError, ValueError, AttributeError, KeyError):
        from pyspark.ml.regression import GBTRegressor

        params = GBTRegressor(featuresCol="_features", labelCol=target, maxIter=3, maxDepth=3)
    fitted = params.fit(vectors)
    trees: dict = {}
    for r in shapley.tree_nodes(fitted).collect():
        trees.setdefault(r.tree, {})[r.id] = r
    some = df.filter("id < 12")
    values, mean = shapley.shapley_values(fitted, some, COLS, group_leaves=group)
    of_all = {r.id: r for r in fitted.transform(models.assemble(some, COLS)).select("id", *(["prediction"] if classes == 1 else ["prediction", vector_to_array("probability").alias("p")])).collect()}
    for r in values.collect():
        x = [r[c] for c in COLS]
        assert np.allclose(np.array(r._shap), brute(list(trees.values()), x, classes), atol=1e-9)
        want = [of_all[r.id].prediction] if classes == 1 else of_all[r.id].p
        assert np.allclose(np.array(r._shap).sum(1) + mean, want, atol=1e-9)


def test_categories_and_missing_columns(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(i, "abcde"[i % 5], float(i % 4), float((i % 5 in (1, 3)) * 3 + i % 4)) for i in range(200)], "id int, c string, x1 double, y double")
    df = StringIndexer(inputCol="c", outputCol="x0", stringOrderType="alphabetAsc").fit(df).transform(df)
    fitted = load_object({"class": "DecisionTreeRegressor", "kwargs": {"max_depth": 5}}, featuresCol="_features", labelCol="y").fit(models.assemble(df, ["x0", "x1"]))
    nodes = {r.id: r for r in shapley.tree_nodes(fitted).collect()}
    assert any(n.categories > 0 for n in nodes.values())
    odd = df.limit(8).unionByName(df.limit(1).withColumn("x1", F.lit(None).cast("double")))
    values, _ = shapley.shapley_values(fitted, odd, ["x0", "x1"])
    rows = values.collect()
    assert sum(r._shap is None for r in rows) == 1
    for r in rows:
        if r._shap is not None:
            assert np.allclose(np.array(r._shap), brute([nodes], [r.x0, r.x1], 1), atol=1e-9)


def test_importance_ranks_what_the_target_is_made_of(spark):
    out = shapley.shapley_importance(table(spark), COLS, "y", descriptions={"x2": "a step"}).collect()
    by = {r.feature: r for r in out}
    assert by["x2"].order == 0 and by["x2"].description == "a step" and {by["x3"].order, by["x4"].order} == {3, 4}
    classes = shapley.shapley_importance(table(spark), COLS, "k", classes=True).collect()
    assert sorted(r.order for r in classes) == list(range(5)) and next(r.feature for r in classes if r.order == 0) == "x2"


def test_a_tree_without_splits_explains_nothing(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)], "id int, x0 double, y double")
    fitted = load_object({"class": "DecisionTreeRegressor", "kwargs": {}}, featuresCol="_features", labelCol="y").fit(models.assemble(df, ["x0"]))
    values, mean = shapley.shapley_values(fitted, df, ["x0"])
    assert mean == [1.0] and {tuple(r._shap[0]) for r in values.collect()} == {(0.0,)}
