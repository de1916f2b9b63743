"""Queries that fit models. Values that depend on a fit have no SQL; the ``planted`` queries have a known outcome in the data, which SQL states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import cleaning, models, plots, shapley, svd, trees
from tabwright.plans import pipelines
from tabwright.queries.base import master, query, rounded
from tabwright.session import table

_COLS = ["c_acctbal", "n_orders", "total_spend", "avg_spend", "max_spend"]


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.impute(master(spark, sf_dir), _COLS, [])


@query()
def kmeans_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, _ = models.train_with_elbow(_numbers(spark, sf_dir).select("customer_id", *_COLS), _COLS, 2, 7)
    return labelled.select("customer_id", "cluster")


@query()
def pca_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = models.embed(_numbers(spark, sf_dir).select("customer_id", *_COLS), {"spend": {"columns_to_embed": _COLS[1:], "model": {"kwargs": {"n_components": 2}}}}, "customer_id")
    return out.select("customer_id", "component_0_spend", "component_1_spend")


@query()
def forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.importances(_numbers(spark, sf_dir), _COLS, "c_mktsegment")


@query()
def boruta_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.boruta(_numbers(spark, sf_dir), _COLS, "churn", 3)


@query()
def lasso_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.model_votes(_numbers(spark, sf_dir), _COLS[:4], "max_spend", {"class": "Lasso", "kwargs": {"alpha": 0.1}}, classes=False)


@query()
def permutation_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.permutation_importance(_numbers(spark, sf_dir), _COLS[:4], "max_spend", classes=False)


@query()
def clustering_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"KMeans": {"class": "KMeans", "kwargs": {"random_state": 1}}, "BisectingKMeans": {"class": "BisectingKMeans", "kwargs": {"random_state": 1}}}
    weights = {"sillhouette_score": 0.5, "calinski_harabasz_score": 0.25, "davies_bouldin_score": 0.25}
    return models.optimise_clusterings(_numbers(spark, sf_dir), kinds, _COLS, 2, "customer_id", weights, ["davies_bouldin_score"], min_clusters=2, max_clusters=5)


@query()
def bayesian_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.optimise_classifier(_numbers(spark, sf_dir), _COLS, "churn", "customer_id", "DecisionTreeClassifier", {"max_depth": (1, 5), "ccp_alpha": (0.0, 0.02)}, fixed={"class_weight": "balanced"})


@query("""WITH b AS (SELECT min(l_quantity) AS a, max(l_quantity) AS z FROM lineitem), n AS (SELECT least(floor((l_quantity - a) / ((z - a) / 20)), 19)::INTEGER AS bin, count(*) AS n FROM lineitem, b GROUP BY 1)
SELECT range::INTEGER AS bin, round(a + range * ((z - a) / 20), 4) AS low, round(a + (range + 1) * ((z - a) / 20), 4) AS high, coalesce(n, 0) AS n FROM range(20), b LEFT JOIN n ON bin = range""")
def histogram_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(plots.histogram(table(spark, sf_dir, "lineitem"), "l_quantity"))


@query()
def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = master(spark, sf_dir).withColumn("churn", F.col("churn").cast("string"))
    encoded = pipelines.model_input(raw, "customer_id", drop_churned=False)["mdt_encoded"]
    params = {"correlation_filters": {"num_to_cat": {"statistical_test": "f_classif", "corr_method": "pearson", "corr_threshold": 0.9}}, "models": {"classification_targets": [{"class": "RandomForestClassifier", "kwargs": {"random_state": 1}}]}, "number_of_features_threshold": 5}
    return pipelines.feature_selection(encoded, "customer_id", {"classification_targets": ["churn"]}, params)


@query()
def shapley_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapley.shapley_importance(_numbers(spark, sf_dir), _COLS[:4], "max_spend", descriptions={"c_acctbal": "balance"})


@query("SELECT c_custkey AS customer_id, 0.0::DOUBLE AS gap_0, 0.0::DOUBLE AS gap_1 FROM customer")
def shapley_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer and class the values add up to the forest's probability less its mean."""
    data = models.assemble(_numbers(spark, sf_dir).select("customer_id", "churn", *_COLS), _COLS)
    fitted = models.load_object({"class": "RandomForestClassifier", "kwargs": {"n_estimators": 5, "random_state": 1}}, featuresCol="_features", labelCol="churn").fit(data)
    values, mean = shapley.shapley_values(fitted, fitted.transform(data).select("customer_id", *_COLS, models.vector_to_array("probability").alias("p")), _COLS)
    gap = lambda c: F.abs(F.round(F.aggregate(F.col("_shap")[c], F.lit(0.0), lambda s, v: s + v) + mean[c] - F.col("p")[c], 8)).alias(f"gap_{c}")
    return values.select("customer_id", gap(0), gap(1))


# ---- a known outcome in every row of customer: groups far apart, one column that decides the target, and columns of noise ----
_GROUP, _Y = "(c_custkey % 3)", "(c_acctbal > 4500)::INTEGER"


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal").cast("double")
    noise = [(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(10_007)) / 10_007).alias(f"noise{i}") for i in range(3)]
    far = [((key % 3 == i).cast("double") * 1000 + balance / 1000).alias(f"far{i}") for i in range(3)]
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), (key % 3).cast("int").alias("grp"), balance.alias("signal"), (balance > 4500).cast("int").alias("y"), (3 * balance + 1).alias("z"), *noise, *far)


_NOISE = ["noise0", "noise1", "noise2"]


@query(f"SELECT {_GROUP}::INTEGER AS grp, count(*) AS n, 1::BIGINT AS clusters FROM customer GROUP BY 1")
def kmeans_elbow_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elbow is at the three groups, and each is one cluster."""
    labelled, k = models.train_with_elbow(_planted(spark, sf_dir), ["far0", "far1", "far2"], 2, 7)
    own = labelled.groupBy("grp").agg(F.count("*").alias("n"), F.countDistinct("cluster").alias("clusters"))
    return own if k == 3 and labelled.select("cluster").distinct().count() == 3 else own.limit(0)


@query(f"SELECT c_custkey AS customer_id, round(sqrt(2.0) * abs(c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 4) AS size, 1.0::DOUBLE AS explained FROM customer")
def pca_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns on one line: the first component is the distance along it, up to its sign, and explains all."""
    out, explained = models.embed(_planted(spark, sf_dir).select("customer_id", "signal", "z"), {"line": {"columns_to_embed": ["signal", "z"], "model": {"class": "PCA", "kwargs": {"n_components": 1}}, "scaler": {"class": "StandardScaler"}}}, "customer_id")
    return rounded(out.select("customer_id", F.abs("component_0_line").alias("size"), F.lit(explained["line"]).alias("explained")))


@query("""WITH g AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0 END AS a, CASE WHEN c_custkey % 3 = 1 THEN c_acctbal ELSE 0 END AS b FROM customer),
n AS (SELECT sqrt(10 * sum(a * a)) AS one, sqrt(sum(b * b)) AS two FROM g)
SELECT c_custkey AS customer_id, round(sqrt(10.0) * abs(a), 4) AS first, round(abs(b), 4) AS second, round(one, 2) AS value_1, round(two, 2) AS value_2 FROM g, n""")
def svd_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse columns a, 3 a and b that are never filled together: the components are the length of (a, 3 a) and b, up to signs."""
    part = lambda i: F.when(F.col("customer_id") % 3 == i, F.col("signal")).otherwise(0.0)
    df = _planted(spark, sf_dir).select("customer_id", part(0).alias("a"), (3 * part(0)).alias("c"), part(1).alias("b"), F.lit(0).alias("none"))
    found, values, _ = svd.truncated_svd(df, ["a", "b", "none", "c"], 2)
    out = [F.abs(F.col("components")[i]).alias(c) for i, c in enumerate(("first", "second"))]
    return rounded(found.select("customer_id", *out)).withColumns({f"value_{i + 1}": F.round(F.lit(float(v)), 2) for i, v in enumerate(values)})


@query("SELECT 'signal' AS feature, 1::INTEGER AS vote UNION ALL SELECT unnest(['noise0', 'noise1', 'noise2']), 0")
def boruta_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = models.boruta(_planted(spark, sf_dir), ["signal", *_NOISE], "y", 3)
    return votes.select("feature", F.col(votes.columns[1]).alias("vote"))


@query("SELECT 'signal' AS feature")
def importances_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.importances(_planted(spark, sf_dir), ["signal", *_NOISE], "y").limit(1).select("feature")


@query("SELECT 'signal' AS feature")
def permutation_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.permutation_importance(_planted(spark, sf_dir), ["signal", *_NOISE], "y").limit(1).select("feature")


_BITS = "(c_acctbal > 4500)::INTEGER AS a, (c_custkey % 3 = 0)::INTEGER AS b"


@query(f"""WITH c AS (SELECT c_custkey, {_BITS} FROM customer), f AS (SELECT *, 10.0 * a + b + 2 * a * b AS z FROM c),
g AS (SELECT avg(z) AS mean, avg(z) FILTER (a = 1) AS a1, avg(z) FILTER (a = 0) AS a0, avg(a) AS share FROM f),
v AS (SELECT c_custkey, z, mean, CASE WHEN a = 1 THEN a1 ELSE a0 END AS by_a, share * (10 + 3 * b) + (1 - share) * b AS by_b FROM f, g)
SELECT c_custkey AS customer_id, round(((by_a - mean) + (z - by_b)) / 2, 4) AS a, round(((by_b - mean) + (z - by_a)) / 2, 4) AS b, 0.0::DOUBLE AS noise0 FROM v""")
def shapley_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree learns 10 a + b + 2 a b by splitting at a, then at b: the values of each customer follow from the sizes of the groups."""
    df = _planted(spark, sf_dir).select("customer_id", F.col("y").alias("a"), (F.col("customer_id") % 3 == 0).cast("int").alias("b"), "noise0")
    df = df.withColumn("z", 10.0 * F.col("a") + F.col("b") + 2 * F.col("a") * F.col("b"))
    cols = ["a", "b", "noise0"]
    fitted = models.load_object({"class": "DecisionTreeRegressor", "kwargs": {"max_depth": 3}}, featuresCol="_features", labelCol="z").fit(models.assemble(df, cols))
    values, _ = shapley.shapley_values(fitted, df.select("customer_id", *cols), cols)
    return rounded(values.select("customer_id", *[F.col("_shap")[0][i].alias(c) for i, c in enumerate(cols)]))


@query("SELECT 'signal' AS feature, 1::INTEGER AS l1, 1::INTEGER AS l2 UNION ALL SELECT unnest(['noise0', 'noise1', 'noise2']), 0, 0")
def model_votes_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An L1 penalty leaves the noise no weight, and under an L2 penalty it lies below the mean."""
    df = _planted(spark, sf_dir)
    unit = models.scale(df, models.fit_scaler(df, ["signal", "z", *_NOISE]))
    both = [models.model_votes(unit, ["signal", *_NOISE], t, m, c).withColumnRenamed(f"mb_{t}_{m['class']}", n) for n, t, m, c in (
        ("l1", "z", {"class": "Lasso", "kwargs": {"alpha": 0.3}}, False), ("l2", "y", {"class": "LogisticRegression", "kwargs": {"penalty": "l2", "C": 100.0}}, True))]
    return both[0].join(both[1], "feature")


@query("SELECT c_custkey AS customer_id, (c_acctbal > 4500)::INTEGER::DOUBLE AS prediction, 2::INTEGER AS leaves FROM customer")
def pruned_tree_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the labels is wrong: a deep tree follows them, and pruning leaves the one split that tells the classes apart."""
    df = _planted(spark, sf_dir).withColumn("a", F.col("y").cast("double")).withColumn("_label", F.when(F.col("customer_id") % 10 == 0, 1.0 - F.col("a")).otherwise(F.col("a")))
    vectors = models.assemble(df, ["noise0", "a", "noise1", "noise2"])
    fitted = trees.fit_classifier(vectors, {"class": "DecisionTreeClassifier", "kwargs": {"max_depth": 6, "ccp_alpha": 0.01, "class_weight": "balanced"}})
    return fitted.transform(vectors).select("customer_id", "prediction", F.lit(fitted.tree.leaves).alias("leaves"))


@query(f"SELECT fold::INTEGER AS fold, y, (n // 3 + (fold < n % 3)::INTEGER)::BIGINT AS n FROM (SELECT {_Y} AS y, count(*) AS n FROM customer GROUP BY 1), range(3) r(fold)")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.folds(_planted(spark, sf_dir), "customer_id", 3, "y").groupBy(F.col("_fold").alias("fold"), "y").agg(F.count("*").alias("n"))


@query("SELECT 'KMeans' AS model, 3::INTEGER AS num_clusters, ['far0', 'far1'] AS features")
def model_selection_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best report of a search over growing sets of the ranked features: two of the three far columns tell all groups apart."""
    ranking = spark.createDataFrame([("far0", 9), ("far1", 8), ("noise0", 1)], "feature string, final_rank int").orderBy("feature")
    params = {"models": {"KMeans": {"class": "KMeans", "kwargs": {"random_state": 1}}}, "must_have_features": ["far0", "far1"], "min_num_features": 2, "min_clusters": 2, "max_clusters": 6, "metric_weighting": {"sillhouette_score": 1.0}, "invert_metric_value": []}
    _, best = pipelines.model_selection(_planted(spark, sf_dir).select("customer_id", "far0", "far1", "noise0"), ranking, "customer_id", params)
    return spark.createDataFrame([(best["class"], best["kwargs"]["n_clusters"], best["features"])], "model string, num_clusters int, features array<string>")
