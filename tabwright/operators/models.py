"""Fitted steps with Spark ML: scaling, embedding, clustering with a search for k, model and shadow-feature votes, explanation, tuning."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import clusters, stats, svd, trees
from tabwright.operators.cleaning import aggregate
from tabwright.operators.registry import load_object
from tabwright.written import cut

#: Rows of a block whose columns are shuffled for shadow features; a step's least importance in a sparse linear model.
SHADOW_BLOCK, LEAST_WEIGHT = 5_000, 1e-5
#: Parts that the rows of a class are ranked in.
FOLD_PARTS = 1_024


def _d(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    """(shift, scale) by column: mean and population deviation, or least value and range; a constant column has scale 1."""
    if kind not in ("standard", "minmax"):
        raise ValueError("kind must be standard or minmax")
    parts = (F.avg, F.stddev_pop) if kind == "standard" else (F.min, lambda c: F.max(c) - F.min(c))
    found = aggregate(df, {f"{i}{c}": f(_d(c)) for c in cols for i, f in enumerate(parts)})
    return {c: (found[f"0{c}"] or 0.0, found[f"1{c}"] or 1.0) for c in cols}


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (_d(c) - a) / b for c, (a, b) in scaler.items()})


def assemble(df: DataFrame, cols: list[str], out: str = "_features") -> DataFrame:
    """The columns as one vector; a row that lacks one is an error, not a row less."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def split_complete(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that have all of the columns, the others); NaN counts as missing."""
    has = reduce(lambda a, b: a & b, [_d(c).isNotNull() & ~F.isnan(_d(c)) for c in cols], F.lit(True))
    return df.filter(has), df.filter(~has)


def embed(df: DataFrame, groups: dict[str, dict], id_col: str) -> tuple[DataFrame, dict[str, float | None]]:
    """For each group of columns the components of the model that it names (PCA by default, TruncatedSVD, or a feature step with an output column) as
    ``component_i_name``, and the share of variance they explain, to 3 digits, or None if the model has no such share.

    TruncatedSVD takes the scaled columns as they are, sparse where they are zero. Columns are centred and scaled by the named scaler first (``StandardScaler`` or ``MinMaxScaler``); signs are arbitrary. Rows that lack
    a column have null components."""
    explained = {}
    for name, how in groups.items():
        cols, params = how["columns_to_embed"], {"class": "PCA"} | how["model"]
        params["kwargs"] = {"n_components": 2} | (params.get("kwargs") or {})
        scaler = how.get("scaler") or {}
        kind = scaler.get("kind") or {"StandardScaler": "standard", "MinMaxScaler": "minmax"}[scaler.get("class", "StandardScaler").rpartition(".")[2]]
        whole, _ = split_complete(df.select(id_col, *cols), cols)
        scaled, k = scale(whole, fit_scaler(whole, cols, kind)), params["kwargs"]["n_components"]
        if params["class"].rpartition(".")[2] == "TruncatedSVD":
            found, values, share = svd.truncated_svd(scaled, cols, k, "_embedded")
            parts, k = F.col("_embedded"), len(values)
        else:
            vectors = assemble(scaled, cols)
            step = load_object(params, inputCol="_features", outputCol="_embedded")
            model = step.fit(vectors) if hasattr(step, "fit") else step
            share = getattr(model, "explainedVariance", None)
            share = None if share is None else float(sum(share))
            found, parts = model.transform(vectors), vector_to_array("_embedded")
        explained[name] = None if share is None else round(share, 3)
        df = df.join(found.select(id_col, *[parts[i].alias(f"component_{i}_{name}") for i in range(k)]), id_col, "left")
    return df, explained


def elbow(ks: list[int], costs: list[float]) -> int | None:
    """The k whose cost lies farthest below the line from the first to the last, both axes scaled to [0, 1]; none if no one does."""
    if len(ks) < 3 or costs[0] == costs[-1]:
        return None
    x = (np.array(ks) - ks[0]) / (ks[-1] - ks[0])
    y = (np.array(costs) - costs[-1]) / (costs[0] - costs[-1])
    below = (1 - x) - y
    return ks[int(below.argmax())] if below.max() > 1e-9 else None


def cluster_costs(df: DataFrame, cols: list[str], ks: list[int], seed: int = 1) -> list[float]:
    """Summed squared distances of k-means for each k: one fit each over one written table of vectors."""
    vectors = cut(assemble(df, cols).select("_features"))
    return [KMeans(k=k, seed=seed, featuresCol="_features").fit(vectors).summary.trainingCost for k in ks]


def train_with_elbow(df: DataFrame, cols: list[str], min_clusters: int, max_clusters: int, cluster_col: str = "cluster", num_clusters: int | None = None, model: dict | None = None, scaler: str = "standard", seed: int = 1) -> tuple[DataFrame, int]:
    """Scaled columns clustered with the k at the elbow of [min, max), with max if there is none, or with a given k. The table keeps its own
    columns and gets the label; rows that lack a column don't count and have none."""
    df, rest = split_complete(df, cols)
    fitted = fit_scaler(df, cols, scaler)
    scaled = scale(df.select(*[F.col(f"`{c}`") for c in df.columns], *[_d(c).alias(f"_s_{i}") for i, c in enumerate(cols)]), {f"_s_{i}": fitted[c] for i, c in enumerate(cols)})
    names = [f"_s_{i}" for i in range(len(cols))]
    if num_clusters is None:
        ks = list(range(min_clusters, max_clusters))
        num_clusters = elbow(ks, cluster_costs(scaled, names, ks, seed)) or max_clusters
    params = model or {"class": "KMeans", "kwargs": {"random_state": seed}}
    estimator = load_object({"class": params["class"], "kwargs": (params.get("kwargs") or {}) | {"n_clusters": num_clusters}}, featuresCol="_features", predictionCol=cluster_col)
    vectors = assemble(scaled, names)
    labelled = estimator.fit(vectors).transform(vectors).select(*[F.col(f"`{c}`") for c in df.columns], cluster_col)
    return labelled.unionByName(rest.withColumn(cluster_col, F.lit(None).cast("int"))), num_clusters


class ClusterModel:
    """A scaler and a fitted clustering of named columns, to label further tables."""

    def __init__(self, scaler: dict[str, tuple[float, float]], fitted, features: list[str], cluster_col: str):
        self.scaler, self.fitted, self.features, self.cluster_col = scaler, fitted, features, cluster_col

    def infer(self, df: DataFrame) -> DataFrame:
        """The table with its clusters; rows that lack a feature have none."""
        df, rest = split_complete(df, self.features)
        inner = {f"_s_{i}": self.scaler[c] for i, c in enumerate(self.features)}
        scaled = scale(df.select("*", *[_d(c).alias(n) for n, c in zip(inner, self.features)]), inner)
        labelled = self.fitted.transform(assemble(scaled, list(inner))).select(*[F.col(f"`{c}`") for c in df.columns], self.cluster_col)
        return labelled.unionByName(rest.withColumn(self.cluster_col, F.lit(None).cast("int")))


def train_cluster_model(df: DataFrame, params: dict) -> tuple[ClusterModel, DataFrame]:
    """The clustering that ``class`` and ``kwargs`` name, on scaled ``features``, and the table with its ``cluster_col``."""
    features = params["features"]
    whole, _ = split_complete(df, features)
    scaler = fit_scaler(whole, features, (params.get("scaler_params") or {}).get("kind", "standard"))
    vectors = assemble(scale(whole.select(*[_d(c).alias(c) for c in features]), scaler), features)
    fitted = load_object(params, featuresCol="_features", predictionCol=params["cluster_col"]).fit(vectors)
    model = ClusterModel(scaler, fitted, features, params["cluster_col"])
    return model, model.infer(df)


def train_models(df: DataFrame, models: dict[str, dict], cols: list[str], id_col: str, weights: dict[str, float], inverted: list[str], **how) -> tuple[str, DataFrame, DataFrame]:
    """Each model's clusters and metrics; the best model's name, its own table, and the ranking."""
    tables, rows = {}, []
    for name, params in models.items():
        labelled, k = train_with_elbow(df.select(id_col, *cols), cols, model=params, **how)
        tables[name] = labelled
        rows.append((name, k, *clusters.cluster_metrics(labelled, how.get("cluster_col", "cluster"), id_col).values()))
    ranking = clusters.metrics_ranking(df.sparkSession.createDataFrame(rows, "model string, num_clusters int, sillhouette_score double, calinski_harabasz_score double, davies_bouldin_score double"), weights, inverted)
    best = ranking.first()["model"]
    return best, tables[best], ranking


def optimise_clusterings(df: DataFrame, models: dict[str, dict], ranked: list[str], least: int, id_col: str, weights: dict[str, float], inverted: list[str], **how) -> DataFrame:
    """Reports of each model on the first i features for i from ``least`` up to one fewer than all (the full set is never tried, a quirk that is kept), best first."""
    rows = []
    for name, params in models.items():
        for i in range(least, len(ranked)):
            cols = ranked[:i]
            labelled, k = train_with_elbow(df.select(id_col, *cols), cols, model=params, **how)
            rows.append((name, k, cols, *clusters.cluster_metrics(labelled, how.get("cluster_col", "cluster"), id_col).values()))
    schema = "model string, num_clusters int, features array<string>, sillhouette_score double, calinski_harabasz_score double, davies_bouldin_score double"
    return clusters.metrics_ranking(df.sparkSession.createDataFrame(rows, schema), weights, inverted)


def best_report(reports: DataFrame) -> dict:
    """The parameters and features of the best report; a tie goes to fewer features, then by name."""
    row = reports.orderBy(F.col("final_score").desc_nulls_last(), F.size("features"), "model").first()
    return {"class": row["model"], "kwargs": {"n_clusters": row["num_clusters"]}, "features": list(row["features"])}


def labelled(df: DataFrame, cols: list[str], target: str, classes: bool) -> DataFrame:
    out = assemble(df.filter(F.col(f"`{target}`").isNotNull()), cols)
    if not classes:
        return out.withColumn("_label", _d(target))
    text = out.withColumn("_text", F.col(f"`{target}`").cast("string"))
    return StringIndexer(inputCol="_text", outputCol="_label", stringOrderType="alphabetAsc").fit(text).transform(text)


def importances(df: DataFrame, cols: list[str], target: str, classes: bool = True, model: dict | None = None, seed: int = 1) -> DataFrame:
    """(feature, importance) of a random forest, or of another model with importances or coefficients, largest first."""
    params = model or {"class": "RandomForestClassifier" if classes else "RandomForestRegressor", "kwargs": {"random_state": seed}}
    fitted = load_object(params, featuresCol="_features", labelCol="_label").fit(labelled(df, cols, target, classes))
    if hasattr(fitted, "featureImportances"):
        values = fitted.featureImportances.toArray()
    else:
        matrix = fitted.coefficientMatrix.toArray() if hasattr(fitted, "coefficientMatrix") else fitted.coefficients.toArray()[None, :]
        values = np.abs(matrix).sum(0)
    return stats.frame(df.sparkSession, [(c, float(v)) for c, v in zip(cols, values)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def model_votes(df: DataFrame, cols: list[str], target: str, model: dict, classes: bool = True) -> DataFrame:
    """(feature, mb_target_model): 1 for importances of the mean at least, or, in a model with an L1 penalty, for weights above a small one."""
    short, kwargs = model["class"].rpartition(".")[2], model.get("kwargs") or {}
    rows = importances(df, cols, target, classes, model).collect()
    sparse = "Lasso" in short or kwargs.get("penalty") == "l1" or (kwargs.get("elasticNetParam") or 0) > 0
    floor = LEAST_WEIGHT if sparse else sum(r.importance for r in rows) / max(len(rows), 1)
    return stats.frame(df.sparkSession, [(r.feature, int(r.importance >= floor)) for r in rows], f"feature string, `mb_{target}_{short}` int")


def with_shadows(df: DataFrame, cols: list[str], seed: int) -> DataFrame:
    """Each column again as ``shadow_i``, its values permuted within blocks of about SHADOW_BLOCK rows.

    Rows are numbered and written once, and dealt into blocks by their numbers: equal rows don't meet, and a block that is computed again
    comes out the same."""
    rows = cut(df.withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, -(-rows.count() // SHADOW_BLOCK))
    parts = rows.withColumn("_b", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)))
    held = parts.groupBy("_b").agg(F.sort_array(F.collect_list(F.struct("_row", *[F.col(f"`{c}`") for c in df.columns]))).alias("rows"))
    own = lambda c: F.transform("rows", lambda r: r[c].cast("double"))
    mixed = [F.shuffle(own(c), seed * 1000 + i).alias(f"shadow_{i}") for i, c in enumerate(cols)]
    zipped = held.select("rows", *mixed).select(F.explode(F.arrays_zip("rows", *[f"shadow_{i}" for i in range(len(cols))])).alias("x"))
    return zipped.select(*[F.col("x.rows")[c].alias(c) for c in df.columns], *[f"x.shadow_{i}" for i in range(len(cols))])


def _binomial_tail(hits: int, n: int) -> float:
    return sum(math.comb(n, k) for k in range(hits, n + 1)) / 2**n


def boruta(df: DataFrame, cols: list[str], target: str, depth: int, classes: bool = True, rounds: int | None = None, trees: int = 20, alpha: float = 0.05, seed: int = 1) -> DataFrame:
    """(feature, vote): 1 for the confirmed features of Boruta (Kursa and Rudnicki, 2010).

    Each round fits a forest to the features still in play and their permuted copies; a feature scores if it beats the best copy. With
    Bonferroni's correction, it is confirmed once it has scored significantly often, and leaves as rejected once significantly seldom. The
    rest go on for ``rounds``, by default 8 more than the fewest that can confirm anything; what is tentative then has no vote, and fewer
    rounds than can confirm are an error.
    """
    least = math.ceil(math.log2(max(len(cols), 1) / alpha))
    rounds = least + 8 if rounds is None else rounds
    if rounds < least:
        raise ValueError(f"{len(cols)} features take {least} rounds at least")
    hits, confirmed, rejected = dict.fromkeys(cols, 0), set(), set()
    kind = "RandomForestClassifier" if classes else "RandomForestRegressor"
    base = cut(df.select(target, *cols).filter(F.col(f"`{target}`").isNotNull()))
    for i in range(rounds):
        left = [c for c in cols if c not in rejected]
        if not left or len(confirmed) == len(left):
            break
        names = [*left, *(f"shadow_{j}" for j in range(len(left)))]
        model = {"class": kind, "kwargs": {"n_estimators": trees, "max_depth": depth, "random_state": seed + i}}
        found = {r.feature: r.importance for r in importances(with_shadows(base.select(target, *left), left, seed + i), names, target, classes, model).collect()}
        best = max(v for k, v in found.items() if k.startswith("shadow_"))
        for c in left:
            hits[c] += found[c] > best
            if _binomial_tail(hits[c], i + 1) <= alpha / len(cols):
                confirmed.add(c)
            elif c not in confirmed and _binomial_tail(i + 1 - hits[c], i + 1) <= alpha / len(cols):
                rejected.add(c)
    return stats.frame(df.sparkSession, [(c, int(c in confirmed)) for c in cols], f"feature string, `boruta_target_{target}_depth_{depth}` int")


def tree_rules(df: DataFrame, cols: list[str], cluster_col: str, depth: int = 3) -> str:
    """A small decision tree over the cluster labels, as text with the columns' names."""
    fitted = load_object({"class": "DecisionTreeClassifier", "kwargs": {"max_depth": depth}}, featuresCol="_features", labelCol="_label").fit(labelled(df, cols, cluster_col, True))
    text = fitted.toDebugString
    for i in range(len(cols) - 1, -1, -1):
        text = text.replace(f"feature {i} ", f"{cols[i]} ")
    return text


def permutation_importance(df: DataFrame, cols: list[str], target: str, classes: bool = True, seed: int = 1) -> DataFrame:
    """(feature, importance): how much a random forest's score falls when a column is permuted; see ``shapley.shapley_importance`` for exact shares of each row's prediction."""
    data = cut(with_shadows(labelled(df.select(target, *cols), cols, target, classes).select(target, *cols, "_label"), cols, seed))
    kind = "RandomForestClassifier" if classes else "RandomForestRegressor"
    fitted = load_object({"class": kind, "kwargs": {"random_state": seed}}, featuresCol="_features", labelCol="_label").fit(assemble(data, cols))
    score = lambda names: fitted.transform(assemble(data, names)).agg(F.avg((F.col("prediction") == F.col("_label")).cast("double")) if classes else -F.avg(F.pow(F.col("prediction") - F.col("_label"), 2))).first()[0]
    whole = score(cols)
    rows = [(c, float(whole - score([*cols[:i], f"shadow_{i}", *cols[i + 1 :]]))) for i, c in enumerate(cols)]
    return stats.frame(df.sparkSession, rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def folds(df: DataFrame, id_col: str, k: int, target: str | None = None) -> DataFrame:
    """``_fold`` of each row: every class of ``target`` is dealt out evenly, in the order of the ids' hashes.

    Rows are ranked within parts of a class; how many rows the parts before have comes from counts by part, so no class meets in one task."""
    y = F.col(f"`{target}`").cast("string") if target else F.lit(None).cast("string")
    parts = df.withColumn("_y", y).withColumn("_h", F.xxhash64(F.col(f"`{id_col}`"))).withColumn("_part", F.pmod(F.shiftrightunsigned("_h", 32), F.lit(FOLD_PARTS)))
    before = Window.partitionBy("_y").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_y", "_part").count().select(F.col("_y").alias("_y2"), F.col("_part").alias("_part2"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    placed = parts.join(offsets, F.col("_y").eqNullSafe(F.col("_y2")) & (F.col("_part") == F.col("_part2")))
    rank = F.row_number().over(Window.partitionBy("_y", "_part").orderBy("_h", F.col(f"`{id_col}`")))
    return placed.withColumn("_fold", F.pmod(F.col("_before") + rank - 1, F.lit(k)).cast("int")).select(*[F.col(f"`{c}`") for c in df.columns], "_fold")


def cross_validated_f1(df: DataFrame, cols: list[str], target: str, id_col: str, model: dict, k: int = 3) -> float:
    """Mean over stratified folds of F1 weighted by predictions."""
    data, total = cut(folds(labelled(df, cols, target, True).select(id_col, target, *cols, "_label"), id_col, k, target)), 0.0
    data = assemble(data, cols)
    for i in range(k):
        fitted = trees.fit_classifier(data.filter(F.col("_fold") != i), model)
        total += stats.weighted_f1_by_prediction(fitted.transform(data.filter(F.col("_fold") == i)), "_label", "prediction").first()[0] or 0.0
    return total / k


def bayesian_search(score: Callable[[dict], float], bounds: dict[str, tuple[float, float]], first: int = 4, rounds: int = 8, seed: int = 1) -> list[dict]:
    """Trials of a search for the largest score: random points, then those of the largest expected improvement under a Gaussian process. Each trial may be a Spark job; the process itself has a point a trial."""
    rng, names = np.random.default_rng(seed), list(bounds)
    lo, hi = (np.array([bounds[n][i] for n in names], float) for i in (0, 1))
    xs, ys = [], []

    def tried(u: np.ndarray) -> None:
        xs.append(u)
        ys.append(float(score(dict(zip(names, (lo + u * (hi - lo)).tolist())))))

    for _ in range(first):
        tried(rng.random(len(names)))
    kernel = lambda a, b: np.exp(-((a[:, None] - b[None]) ** 2).sum(-1) / (2 * 0.25**2))
    for _ in range(rounds):
        x, y = np.array(xs), np.array(ys)
        mean, spread = y.mean(), y.std() or 1.0
        inverse = np.linalg.inv(kernel(x, x) + 1e-4 * np.eye(len(x)))
        c = rng.random((512, len(names)))
        cross = kernel(c, x)
        mu = cross @ inverse @ ((y - mean) / spread)
        sd = np.sqrt(np.maximum(1e-12, 1 - np.einsum("ij,jk,ik->i", cross, inverse, cross)))
        z = (mu - (y.max() - mean) / spread) / sd
        density, below = np.exp(-(z**2) / 2) / math.sqrt(2 * math.pi), np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])
        tried(c[int((sd * (z * below + density)).argmax())])
    return [dict(zip(names, (lo + u * (hi - lo)).tolist())) | {"score": s} for u, s in zip(xs, ys)]


#: Parameters of a search that are whole numbers; the others are shares or penalties.
_WHOLE = {"max_depth", "n_estimators", "min_samples_split", "min_samples_leaf"}


def optimise_classifier(df: DataFrame, cols: list[str], target: str, id_col: str, kind: str = "RandomForestClassifier", bounds: dict[str, tuple[float, float]] | None = None, k: int = 3, fixed: dict | None = None, **how) -> DataFrame:
    """(trial, parameters, score, best) of a search over a tree model's parameters for the best cross-validated F1.

    ``bounds`` may name what ``trees.fit_classifier`` knows: max_depth, n_estimators, max_samples, max_features, min_samples_split, ccp_alpha;
    ``fixed`` parameters hold in all trials, such as class_weight "balanced"."""
    bounds = bounds or {"max_depth": (2, 8), "n_estimators": (5, 40)}
    typed = lambda p: {n: int(round(v)) if n in _WHOLE else float(v) for n, v in p.items()}
    usable = {n: b for n, b in bounds.items() if kind != "DecisionTreeClassifier" or n != "n_estimators"}
    trials = bayesian_search(lambda p: cross_validated_f1(df, cols, target, id_col, {"class": kind, "kwargs": typed(p) | {"random_state": 1} | (fixed or {})}, k), usable, **how)
    best = max(t["score"] for t in trials)
    rows = [(i, {n: float(v) for n, v in typed({n: t[n] for n in usable}).items()}, t["score"], t["score"] == best) for i, t in enumerate(trials)]
    return df.sparkSession.createDataFrame(rows, "trial int, parameters map<string,double>, score double, best boolean")


def map_rows(df: DataFrame, f: Callable[[Iterator], Iterator], schema: str, parts: int | None = None) -> DataFrame:
    """A function over pandas batches of all rows, in parallel; for what expressions can't say."""
    return (df.repartition(parts) if parts else df).mapInPandas(f, schema)
