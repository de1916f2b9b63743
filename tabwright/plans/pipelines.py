"""The three chains of operators: model input, feature selection, model selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import cleaning, models, stats
from tabwright.operators.joins import join_rankings
from tabwright.operators.neighbour_information import neighbour_information
from tabwright.operators.outliers import outlier_detection


def model_input(raw: DataFrame, id_col: str, imputation: dict | None = None, drop_churned: bool = True, embedding: dict | None = None, outliers: dict | None = None) -> dict[str, DataFrame]:
    """Format, impute (churned customers count), drop churned customers, embed, encode, and take outliers of the encoded table out."""
    df, types = cleaning.format_master(raw, id_col)
    df = cleaning.impute(df, types["numerical_features"], types["categorical_features"], **(imputation or {}))
    active, churned = cleaning.filter_churned(df, types["customer_id_col"], apply=drop_churned)
    if embedding:
        before = set(active.columns)
        active, _ = models.embed(active, embedding, types["customer_id_col"])
        types = types | {"numerical_features": types["numerical_features"] + [c for c in active.columns if c not in before]}
    out = cleaning.encode(active, types) | {"churned_ids": churned}
    if outliers:
        kept, removed, _ = outlier_detection(out["mdt_encoded"], outliers["cols"], outliers["filt_quantile"], types["customer_id_col"])
        out |= {"without_outliers": kept, "outliers": removed}
    return out


def feature_selection(encoded: DataFrame, id_col: str, targets: dict[str, list[str]], params: dict) -> DataFrame:
    """The final ranking: variance, pairwise filters and mutual information choose useful features; shadow features and models vote on all.

    ``mutual_information`` may be "neighbours": the estimate by nearest neighbours for targets of classes, instead of counts of bins."""
    names = stats.business_targets(targets)
    features = [c for c in encoded.columns if c not in {id_col, *names}]
    varied = [c for c in stats.scaled_variance_filter(encoded, features, id_col, names, params.get("variance", 0.0)) if c not in {id_col, *names}]
    votes = []
    for key, how in params["correlation_filters"].items():
        problem = "classification_targets" if "cat" in key.replace("to", "/").split("/")[1] else "regression_targets"
        categorical = params.get("categorical", [])
        own = stats.candidate_features(varied, categorical, [c for c in varied if c not in categorical], how.get("dataset", "mdt_encoded"), id_col, names, params.get("fundamentals"))
        votes += [stats.pairwise_votes(encoded, own, t, how["statistical_test"], how["corr_method"], how["corr_threshold"]) for t in targets.get(problem, [])]
    pairwise = join_rankings("feature", *votes)
    methods = list(dict.fromkeys(h["corr_method"] for h in params["correlation_filters"].values()))
    kept = [r.feature for r in stats.filtered_pairwise(pairwise, targets, methods).orderBy("place").collect()]
    by_neighbours = params.get("mutual_information") == "neighbours"
    information = lambda t, classes: neighbour_information(encoded, kept, t) if by_neighbours and classes else stats.mutual_information(encoded, kept, t, classes=classes)
    tests = [stats.top_percent(information(t, p == "classification_targets"), "mi", params.get("percentile_to_keep", 50), f"stat_test_mutual_info_tgt_{t}") for p, ts in targets.items() for t in ts] if kept else []
    useful = [r.feature for r in stats.useful_features(join_rankings("feature", *tests)).collect()] if tests else kept
    more = []
    for problem, ts in targets.items():
        classes = problem == "classification_targets"
        for t in ts:
            more += [models.boruta(encoded, features, t, d, classes, rounds=params.get("boruta_rounds")) for d in params.get("tree_depths", [])]
            more += [models.model_votes(encoded, features, t, m, classes) for m in params.get("models", {}).get(problem, [])]
    matrix = join_rankings("feature", pairwise, *tests, *more)
    typed = stats.feature_types(matrix, params.get("categorical", []), [c for c in features if c not in params.get("categorical", [])], params.get("fundamentals"))
    return stats.final_ranking(typed, targets, useful, params.get("number_of_features_threshold"), params.get("ranking_threshold"))


def model_selection(encoded: DataFrame, ranking: DataFrame, id_col: str, params: dict) -> tuple[DataFrame, dict]:
    """Reports of clusterings over growing sets of the ranked features, best first, and the best one's parameters."""
    ranked = [r.feature for r in ranking.orderBy(F.desc("final_rank"), F.desc("feature")).collect()]
    features = list(dict.fromkeys([*params.get("must_have_features", []), *ranked]))
    reports = models.optimise_clusterings(encoded, params["models"], features, params["min_num_features"], id_col, params["metric_weighting"], params["invert_metric_value"], min_clusters=params["min_clusters"], max_clusters=params["max_clusters"])
    return reports, models.best_report(reports)
