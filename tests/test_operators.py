import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import cleaning as C
from tabwright.operators import clusters as K
from tabwright.operators import dictionaries as D
from tabwright.operators import geo as G
from tabwright.operators import joins as J
from tabwright.operators import models as M
from tabwright.operators import outliers as O
from tabwright.operators import plots as P
from tabwright.operators import registry as R
from tabwright.operators import stats as S
from tabwright.operators import timeseries as T


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_outlier_rules_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "id int, x double")
    assert rows(O.range_outliers(df, {"x": (0, 10)}, "drop")) == [(1, 5.0), (2, None)]
    assert rows(O.range_outliers(df, {"x": (6, 10)}, "clip")) == [(1, 6.0), (2, None), (3, 10.0)]
    assert rows(O.apply_outlier_rule(df, "drop", {"x": (None, 10)})) == [(1, 5.0), (2, None), (3, None)]
    for bad in (lambda: O.range_outliers(df, {}, "cut"), lambda: O.quantile_outliers(df, {"x": (0.9, 0.1)}), lambda: O.apply_outlier_rule(df, "mask", {})):
        with pytest.raises(ValueError):
            bad()


def test_one_hot_names_meet(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a-b"), (3, None)], "id int, s string")
    out = C.one_hot(df, ["s"], keep=["id"])
    assert out.columns == ["id", "s_a_b"] and rows(out) == [(1, 1.0), (2, 0.0), (3, 0.0)]
    assert C.one_hot(df, [], keep=["id"]).columns == ["id"]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, None)], "k int, v int")
    assert rows(C.deduplicate(df, ["k"], ["v"])) == [(1, 1), (2, None)]
    assert rows(C.deduplicate(df, ["k"], ["v"], "last")) == [(1, 2), (2, None)]
    assert rows(C.deduplicate(df, ["k"], keep=False)) == [(2, None)]
    with pytest.raises(ValueError):
        C.deduplicate(df, ["k"], keep="any")


def test_format_master_with_same_names(spark):
    df = spark.createDataFrame([("1", "10", None, "x", "0"), ("2", None, "20", "y", "3"), (None, "5", "6", "z", "1")], "`Customer Id` string, `a b` string, `A-B` string, t string, churn string")
    out, types = C.format_master(df, "Customer Id")
    assert out.columns[0] == "customer_id" and sorted((r.a_b, r.churn) for r in out.collect()) == [("10", 0), ("20", 1)]
    assert types["customer_id_col"] == "customer_id"


def test_imputers(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (5, "b"), (None, "nan")], "x int, s string")
    assert rows(C.impute(df, ["x"], ["s"], "most_frequent"))[0] == (1, "a")
    assert sorted(r.x for r in C.impute(df, ["x"], ["s"], "median").collect()) == [1.0, 1.0, 1.0, 5.0]
    assert sorted(r.s for r in C.impute(df, ["x"], ["s"]).collect()) == ["a", "b", "b", "b"]


def test_row_aggregates(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, None)], "a double, b double, c double")
    how = {k: {"agg_cols": ["a", "b", "c"], "agg_type": k} for k in ("sum", "mean", "min", "max", "count", "median", "std")}
    got = C.row_aggregate(df, how).select(*how).collect()
    assert tuple(got[0])[:6] == (5.0, 2.5, 1.0, 4.0, 2, 2.5) and got[0]["std"] == pytest.approx(np.std([1, 4], ddof=1))
    assert tuple(got[1]) == (0.0, None, None, None, 0, None, None)


def test_rankings_of_one_name(spark):
    a, b = spark.createDataFrame([("x", 1)], "feature string, v int"), spark.createDataFrame([("y", 1)], "feature string, v int")
    out = J.join_rankings("feature", a, b)
    assert out.columns == ["feature", "v_x", "v_y"] and rows(out) == [("x", 1, 0), ("y", 0, 1)]


def test_buffer_is_the_polygon():
    import math

    rng = np.random.default_rng(1)
    corners = [(math.cos(2 * math.pi * i / 64), math.sin(2 * math.pi * i / 64)) for i in range(65)]
    inside = lambda x, y: all((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) > 0 for a, b in zip(corners, corners[1:]))
    step = 2 * math.pi / 64
    for x, y in rng.uniform(-1.01, 1.01, (500, 2)):
        r, angle = math.hypot(x, y), math.atan2(y, x)
        assert (r * math.cos(angle % step - step / 2) < math.cos(step / 2)) == inside(x, y)


def test_buffer_ring_and_centre(spark):
    r = spark.range(1).select(G.buffer_ring(F.lit(3.0), F.lit(4.0), 2.0).alias("r")).select("r", G.centroid(F.col("r")).alias("c"), G.in_ring(F.lit(4.9), F.lit(4.0), F.col("r")).alias("i"), G.in_ring(F.lit(5.1), F.lit(4.0), F.col("r")).alias("o")).first()
    assert len(r.r) == 65 and (r.c.x, r.c.y) == pytest.approx((3, 4)) and r.i and not r.o


def test_distance_join_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    users = [(i, *map(float, rng.uniform(-500, 500, 2))) for i in range(60)]
    pois = [(i, *map(float, rng.uniform(-500, 500, 2)), "bank" if i % 2 else None) for i in range(80)]
    u, p = spark.createDataFrame(users, "user_id int, x double, y double"), spark.createDataFrame(pois, "poi_id int, x double, y double, kind string")
    got = {(r.user_id, r.poi_id): r.distance for r in G.poi_distances(u, p, 120.0, polygon=False).collect()}
    want = {(a, b): np.hypot(x - v, y - w) for a, x, y in users for b, v, w, _ in pois if np.hypot(x - v, y - w) < 120}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert {r.poi_id % 2 for r in G.poi_distances(u, p, 120.0, ["kind"]).collect()} == {1}


def test_first_tag_decides(spark):
    pairs = spark.createDataFrame([(1, "bank", "a", 10.0), (2, None, "a", 20.0)], "u int, kind string, size string, distance double")
    users = spark.createDataFrame([(1,), (2,), (3,)], "u int")
    strict = {r.u: r.number_of_a_in_a_ratio_of_100_meters for r in G.geographic_features(pairs, users, [100], 999, ["kind", "size"], "u").collect()}
    loose = {r.u: r.number_of_a_in_a_ratio_of_100_meters for r in G.geographic_features(pairs, users, [100], 999, ["kind", "size"], "u", strict=False).collect()}
    assert strict == {"1": 1, "2": 0, "3": 0} and loose == {"1": 1, "2": 1, "3": 0}


def test_boxes_left_join(spark):
    p = spark.createDataFrame([(1, 0.5, 0.5), (2, 9.0, 9.0)], "id int, x double, y double")
    b = spark.createDataFrame([("in", 0.0, 0.0, 1.0, 1.0)], "box string, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.id, r.box) for r in G.points_in_boxes(p, b, 0.3, "left").collect()) == [(1, "in"), (2, None)]


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations_against_brute_force(spark, method):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 8, 60).astype(float)
    b = a + rng.integers(0, 6, 60)
    df = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in zip(a, b)] + [(None, 1.0, 1.0)], "a double, b double, c double")
    got = {(r.feature_i, r.feature_j): r.r for r in S.correlation_pairs(df, ["a", "b", "c"], method).collect()}
    rank = lambda v: np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    if method == "kendall":
        sign = np.sign(a[:, None] - a) * np.sign(b[:, None] - b)
        want = sign.sum() / np.sqrt(((a[:, None] != a).sum()) * ((b[:, None] != b).sum()))
    else:
        want = np.corrcoef(*((a, b) if method == "pearson" else (rank(a), rank(b))))[0, 1]
    assert got["a", "b"] == pytest.approx(want) and got["a", "c"] is None


def test_ranks_over_several_ranges(spark):
    rng = np.random.default_rng(6)
    v = rng.integers(0, 300, 2000)
    counts = spark.createDataFrame([(float(x),) for x in v], "v double").groupBy("v").count()
    got = {r.v: r._upto for r in S.running_totals(counts, "v", "count", values_a_range=40).collect()}
    assert got == {float(x): int((v <= x).sum()) for x in set(v.tolist())}


def test_pairwise_filter_drops_the_stronger(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.9)], "feature_i string, feature_j string, r double")
    rank = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 5.0)], "feature string, f double")
    assert rows(S.features_to_drop(pairs, rank)) == [("b",)]


def test_candidate_features():
    have = ["id", "a", "b", "t"]
    assert S.candidate_features(have, ["b"], ["a", "t"], "mdt_encoded", "id", ["t"]) == ["a", "b"]
    assert S.candidate_features(have, ["b"], ["a", "t"], "numerical", "id", ["t"], ["b", "a", "absent"]) == ["a"]
    with pytest.raises(ValueError):
        S.candidate_features(have, [], [], "other", "id", [])


def test_final_ranking_needs_one_criterion(spark):
    v = spark.createDataFrame([("a", 1, "numerical_fundamental")], "feature string, mb_t int, feature_type string")
    for how in ({}, {"top": 1, "threshold": 1}):
        with pytest.raises(ValueError):
            S.final_ranking(v, {"x": ["t"]}, ["a"], **how)


def test_cluster_scores_of_clear_clusters(spark):
    pts = [(i, float(i % 2) * 100 + i * 0.01, i % 2) for i in range(40)]
    df = spark.createDataFrame(pts, "id int, x double, k int")
    got = K.cluster_metrics(df, "k", "id")
    assert got["sillhouette_score"] > 0.99 and got["davies_bouldin_score"] < 0.01 and got["calinski_harabasz_score"] > 1000
    assert set(K.cluster_metrics(df.withColumn("k", F.lit(1)), "k", "id").values()) == {None}
    assert K.squared_silhouette(df, "k", ["x"]) > 0.99


def test_constant_metric_and_ranking(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 4.0)], "model string, s double, d double")
    got = {r.model: r.final_score for r in K.metrics_ranking(df, {"s": 1.0, "d": 1.0}, ["d"]).collect()}
    assert got == {"a": 0.5, "b": 0.0}


def test_pretty_summary(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 9.0)], "k int, x double")
    text = K.text_summary(K.cluster_table(df, "k", ["x"]), pretty=True).orderBy("cluster").first().summary
    assert "**negative deviation from the mean**" in text and "**x** variable" in text


def test_baselines(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "t int, v double")
    got = {r.model: r for r in T.baseline_table(df, df, "t", "v").collect()}
    assert got["lag_test"].rmse == pytest.approx(1.0) and got["mean_test"].r2 == pytest.approx(0.0)


DATA = [{"column_id": c, "feature_group": "g", "business_name": n, "data_type": t, "u:feature": f, "u:target": y, "u:key": k} for c, n, t, f, y, k in (("id", "", "str", "N", "N", "Y"), ("x", "X", "Float", "Y", None, "N"), ("z", "Z", "int", "Y", "N", "N"), ("y", "Y", "bool", "N", "Y", "N"))]


def test_data_dict(spark):
    d = D.create_data_dict(DATA, {"use_case_id": "u"})
    assert d.features() == ["x", "z"] and d.features(["FLOAT"]) == ["x"] and d.variable("target") == "y" and d.variable("date") is None
    assert d.name("id") == "id" and d.name("x") == "X" and "x" in d and d["z"]["data_type"] == "int"
    assert D.DataDict.from_json(d.to_json(), "u").to_dict() == d.to_dict() and d.to_frame(spark).count() == 4
    d.add({"column_id": "new", "data_type": "str"})
    assert d.keys()[-1] == "new" and d.schema_kinds()["y"] == "boolean"
    with pytest.raises(KeyError):
        d["absent"]
    for change in ({"column_id": "x"}, {"column_id": " q"}, {"data_type": "blob"}, {"u:key": "Y"}, {"u:feature": "maybe"}):
        with pytest.raises(D.DataDictError):
            D.DataDict([*DATA, DATA[2] | {"column_id": "q"} | change], "u")


def tag(name, kind, on=None):
    return dict.fromkeys(("unit", "range_min", "range_max", "derived")) | {"tag": name, "name": name.upper(), "tag_type": kind, "data_type": "float64", "source": "s", "on_off_dependencies": on, "extra": len(name)}


def test_tag_dict():
    rows_ = [tag("a", "on_off", "b"), tag("b", "on_off", "a"), tag("cc", "input", "a, "), tag("d", "state")]
    t = D.TagDict(rows_)
    assert t.dependencies("cc") == ["a", "b"] and t.dependents("a") == ["b", "cc"] and t.dependencies("a") == ["b"]
    assert t.select("extra") == ["a", "b", "cc", "d"] and t.select("extra", 2) == ["cc"] and t.select("extra", lambda v: v < 2) == ["a", "b", "d"]
    t.add(tag("e", "output", "b"))
    assert t.dependents("b") == ["a", "cc", "e"]
    assert t.filter({"tag_type": ["on_off", "input"], "extra": 1}).keys() == ["a", "b"]
    with pytest.raises(KeyError):
        t.filter({"absent": 1})
    for bad in (tag("x", "input", "d"), tag("x,y", "input"), tag("d", "input"), tag("x", "pump"), tag("x", None)):
        with pytest.raises(D.TagDictError):
            D.TagDict([tag("d", "state"), bad])


def test_registry_imports_nothing():
    assert R.load_object({"class": "sklearn.cluster.KMeans", "kwargs": {"n_clusters": 3, "random_state": 1}}).getK() == 3
    for bad in ("os.system", "builtins.eval", "Unknown"):
        with pytest.raises(ValueError):
            R.load_object({"class": bad})


def test_elbow():
    assert M.elbow([2, 3, 4, 5, 6], [100, 40, 10, 8, 7]) == 4
    assert M.elbow([2, 3], [2, 1]) is None and M.elbow([2, 3, 4], [3.0, 2.0, 1.0]) is None


def test_clustering_and_votes_find_the_signal(spark):
    rng = np.random.default_rng(4)
    data = [(i, float(i % 3) * 10 + float(rng.normal()), float(rng.normal()), float(rng.normal()), int(i % 3 == 0)) for i in range(240)]
    df = spark.createDataFrame(data, "id int, x double, n1 double, n2 double, y int").cache()
    labelled, k = M.train_with_elbow(df.select("id", "x"), ["x"], 2, 7)
    assert k == 3 and labelled.columns == ["id", "x", "cluster"]
    votes = {r.feature: r[1] for r in M.boruta(df, ["x", "n1", "n2"], "y", 3).collect()}
    assert votes == {"x": 1, "n1": 0, "n2": 0}
    assert M.permutation_importance(df, ["x", "n1"], "y").first().feature == "x"
    assert "x " in M.tree_rules(df, ["x", "n1"], "y") and M.importances(df, ["x", "n1"], "y").first().feature == "x"
    assert M.cross_validated_f1(df, ["x"], "y", "id", {"class": "DecisionTreeClassifier"}) > 0.95
    shadows = M.with_shadows(df, ["x"], 1)
    assert sorted(round(r.x, 9) for r in shadows.collect()) == sorted(round(r.shadow_0, 9) for r in shadows.collect())
    model, own = M.train_cluster_model(df.select("id", "x"), {"class": "KMeans", "kwargs": {"n_clusters": 3, "random_state": 1}, "features": ["x"], "cluster_col": "c"})
    assert own.columns == ["id", "x", "c"] and own.groupBy("c").count().count() == 3
    assert model.infer(df.filter("id < 3")).select("c").distinct().count() == 3
    out, explained = M.embed(df, {"e": {"columns_to_embed": ["x", "n1", "n2"], "model": {"kwargs": {"n_components": 2}}}}, "id")
    assert {"component_0_e", "component_1_e"} <= set(out.columns) and 0.6 < explained["e"] <= 1
    best, table, ranking = M.train_models(df.select("id", "x", "n1"), {"KMeans": {"class": "KMeans"}, "GaussianMixture": {"class": "GaussianMixture"}}, ["x"], "id", {"sillhouette_score": 1.0}, [], min_clusters=2, max_clusters=5)
    assert best == ranking.first().model and table.count() == 240


def test_boruta_takes_enough_rounds(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(10)], "x double, y int")
    with pytest.raises(ValueError, match="rounds"):
        M.boruta(df, ["x"], "y", 2, rounds=3)


def test_shadows_of_equal_rows_and_again(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 300 + [(float(i), 0.0) for i in range(300)], "x double, y double")
    once, again = (sorted(map(tuple, M.with_shadows(df, ["x", "y"], 3).collect())) for _ in range(2))
    assert once == again and len(once) == 600 and sorted(r[0] for r in once) == sorted(r[2] for r in once)
    assert sum(r[0] != r[2] for r in once) > 200


def test_folds_deal_each_class_evenly(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(203)] + [(7, None)], "id int, y string")
    got = M.folds(df, "id", 3, "y").groupBy("y", "_fold").count().collect()
    sizes = {y: sorted(r["count"] for r in got if r.y == y) for y in ("a", "b", None)}
    assert sizes == {"a": [60, 61, 61], "b": [7, 7, 7], None: [1]}


def test_rows_without_a_feature_keep_their_place(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 10) for i in range(20)] + [(20, None), (21, float("nan"))], "id int, x double")
    labelled, _ = M.train_with_elbow(df, ["x"], 2, 4, num_clusters=2)
    assert labelled.count() == 22 and labelled.filter("cluster IS NULL").count() == 2
    model, own = M.train_cluster_model(df, {"class": "KMeans", "kwargs": {"n_clusters": 2}, "features": ["x"], "cluster_col": "c"})
    assert own.filter("c IS NULL").count() == 2 and own.count() == 22
    with pytest.raises(Exception, match="null|NaN"):
        M.importances(df.withColumn("y", F.lit(1)), ["x"], "y").collect()


def test_votes_of_models_by_their_penalty(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(a > 0)) for a, b, c in rng.standard_normal((200, 3))], "a double, b double, c double, y int")
    votes = lambda **k: {r.feature: r[1] for r in M.model_votes(df, ["a", "b", "c"], "y", {"class": "LogisticRegression", "kwargs": k}).collect()}
    assert votes(penalty="l2", C=1.0) == {"a": 1, "b": 0, "c": 0} and votes(penalty="l1", C=20.0)["a"] == 1
    for bad in ({"class_weight": "balanced"}, {"penalty": "elastic"}):
        with pytest.raises(ValueError):
            votes(**bad)


def test_bayesian_search_finds_the_top():
    trials = M.bayesian_search(lambda p: -((p["a"] - 3) ** 2), {"a": (0, 10)}, first=4, rounds=10)
    assert len(trials) == 14 and abs(max(trials, key=lambda t: t["score"])["a"] - 3) < 0.5


def test_plots_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 2.5), (3, 2.0, 1.0)], "t int, act double, pred double")
    assert sum(r.n for r in P.histogram(df, "act", 4).collect()) == 3 and P.histogram(df.limit(0), "act").count() == 0
    assert P.predicted_and_actual(df, "t", "act", "pred").count() == 6 and P.heatmap(df, ["act", "pred"]).count() == 1
    text = P.html_report("A <b>", {"t": df}, f"file://{tmp_path}/r.html")
    assert "A &lt;b&gt;" in text and (tmp_path / "r.html").read_text() == text


def test_map_rows(spark):
    out = M.map_rows(spark.range(100), lambda it: (p.assign(y=p.id * 2) for p in it), "id bigint, y bigint", 3)
    assert out.agg(F.sum("y")).first()[0] == 9900
