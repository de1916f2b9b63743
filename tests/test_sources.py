import json

import pytest

from tabwright.plans import pipelines
from tabwright.sources import files, parameters


def test_survey_of_text_tables(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Línea (1)\tValor\tLat\tPK\tUnnamed: 3\nA 1 - B\t1,234.5\t4-30-36\t12+5\tx\n")
    (tmp_path / "b.txt.old").write_text("Línea (1)\tLat\tOtro\nC\t5-0-0\ty\n")
    (tmp_path / "c.csv").write_text("not,read\n1,2\n")
    o = files.SurveyOptions(us_numbers=["Valor"], line_ids=["Línea (1)"], georeferenced=["Lat"], abscissas=["PK"], to_text=["Otro"])
    got = {r.linea_1: r for r in files.load_survey(spark, f"file://{tmp_path}", o, compile_from_txt=True).collect()}
    assert got.keys() == {"a1-b", "c"} and got["a1-b"].valor == 1234.5 and got["a1-b"].lat == pytest.approx(4.51)
    assert got["a1-b"].pk == pytest.approx(12.5) and got["a1-b"].otro == "nan" and "unnamed_3" not in got["c"].asDict()
    with pytest.raises(FileNotFoundError):
        files.read_text_tables(spark, f"file://{tmp_path.parent}")


def test_survey_unpivot_and_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,a,b\n1,2,3\n")
    o = files.SurveyOptions(unpivot={"agg_cols": ["id"], "col_name": "tag", "value_name": "value"})
    got = files.load_survey(spark, f"file://{tmp_path}/s.csv", o)
    assert got.columns == ["id", "value", "tag"] and sorted(map(tuple, got.collect())) == [(1, 2, "a"), (1, 3, "b")]


def test_pois_and_geojson(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1.0, "bank"), (5.0, 5.0, None), (1.5, 1.5, None)], "lon double, lat double, amenity string")
    files.save(df, f"{tmp_path}/p")
    assert files.exists(spark, f"{tmp_path}/p") and not files.exists(spark, f"{tmp_path}/q")
    got = files.load_pois(spark, f"{tmp_path}/p", {"x": (0, 0, 2, 2), "y": (1, 1, 6, 6)})
    assert sorted((r.city, r.lon) for r in got.collect()) == [("x", 1.0), ("x", 1.5), ("y", 1.0), ("y", 1.5), ("y", 5.0)]
    assert files.load_pois(spark, f"{tmp_path}/p", {"x": (0, 0, 9, 9)}, ["amenity"]).count() == 1
    files.save_geojson(df, f"{tmp_path}/g")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/g").collect()]
    assert sorted(x["geometry"]["coordinates"][0] for x in lines) == [1.0, 1.5, 5.0] and {x["type"] for x in lines} == {"Feature"}


def test_parameters(tmp_path):
    (tmp_path / "parameters.yml").write_text("GLOBAL_SEED: 5\na: 1\n")
    (tmp_path / "parameters_b.yml").write_text("a: 2\n")
    found = parameters.load_parameters(str(tmp_path))
    assert found == {"GLOBAL_SEED": 5, "a": 2} and parameters.global_seed(found) == 5


def test_pipelines_end_to_end(spark):
    data = [(i, float(i % 3) * 10 + i % 7, float(i % 5), "ab"[i % 2], int(i % 3 == 0), None if i % 9 == 0 else float(i % 4)) for i in range(150)]
    raw = spark.createDataFrame([(str(a), b, c, d, str(e), f) for a, b, c, d, e, f in data], "`Customer ID` string, x double, z double, kind string, churn string, w double")
    bundle = pipelines.model_input(raw, "Customer ID", drop_churned=False, outliers={"cols": ["x"], "filt_quantile": 0.95})
    encoded = bundle["mdt_encoded"].cache()
    assert encoded.columns == sorted(encoded.columns) and encoded.filter("w IS NULL").count() == 0
    assert bundle["without_outliers"].count() + bundle["outliers"].count() == 150
    params = {"correlation_filters": {"num_to_cat": {"statistical_test": "f_classif", "corr_method": "pearson", "corr_threshold": 0.95}}, "tree_depths": [3], "boruta_rounds": 9, "models": {"classification_targets": [{"class": "RandomForestClassifier", "kwargs": {"random_state": 1, "n_estimators": 5}}]}, "number_of_features_threshold": 3}
    ranking = pipelines.feature_selection(encoded, "customer_id", {"classification_targets": ["churn"]}, params).cache()
    assert 0 < ranking.count() <= 3 and set(ranking.columns) == {"feature", "feature_type", "final_rank"}
    reports, best = pipelines.model_selection(encoded, ranking, "customer_id", {"must_have_features": ["x", "w"], "models": {"KMeans": {"class": "KMeans"}}, "min_num_features": 2, "min_clusters": 2, "max_clusters": 4, "metric_weighting": {"sillhouette_score": 1.0}, "invert_metric_value": []})
    assert reports.count() >= 1 and best["features"][:2] == ["x", "w"]
