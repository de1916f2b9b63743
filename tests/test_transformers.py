import pytest

from tabwright.functions import text as X
from tabwright.operators import transformers as T
from tabwright.operators.dictionaries import DataDict
from tabwright.streaming import features as S

from test_operators import DATA  # the same data dictionary


@pytest.fixture(scope="module")
def frames(spark):
    train = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "b"), (4, 100.0, None)], "id int, x double, s string")
    return train, spark.createDataFrame([(9, None, None), (10, 50.0, "z")], "id int, x double, s string")


def test_fit_on_one_table_and_apply_to_others(frames):
    train, test = frames
    model = T.fit_transformer(train, {"class": "sklearn.impute.SimpleImputer", "transformer_kwargs": {"strategy": "median"}}, ["x"])
    got = T.apply_to_all(model, {"features": ["x"], "drop_other_features": True}, train, test)
    assert [d.columns for d in got] == [["x"], ["x"]] and [r.x for r in got[1].collect()] == [2.5, 50.0]
    mode = T.fit_transformer(train, {"class": "Imputer", "transformer_kwargs": {"strategy": "most_frequent"}}, ["s"])
    assert [r.s for r in T.apply_fitted(mode, test).collect()] == ["b", "z"]
    fixed = T.Imputer(["s"], "constant", "none").fit(train)
    assert [r.s for r in fixed.transform(test).collect()] == ["none", "z"]


def test_outlier_and_scale_models(frames):
    train, test = frames
    iqr = T.QuantileOutliers({"x": (0.25, 0.75)}, "drop", 1.5).fit(train)
    assert train.count() - iqr.transform(train).count() == 1
    assert [r.x for r in T.RangeOutliers({"x": (0, 10)}, "clip").fit(train).transform(test).collect()] == [None, 10.0]
    scaled = T.Scaler(["x"], "minmax").fit(train).transform(train)
    assert sorted(r.x for r in scaled.collect())[::3] == [0.0, 1.0]
    with pytest.raises(ValueError):
        T.QuantileOutliers({"x": (0.9, 0.1)}).fit(train)


def test_selection_and_errors(frames):
    train, _ = frames
    step = T.SelectColumns(["s", "id"])
    assert step.transform(train).columns == step.get_feature_names() == ["s", "id"]
    with pytest.raises(KeyError):
        T.SelectColumns(["absent"]).transform(train)
    for params, error in (({}, ValueError), ({"class": "os.system"}, ValueError), ({"class": "Imputer", "target_variable_col": "absent"}, KeyError)):
        with pytest.raises(error):
            T.fit_transformer(train, params, ["x"])


def test_configuration():
    d = DataDict(DATA, "u")
    assert T.features_to_impute({"data_type": "numeric"}, d) == ["x", "z"] and T.features_to_impute({"data_type": "categorical", "features": ["q"]}, d) == ["q"]
    assert T.cols_to_skip(d) == ["id"] and T.model_input_sets(None) == ["train_data", "test_data"]
    assert T.model_input_sets({"train_data": 1, "test_data": 1, "valid_data": 1})[-1] == "valid_data"
    for bad in (lambda: T.features_to_impute({"data_type": "date"}, d), lambda: T.model_input_sets({"train_data": 1})):
        with pytest.raises(ValueError):
            bad()


def test_stream_of_counts(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "A b", 1.0), ("2024-01-01 03:00:00", "A-b", 3.0), ("2024-01-01 05:00:00", "c", 5.0)]
    spark.createDataFrame(rows, "ts string, tag string, v double").selectExpr("cast(ts as timestamp) ts", "tag", "v").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, tag string, v double").parquet(f"{tmp_path}/in")
    out = S.windowed_counts(S.normalised(stream, {X.standardise: ["tag"]}), "ts", ["tag"], value="v")
    q = out.writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", f"{tmp_path}/c").start()
    try:
        q.processAllAvailable()
        got = sorted((r.tag, r.n, r.min_v, r.mean_v) for r in spark.sql("SELECT * FROM windowed").collect())
    finally:
        q.stop()
    assert got == [("a_b", 2, 1.0, 2.0), ("c", 1, 5.0, 5.0)]
