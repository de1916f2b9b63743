import pytest
from pyspark.sql import functions as F

from tabwright.functions import numbers as N
from tabwright.functions import text as X


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f("v").alias("x")).first().x


def plain(s):
    """The rules of ``standardise`` in plain Python, one step after the other."""
    low = s.lower()
    out = "".join({"ß": "ss", "œ": "oe", "æ": "ae"}.get(c, X.ASCII.get(c, c)) for c in low)
    for mark in "( ) * SPACE : . - ; < ? / , ' ____ ___ __".split():
        out = out.replace(" " if mark == "SPACE" else mark, "_")
    if "_" not in out:
        return low.translate(str.maketrans(X.ACCENTED, X.PLAIN))
    return (out[:-1] if out.endswith("_") else out).translate(str.maketrans(X.ACCENTED, X.PLAIN))


@pytest.mark.parametrize("text", ["tienda ñandú", "ñandú", "Straße (Nord)", "a___________b", "Œuvre, complète.", "x@y z", "", " ", "déjà-vu?", "plain"])
def test_standard_form(spark, text):
    assert one(spark, text, X.standardise) == X.standardise_name(text) == plain(text)


def test_known_standard_forms(spark):
    assert [X.standardise_name(x) for x in ("tienda ñandú", "ñandú", "a___________b", "Acct. Balance (USD)")] == ["tienda_nandu", "ñandu", "a__b", "acct_balance_usd"]
    assert one(spark, None, X.normalise) is None and one(spark, None, X.standardise) == "None"


@pytest.mark.parametrize("text, value", [("1,234.56", 1234.56), ("-1,234.56", -1233.44), ("1 234.5", 1234.5), ("12", 12.0), ("1,234", None), ("1.2.3,4", None), ("1e3", 1000.0), (None, None), ("12d", None), ("1_000", 1000.0)])
def test_us_number(spark, text, value):
    assert one(spark, text, N.us_number) == (pytest.approx(value) if value is not None else None)


def test_us_number_with_sign(spark):
    assert one(spark, "-1,234.56", lambda c: N.us_number(c, strict=False)) == pytest.approx(-1234.56)


def test_stations_and_degrees(spark):
    assert [one(spark, x, N.abscissa) for x in ("12+345", "12 + 45")] == pytest.approx([12.345, 12.45])
    assert one(spark, "4-30-36", lambda c: N.decimal_degrees(c, "latitud")) == pytest.approx(4.51)
    assert one(spark, "74-30-36", lambda c: N.decimal_degrees(c, "longitud")) == pytest.approx(-74.51)


def test_booleans(spark):
    assert [one(spark, x, N.to_bool) for x in ("Yes", "off", "nan", "1.0", "F")] == [True, False, True, True, False]
    for bad in ("maybe", None):
        with pytest.raises(Exception, match="not a boolean"):
            one(spark, bad, N.bool_number)


@pytest.mark.parametrize("text, value", [("1/2", 0.5), (" 12 in", None), ("1 2", 12.0), ("3.5", 3.5), ("abc", None), ("1/0", None), ("__import__", None), (None, None)])
def test_diameter_never_runs_code(spark, text, value):
    assert one(spark, text, X.diameter) == value


def test_lists_and_lines(spark):
    assert one(spark, "['a', 'b c']", X.list_of_features) == ["a", "b c"]
    assert one(spark, "a, ,b,", X.list_of_names) == ["a", "b"] and one(spark, None, X.list_of_names) == []
    assert one(spark, "L A - T.B", X.line_id) == "la-t_b"
    assert one(spark, "12.5_v_3", X.valve_position) == 12.5


def test_fill_and_null_marks(spark):
    df = spark.createDataFrame([(float("nan"), "NaN", 1), (None, "a", None), (float("-inf"), None, 3), (2.0, "Nan", 4)], "x double, s string, i int")
    assert [tuple(r) for r in N.fill_missing(df, 0).collect()] == [(0.0, "0", 1), (0.0, "a", 0), (0.0, "0", 3), (2.0, "0", 4)]
    assert [tuple(r) for r in N.nulls_for_missing(df).collect()] == [(None, None, 1), (None, "a", None), (None, None, 3), (2.0, None, 4)]


def test_type_dictionary_and_schema(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True)], "id int, x double, s string, b boolean")
    assert N.type_dictionary(df, "id") == {"numerical_features": ["x"], "categorical_features": ["s"], "other_type": ["b"], "customer_id_col": "id"}
    with pytest.raises(KeyError):
        N.enforce_schema(df, {"absent": "numeric"})
    with pytest.raises(ValueError):
        N.cast_kind(F.col("x"), "shape")


def test_float_conversion_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1", "nan", 1), ("2", "x", "3", None)], "a string, b string, c string, d int")
    out = N.convert_to_float(df)
    assert dict(out.dtypes) == {"a": "double", "b": "string", "c": "double", "d": "int"}
    assert [r.c for r in out.collect()] == [None, 3.0]
    assert N.cluster_baseline_percent(3) == 33.33 and N.int_params({"a": 2.0, "b": 1.5}, ["a"]) == {"a": 2, "b": 1.5}
