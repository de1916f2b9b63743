"""Queries of the string, number, date and missing-value functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import numbers as N
from tabwright.functions import text as X
from tabwright.operators.cleaning import unpivot
from tabwright.queries.base import query
from tabwright.session import table

_REPLACED = "strip_accents(replace(replace(lower(s), 'ß', 'ss'), 'œ', 'oe'))"
for _mark in X.TO_UNDERSCORE:
    _REPLACED = "replace({}, '{}', '_')".format(_REPLACED, _mark.replace("'", "''"))
_SHORT = f"translate({{}}, '{X.ACCENTED}', '{X.PLAIN}')"
_STANDARD = _SHORT.format(f"CASE WHEN contains({_REPLACED}, '_') THEN regexp_replace({_REPLACED}, '_$', '') ELSE lower(s) END")


@query(f"SELECT doc_id, {_STANDARD} AS name FROM (SELECT doc_id, text AS s FROM documents)")
def std_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.standardise_columns(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("name")), ["name"])


@query(f"SELECT doc_id, {_SHORT.format("coalesce(text, 'None')")} AS text FROM documents")
def strip_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_marks("text").alias("text"))


@query("SELECT c_custkey AS customer_id, c_acctbal AS acct_balance_usd, c_mktsegment AS segmento_ano FROM customer")
def std_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.standardise_names(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer ID"), F.col("c_acctbal").alias("Acct. Balance (USD)"), F.col("c_mktsegment").alias("Segmento  Áño")).withColumnRenamed("Segmento  Áño", "Segmento Ano"))


@query("SELECT s_suppkey, lower(replace(s_name, '#', '')) || '-' || (s_nationkey % 7) || 'b' AS line FROM supplier")
def line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.translate("s_name", "#", " "), F.lit(" - "), (F.col("s_nationkey") % 7).cast("string"), F.lit(" B "))
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.line_id(raw).alias("line"))


@query("""SELECT p_partkey, contains(p_name, ',') OR p_partkey % 3 = 0 AS comma, p_partkey % 5 = 0 AS outer_space FROM part""")
def illegal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(F.col("p_partkey") % 5 == 0, " ").otherwise(""), F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, ", x").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", X.has_comma(name).alias("comma"), X.has_outer_space(name).alias("outer_space"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey / 2.0 END::DOUBLE AS position FROM part")
def valve_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.when(F.col("p_partkey") % 4 == 0, "x").otherwise((F.col("p_partkey") / 2).cast("string")), F.lit("_valve_"), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", X.valve_position(raw).alias("position"))


@query("SELECT p_partkey, round(CASE p_partkey % 4 WHEN 0 THEN 1.0 / (p_size % 8 + 1) WHEN 1 THEN p_size WHEN 2 THEN NULL ELSE (p_size % 10) + 0.5 END, 6)::DOUBLE AS diameter FROM part")
def diameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, k = F.col("p_size"), F.col("p_partkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("1 / "), (size % 8 + 1).cast("string"))).when(k == 1, size.cast("string")).when(k == 2, "wide").otherwise(F.concat((size % 10).cast("string"), F.lit(".5 in")))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(X.diameter(raw), 6).alias("diameter"))


@query("SELECT p_partkey, len(string_split(p_name, ' ')) AS n, array_to_string(string_split(p_name, ' '), ', ') AS joined FROM part")
def name_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']"))
    listed = X.list_of_features(made)
    again = X.list_of_names(F.concat(X.joined_names(listed), F.lit(", ,")))
    return table(spark, sf_dir, "part").select("p_partkey", F.size(again).cast("bigint").alias("n"), X.joined_names(again).alias("joined"))


@query("""SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 THEN -floor(o_totalprice) + (o_totalprice::DECIMAL(18,2) - floor(o_totalprice)::DECIMAL(18,2))::DOUBLE
  WHEN o_orderkey % 3 = 1 THEN o_totalprice::DECIMAL(18,2)::DOUBLE ELSE NULL END, 4)::DOUBLE AS price FROM orders""")
def us_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("-"), F.regexp_replace(written, ",", ", "))).when(F.col("o_orderkey") % 3 == 1, written).otherwise("1,234")
    return table(spark, sf_dir, "orders").filter("o_totalprice >= 1000").select("o_orderkey", F.round(N.us_number(raw), 4).alias("price")).unionByName(
        table(spark, sf_dir, "orders").filter("o_totalprice < 1000").select("o_orderkey", F.round(N.us_number(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("-0,"), written)).when(F.col("o_orderkey") % 3 == 1, written).otherwise("1,234")), 4).alias("price")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_linenumber + l_partkey / pow(10, length(l_partkey::VARCHAR)), 9) AS station FROM lineitem")
def abscissas(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.col("l_linenumber").cast("string"), F.lit(" + "), F.col("l_partkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(N.abscissa(raw), 9).alias("station"))


@query("SELECT s_suppkey, round(s_suppkey % 80 + (s_suppkey % 60) / 60.0::DOUBLE + (s_suppkey % 59 + 0.5) / 3600.0::DOUBLE, 9) AS lat, -round(s_suppkey % 80 + (s_suppkey % 60) / 60.0::DOUBLE + (s_suppkey % 59 + 0.5) / 3600.0::DOUBLE, 9) AS lon FROM supplier")
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = F.concat_ws("-", (k % 80).cast("string"), (k % 60).cast("string"), (k % 59 + 0.5).cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(N.decimal_degrees(raw, "latitud"), 9).alias("lat"), F.round(N.decimal_degrees(raw, "longitud"), 9).alias("lon"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN NULL WHEN 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS number, event_id % 5 IN (0, 2, 3) AS flag FROM events")
def bool_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, ("Yes", "off", "nan", "1.0", "F"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", N.bool_number(raw).alias("number"), N.to_bool(raw).alias("flag"))


@query("""SELECT event_id, event_id::DOUBLE / 2 AS num, coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END, 'nan') AS cat, ts::DATE::TIMESTAMP AS day, event_id % 2 = 0 AS flag FROM events""")
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") / 2).cast("string").alias("num"), F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("cat"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("event_id") % 2 == 0, "true").otherwise("No").alias("flag"))
    return N.enforce_schema(raw, {"num": "numeric", "cat": "categorical", "day": "datetime", "flag": "boolean"})


@query("""SELECT event_id::DOUBLE AS event_id, (event_id * 10)::DOUBLE AS all_numbers, CASE WHEN event_id % 100 = 0 THEN '12d' ELSE event_id::VARCHAR END AS some_numbers,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id::VARCHAR END AS with_nulls FROM events""")
def float_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id").cast("string")
    raw = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit(" "), k, F.lit("_0")).alias("all_numbers"), F.when(F.col("event_id") % 100 == 0, "12d").otherwise(k).alias("some_numbers"), F.when(F.col("event_id") % 3 != 0, k).alias("with_nulls"))
    return N.convert_to_float(raw)


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS customer FROM orders")
def id_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.cast_id(table(spark, sf_dir, "orders").select("o_orderkey", N.id_text(F.col("o_custkey") + F.lit(0.75)).alias("customer")), "o_orderkey")


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN -1.0 ELSE round(value, 4) END::DOUBLE AS value, CASE WHEN event_id % 11 = 0 THEN '-1' ELSE event_type END AS kind FROM events""")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    value = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.when(k % 2 == 0, float("nan")).otherwise(float("inf"))).otherwise(F.round("value", 4))
    return N.fill_missing(table(spark, sf_dir, "events").select("event_id", value.alias("value"), F.when(k % 11 == 0, F.when(k % 2 == 0, "nan")).otherwise(F.col("event_type")).alias("kind")), -1)


@query("SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind, CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value, 4) END AS value FROM events")
def nulls_for_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    raw = table(spark, sf_dir, "events").select("event_id", F.when(k % 11 == 0, "Nan").otherwise(F.col("event_type")).alias("kind"), F.when(k % 7 == 0, float("-inf")).otherwise(F.round("value", 4)).alias("value"))
    return N.nulls_for_missing(raw)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 1 ELSE 0 END::INTEGER AS churn FROM events")
def churn_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    raw = table(spark, sf_dir, "events").select("event_id", F.when(k % 3 == 0, "0").when(k % 3 == 1, "2.5").alias("left"))
    return N.churn_flag(raw, "left").select("event_id", "churn")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", N.date_text(F.col("o_orderdate").cast("string")).alias("day"))


@query("""SELECT o_custkey, value, stat FROM (UNPIVOT (SELECT o_custkey, count(*)::DOUBLE AS n, round(max(o_totalprice), 2)::DOUBLE AS top FROM orders GROUP BY 1) ON n, top INTO NAME stat VALUE value)""")
def unpivot_order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"))
    return unpivot(wide, ["o_custkey"], "stat", "value")
