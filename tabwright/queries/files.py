"""Queries of sources and of fitted steps: tables written into this application's folder and read again, and dictionaries made from tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import dictionaries as D
from tabwright.operators import transformers as TR
from tabwright.queries.base import MASTER_SQL, master, query, rounded
from tabwright.session import table
from tabwright.sources import files
from tabwright.sources.versions import Versions
from tabwright.written import own_dir


def _new(spark: SparkSession) -> str:
    return f"{own_dir(spark)}/{uuid.uuid4().hex}"


@query("""SELECT p_partkey AS part_key, CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.5 END::DOUBLE AS us_size, CASE WHEN p_partkey % 2 = 1 THEN 'K' || (p_partkey % 9) END AS station, p_brand AS brand_name FROM part""")
def survey_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated text tables of two headers in one folder, put together, converted and renamed."""
    folder, p = _new(spark), table(spark, sf_dir, "part")
    key, brand = F.col("p_partkey").alias("Part Key"), F.col("p_brand").alias("Brand-Name")
    halves = [p.filter("p_partkey % 2 = 0").select(key, F.concat(F.col("p_size").cast("string"), F.lit(".5")).alias("US Size"), brand), p.filter("p_partkey % 2 = 1").select(key, F.concat(F.lit("K"), (F.col("p_partkey") % 9).cast("string")).alias("Station"), brand)]
    for half in halves:
        half.write.mode("append").option("header", True).option("sep", "\t").option("extension", "txt").csv(folder)
    found = files.load_survey(spark, folder, files.SurveyOptions(to_float=["US Size"]), compile_from_txt=True)
    return found.select(F.col("part_key").cast("bigint").alias("part_key"), "us_size", "station", "brand_name")


_BOXES = {"north": (-73.99, 4.53, -73.95, 4.58), "centre": (-73.97, 4.50, -73.92, 4.55), "far": (10.0, 10.0, 11.0, 11.0), "all": (-74.0, 4.5, -73.9, 4.6)}
_LON, _LAT = "(-74.0 + (k * 37 % 1000) / 10000.0)", "(4.5 + (k * 91 % 1000) / 10000.0)"


@query(f"""WITH p AS (SELECT k, {_LON}::DOUBLE AS lon, {_LAT}::DOUBLE AS lat FROM (SELECT c_custkey AS k FROM customer)),
b AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {', '.join(f'{x}::DOUBLE' for x in b)})" for n, b in _BOXES.items())}) v(city, x0, y0, x1, y1))
SELECT k, city FROM p JOIN b ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1""")
def poi_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points along a Z-curve, and one scan for all boxes."""
    path = _new(spark)
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).selectExpr("k", f"CAST({_LON} AS DOUBLE) AS lon", f"CAST({_LAT} AS DOUBLE) AS lat")
    files.save_pois(points, path)
    return files.load_pois(spark, path, _BOXES).select("k", "city")


@query("""SELECT 'first' AS version, s_suppkey, s_name FROM supplier UNION ALL SELECT 'latest', s_suppkey, upper(s_name) || '!' FROM supplier WHERE s_suppkey % 3 = 0""")
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table, both read again."""
    versions, s = Versions(spark, _new(spark)), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    versions.save(s, "first")
    versions.save(s.filter("s_suppkey % 3 = 0").withColumn("s_name", F.concat(F.upper("s_name"), F.lit("!"))), "second")
    return versions.load("first").select(F.lit("first").alias("version"), "*").unionByName(versions.load().select(F.lit("latest").alias("version"), "*"))


@query("""WITH t AS (SELECT n_name AS tag, 'code ' || n_nationkey AS code, n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 'on_off' ELSE 'input' END AS kind FROM nation)
SELECT 'kept' AS what, tag AS name FROM t WHERE kind = 'input' AND k % 2 = 1 UNION ALL SELECT 'renamed', code FROM t UNION ALL SELECT 'needs', a.tag || ' ' || b.tag FROM t a JOIN t b ON a.k = b.k + 1 AND b.kind = 'on_off'""")
def tag_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag dictionary of the nations: filtered, renamed, and each tag's dependencies."""
    k, n = F.col("n_nationkey"), table(spark, sf_dir, "nation")
    before = n.filter("n_nationkey % 3 = 0").select((F.col("n_nationkey") + 1).alias("n_nationkey"), F.col("n_name").alias("dep"))
    rest = {"data_type": "float64", "unit": "m", "range_min": 0, "range_max": 1, "derived": False}
    kind = F.when(k % 3 == 0, "on_off").otherwise("input")
    rows = n.join(before, "n_nationkey", "left").select(F.col("n_name").alias("tag"), F.concat(F.lit("name of "), "n_name").alias("name"), kind.alias("tag_type"), F.coalesce("dep", F.lit("")).alias("on_off_dependencies"), F.concat(F.lit("code "), k.cast("string")).alias("code"), (k % 2).alias("odd"), *[F.lit(v).alias(c) for c, v in rest.items()])
    whole = D.TagDict(rows)
    found = [("needs", f"{t} {d}") for t in whole.keys() for d in whole.dependencies(t)]
    found += [("kept", t) for t in D.TagDict(rows.withColumn("on_off_dependencies", F.lit(""))).filter({"tag_type": ["input"], "odd": 1}).keys()]
    found += [("renamed", t) for t in D.TagDict(rows.withColumn("on_off_dependencies", F.lit(""))).change_tag("code").keys()]
    return spark.createDataFrame(found, "what string, name string")


@query(f"""WITH n AS ({MASTER_SQL}), m AS (SELECT customer_id, CASE WHEN customer_id % 7 > 1 THEN total_spend END AS total_spend, max_spend FROM n), f AS (SELECT avg(total_spend) AS a, avg(max_spend) AS b FROM m WHERE customer_id % 2 = 0)
SELECT customer_id, round(coalesce(total_spend, a), 4) AS total_spend, round(coalesce(max_spend, b), 4) AS max_spend FROM m, f WHERE customer_id % 2 = 1""")
def fitted_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of one half of the customers fill what the other half lacks."""
    both = master(spark, sf_dir).select("customer_id", F.when(F.col("customer_id") % 7 > 1, F.col("total_spend")).alias("total_spend"), "max_spend")
    model = TR.fit_transformer(both.filter("customer_id % 2 = 0"), {"class": "SimpleImputer", "transformer_kwargs": {"strategy": "mean"}}, ["total_spend", "max_spend"])
    (out,) = TR.apply_to_all(model, {"features": ["customer_id", "total_spend", "max_spend"], "drop_other_features": True}, both.filter("customer_id % 2 = 1"))
    return rounded(out)
