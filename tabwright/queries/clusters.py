"""Queries of cluster metrics, rankings and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import clusters as K
from tabwright.queries.base import query, rounded
from tabwright.session import table

_DIMS = 64


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", "label", *[F.element_at("embedding", i + 1).cast("double").alias(f"e{i}") for i in range(_DIMS)]), [f"e{i}" for i in range(_DIMS)]


_LONG = f"e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range({_DIMS})) AS i FROM embeddings)"


@query(f"""WITH {_LONG}, w AS (SELECT sum(n * s) AS within FROM (SELECT label, i, count(*) AS n, var_pop(v) AS s FROM e GROUP BY 1, 2)),
t AS (SELECT sum(n * s) AS total FROM (SELECT i, count(*) AS n, var_pop(v) AS s FROM e GROUP BY 1)), k AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM embeddings)
SELECT round(((total - within) / (k - 1)) / (within / (n - k)), 4) AS calinski_harabasz FROM w, t, k""")
def calinski_harabasz(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, cols = _vectors(spark, sf_dir)
    return rounded(spark.createDataFrame([(K.calinski_harabasz(df, "label", cols),)], "calinski_harabasz double"))


@query(f"""WITH {_LONG}, c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1, 2), s AS (SELECT label, avg(d) AS s FROM (SELECT e.label, vec_id, sqrt(sum((v - m) * (v - m))) AS d FROM e JOIN c ON e.label = c.label AND e.i = c.i GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT a.label AS x, b.label AS y, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2)
SELECT round(avg(r), 4) AS davies_bouldin FROM (SELECT x, max((p.s + q.s) / d) AS r FROM d JOIN s p ON p.label = x JOIN s q ON q.label = y GROUP BY 1)""")
def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, cols = _vectors(spark, sf_dir)
    return rounded(spark.createDataFrame([(K.davies_bouldin(df, "label", cols),)], "davies_bouldin double"))


@query("""WITH d AS (SELECT a.vec_id AS i, a.label AS k, b.label AS l, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))) AS d FROM embeddings a, embeddings b),
m AS (SELECT i, k, l, sum(d) AS s, count(*) AS n FROM d GROUP BY 1, 2, 3), w AS (SELECT i, max(CASE WHEN k = l AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN k <> l THEN s / n END) AS b FROM m GROUP BY 1)
SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette FROM w""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, cols = _vectors(spark, sf_dir)
    return rounded(K.silhouette(df, "label", cols, "vec_id"), 6)


@query("""WITH r AS (SELECT p_brand AS model, avg(p_retailprice) AS s, count(*)::DOUBLE AS c, avg(p_size) AS d FROM part GROUP BY 1),
n AS (SELECT model, (s - min(s) OVER ()) / (max(s) OVER () - min(s) OVER ()) * 0.5 AS a, (c - min(c) OVER ()) / (max(c) OVER () - min(c) OVER ()) * 0.3 AS b, (1 - (d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ())) * 0.2 AS e FROM r)
SELECT model, round((a + b + e) / 3, 6)::DOUBLE AS final_score FROM n""")
def metrics_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("model")).agg(F.avg("p_retailprice").alias("s"), F.count("*").cast("double").alias("c"), F.avg("p_size").alias("d"))
    return rounded(K.metrics_ranking(reports, {"s": 0.5, "c": 0.3, "d": 0.2}, ["d"]).select("model", "final_score"), 6)


_COLS = ("c_acctbal", "c_nationkey")


def _quartiles(c: str) -> str:
    q = ", ".join(f"round(quantile_cont({c}::DOUBLE, {x}), 4) AS q{i}" for i, x in enumerate((0, 0.25, 0.5, 0.75, 1)))
    return f"SELECT '{c}' AS feature, {q} FROM customer"


@query(" UNION ALL ".join(map(_quartiles, _COLS)))
def cluster_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.quantile_levels(table(spark, sf_dir, "customer"), list(_COLS)).select("feature", *[f"q{i}" for i in range(5)]))


def _level(c: str) -> str:
    q = [f"quantile_cont({c}::DOUBLE, {x})" for x in (0, 0.25, 0.5, 0.75, 1)]
    g = f"(SELECT avg({c}) AS whole, " + ", ".join(f"{e} AS q{i}" for i, e in enumerate(q)) + " FROM customer)"
    return f"""SELECT c_mktsegment AS cluster, '{c}' AS feature, round(m, 4) AS mean, round(d, 4) AS median, round(s, 4) AS std, round(coalesce(round_even((m - whole) / whole, 2) * 100, 0), 4) AS relative_difference,
  CASE WHEN m BETWEEN q0 AND q1 THEN 'low' WHEN m BETWEEN q1 AND q2 THEN 'medium_low' WHEN m BETWEEN q2 AND q3 THEN 'medium_high' WHEN m BETWEEN q3 AND q4 THEN 'high' END AS quantile
  FROM (SELECT c_mktsegment, avg({c}) AS m, quantile_cont({c}::DOUBLE, 0.5) AS d, stddev_samp({c}) AS s FROM customer GROUP BY 1), {g}"""


_TABLE = " UNION ALL ".join(map(_level, _COLS))


@query(_TABLE)
def cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.cluster_table(table(spark, sf_dir, "customer"), "c_mktsegment", list(_COLS)))


@query(f"SELECT cluster, feature, relative_difference FROM ({_TABLE})")
def relative_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.relative_differences(table(spark, sf_dir, "customer"), "c_mktsegment", list(_COLS)))


@query(f"""SELECT cluster, string_agg(printf(E'\\n - This cluster belongs to %s quantile of the %s variable with a mean value of %.2f, deviation from the mean of %.1f%%, a median of %.2f  and a standard deviation of %.2f', quantile, feature, round_even(mean, 2), round_even(relative_difference, 1), round_even(median, 2), round_even(std, 2)), '' ORDER BY feature) || E'\\n' AS summary
FROM ({_TABLE}) GROUP BY cluster""")
def text_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation that rounds to zero from below keeps its sign in the sentence
    return K.text_summary(rounded(K.cluster_table(table(spark, sf_dir, "customer"), "c_mktsegment", list(_COLS)), but=("relative_difference",)))
