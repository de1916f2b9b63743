"""Queries of correlations, test statistics, votes and final rankings."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import stats as S
from tabwright.operators.neighbour_information import neighbour_information as nearest_information
from tabwright.queries.base import MASTER_SQL, master, query, rounded
from tabwright.session import table

_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_M = f"WITH m AS ({MASTER_SQL})"
_MCOLS = ["c_acctbal", "n_orders", "total_spend", "avg_spend", "max_spend"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query(_union([f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in combinations(_COLS, 2)]))
def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.correlation_pairs(table(spark, sf_dir, "lineitem"), _COLS), 6)


_RANK = "(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)"


@query("SELECT 'l_quantity' AS feature_i, 'l_discount' AS feature_j, round(corr(a, b), 6) AS r FROM (SELECT " + _RANK.format(c="l_quantity") + " AS a, " + _RANK.format(c="l_discount") + " AS b FROM lineitem)")
def corr_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.correlation_pairs(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "spearman"), 6)


@query("""WITH e AS (SELECT c_acctbal AS a, c_nationkey AS b FROM customer), p AS (SELECT sum(sign(x.a - y.a) * sign(x.b - y.b)) / 2 AS s FROM e x, e y),
t AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM e GROUP BY a)) AS ta, (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM e GROUP BY b)) AS tb, (SELECT count(*) * (count(*) - 1) / 2 FROM e) AS n)
SELECT 'a' AS feature_i, 'b' AS feature_j, round(s / sqrt((n - ta) * (n - tb)), 6) AS r FROM p, t""")
def corr_kendall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.correlation_pairs(table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("a"), F.col("c_nationkey").alias("b")), ["a", "b"], "kendall"), 6)


@query(_union([f"SELECT '{c}' AS feature, round(var_pop({c}), 4) AS variance FROM lineitem HAVING var_pop({c}) > 0.0009" for c in _COLS]))
def variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    found, kept = S.variances(df, _COLS), S.variance_filter(df, _COLS, 0.0009)
    return rounded(S.frame(spark, [(c, found[c]) for c in kept], "feature string, variance double"))


@query(_union(["SELECT 'l_orderkey' AS feature"] + [f"SELECT '{c}' FROM lineitem HAVING stddev_samp({c}) / (max({c}) - min({c})) > 0.27" for c in _COLS] + ["SELECT 'l_returnflag'"]))
def scaled_variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = S.scaled_variance_filter(table(spark, sf_dir, "lineitem"), _COLS, "l_orderkey", ["l_returnflag"], 0.27)
    return S.frame(spark, [(c,) for c in kept], "feature string")


@query(_union([f"SELECT '{c}' AS feature, round(corr({c}, l_quantity) ^ 2 / (1 - corr({c}, l_quantity) ^ 2) * (count(*) - 2), 3) AS f FROM lineitem" for c in _COLS[1:]]))
def f_regression_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.test_ranking(table(spark, sf_dir, "lineitem"), _COLS[1:], "l_quantity", "f_regression"), 3)


def _anova(c: str, source: str, y: str) -> str:
    return f"""SELECT '{c}' AS feature, round((sum(n * m * m) - sum(n * m) ^ 2 / sum(n)) / (count(*) - 1) / (sum(n * v) / (sum(n) - count(*))), 3) AS f
  FROM (SELECT {y}, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v FROM {source} GROUP BY 1)"""


@query(_union([_anova(c, "lineitem", "l_returnflag") for c in _COLS]))
def f_classif_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.test_ranking(table(spark, sf_dir, "lineitem"), _COLS, "l_returnflag", "f_classif"), 3)


@query(f"""{_M}, f AS ({_union([f"SELECT '{c}' AS feature, corr({c}, churn) ^ 2 AS f FROM m" for c in _MCOLS])}),
r AS ({_union([f"SELECT '{a}' AS i, '{b}' AS j FROM m HAVING abs(corr({a}, {b})) > 0.5" for a, b in combinations(_MCOLS, 2)])}),
g AS (SELECT DISTINCT CASE WHEN x.f < y.f THEN j ELSE i END AS feature FROM r JOIN f x ON x.feature = i JOIN f y ON y.feature = j)
SELECT feature, CASE WHEN feature IN (SELECT feature FROM g) THEN 0 ELSE 1 END AS "pairwise_pearson_churn_thresh_05_f_regression" FROM f""")
def pairwise_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.pairwise_votes(master(spark, sf_dir), _MCOLS, "churn", "f_regression", "pearson", 0.5)


_VOTE_COLS = ["stat_test_a_tgt_churn", "stat_test_b_tgt_spend", "boruta_target_churn_depth_3", "mb_spend_lasso", "pairwise_pearson_churn_thresh_05_f"]
_VOTES = ["avg(c_acctbal) > 4500", "count(*) % 2 = 0", "max(c_acctbal) > 9500", "min(c_acctbal) < -900", "avg(c_acctbal) < 5000"]
_VOTES_SQL = "v AS (SELECT n_name AS feature, " + ", ".join(f"({x})::INTEGER AS {c}" for x, c in zip(_VOTES, _VOTE_COLS)) + " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vote table of the usual form: nations are its features, figures of their customers its votes."""
    of = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return of.groupBy(F.col("n_name").alias("feature")).agg(*[F.expr(f"cast({x} AS int)").alias(c) for x, c in zip(_VOTES, _VOTE_COLS)])


@query(f"WITH {_VOTES_SQL} SELECT feature, ({' + '.join(_VOTE_COLS[:4])})::INTEGER AS statistical_test_rank FROM v WHERE {' + '.join(_VOTE_COLS[:4])} >= 3")
def useful_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.useful_features(_votes(spark, sf_dir).drop(_VOTE_COLS[4])).select("feature", "statistical_test_rank")


_CHURN, _SPEND = [c for c in _VOTE_COLS if "churn" in c], [c for c in _VOTE_COLS if "spend" in c]
_FINAL = f"""WITH {_VOTES_SQL} SELECT feature, CASE WHEN n_regionkey = 0 THEN 'categorical_fundamental' ELSE 'numerical_fundamental' END AS feature_type, ({' + '.join(_CHURN + _SPEND)})::INTEGER AS final_rank FROM v JOIN nation ON n_name = feature WHERE n_regionkey < 4 AND n_nationkey <> 18"""


def _final(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    of = {k: [r.n_name for r in table(spark, sf_dir, "nation").filter(k).select("n_name").collect()] for k in ("n_regionkey = 0", "n_regionkey IN (1, 2, 3)", "n_nationkey <> 18")}
    typed = S.feature_types(_votes(spark, sf_dir), of["n_regionkey = 0"], of["n_regionkey IN (1, 2, 3)"], None)
    return S.final_ranking(typed, {"classification_targets": ["churn"], "regression_targets": ["spend"]}, of["n_nationkey <> 18"], **how)


@query(f"SELECT * FROM ({_FINAL}) ORDER BY final_rank DESC, feature DESC LIMIT 7")
def final_ranking_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir, top=7)


@query(f"SELECT * FROM ({_FINAL}) WHERE final_rank >= 4")
def final_ranking_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir, threshold=4)


@query(f"WITH {_VOTES_SQL} SELECT feature FROM v WHERE {_VOTE_COLS[4]} >= 1")
def filtered_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.filtered_pairwise(_votes(spark, sf_dir), {"classification_targets": ["churn"]}, ["pearson"]).select("feature")


@query(f"WITH {_VOTES_SQL} SELECT mb_spend_lasso AS value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM v), 4)::DOUBLE AS percent FROM v GROUP BY 1")
def vote_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.vote_shares(_votes(spark, sf_dir), "mb_spend_lasso"))


@query("""WITH c AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2), k AS (SELECT y AS k FROM c UNION SELECT p FROM c),
f AS (SELECT k, coalesce((SELECT sum(n) FROM c WHERE y = k), 0) AS ny, coalesce((SELECT sum(n) FROM c WHERE p = k), 0) AS np, coalesce((SELECT sum(n) FROM c WHERE y = k AND p = k), 0) AS hit FROM k)
SELECT round(sum(2.0 * hit / (ny + np) * np) / sum(np), 6)::DOUBLE AS f1 FROM f""")
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.weighted_f1_by_prediction(table(spark, sf_dir, "labels"), "quality", "toxic"), 6)


_BIN = "CASE WHEN b = a THEN 0 ELSE least(floor(({c} - a) / (b - a) * 16), 15) END"


def _mi(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mi FROM (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM
  (SELECT {_BIN.format(c=c)} AS x, l_returnflag AS y, count(*)::DOUBLE AS n FROM lineitem, (SELECT min({c}) AS a, max({c}) AS b FROM lineitem) GROUP BY 1, 2))"""


@query(_union([_mi(c) for c in _COLS]))
def mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.mutual_information(table(spark, sf_dir, "lineitem"), _COLS, "l_returnflag"), 6)


@query(f"WITH s AS ({_union([_mi(c) for c in _COLS])}) SELECT feature, (row_number() OVER (ORDER BY mi DESC, feature) <= 2)::INTEGER AS stat_test_mi_tgt_flag FROM s")
def mutual_information_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rounded(S.mutual_information(table(spark, sf_dir, "lineitem"), _COLS, "l_returnflag"), 6)
    return S.top_percent(scores, "mi", 50, "stat_test_mi_tgt_flag")


_PSI = "(list_sum(list_transform(range(1, {}), lambda i: 1.0 / i)) - 0.5772156649015329)"


def _nearest(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(greatest(0, {_PSI.format("max(t)")} + avg({_PSI.format("least(3, size - 1)")} - {_PSI.format("size")} - {_PSI.format("m")})), 6)::DOUBLE AS mi FROM
  (SELECT i, size, t, CASE WHEN r > 0 THEN (SELECT count(*) FROM d b WHERE abs(b.{c} - n.x) < r) ELSE (SELECT count(*) FROM d b WHERE b.{c} = n.x) END AS m FROM
    (SELECT a.i, any_value(a.{c}) AS x, any_value(a.size) AS size, any_value(a.t) AS t, list_sort(list(abs(a.{c} - b.{c})))[least(3, any_value(a.size) - 1)] AS r FROM d a JOIN d b ON a.y = b.y AND a.i <> b.i GROUP BY a.i) n)"""


@query(f"""WITH e AS (SELECT c_custkey AS i, c_mktsegment AS y, c_acctbal, c_nationkey::DOUBLE AS c_nationkey, (c_custkey % 7 + length(c_mktsegment))::DOUBLE AS mixed, count(*) OVER (PARTITION BY c_mktsegment) AS size FROM customer),
d AS (SELECT *, count(*) OVER () AS t FROM e WHERE size > 1) {_union([_nearest(c) for c in ("c_acctbal", "c_nationkey", "mixed")])}""")
def neighbour_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").withColumn("mixed", F.col("c_custkey") % 7 + F.length("c_mktsegment"))
    return rounded(nearest_information(df, ["c_acctbal", "c_nationkey", "mixed"], "c_mktsegment"), 6)
