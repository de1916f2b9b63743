"""Queries of cleaning, outliers, joins, time series and dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import cleaning as C
from tabwright.operators import dictionaries as D
from tabwright.operators import joins as J
from tabwright.operators import outliers as O
from tabwright.operators import timeseries as T
from tabwright.queries.base import MASTER_SQL, master, query, rounded
from tabwright.session import table

_M = f"WITH m AS ({MASTER_SQL})"


@query(f"""{_M}, q AS (SELECT quantile_cont(c_acctbal, 0.95) AS a, quantile_cont(total_spend, 0.95) AS b FROM m),
bad AS (SELECT DISTINCT customer_id FROM m, q WHERE c_acctbal > a OR total_spend > b)
SELECT customer_id, round(c_acctbal, 2) AS c_acctbal, round(total_spend, 2) AS total_spend FROM m WHERE customer_id NOT IN (SELECT customer_id FROM bad)""")
def outlier_quantile_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _, _ = O.outlier_detection(master(spark, sf_dir), ["c_acctbal", "total_spend"], 0.95, "customer_id")
    return kept.select("customer_id", F.round("c_acctbal", 2).alias("c_acctbal"), F.round("total_spend", 2).alias("total_spend"))


@query(f"""{_M}, q AS (SELECT quantile_cont(c_acctbal, 0.95) AS a, quantile_cont(total_spend, 0.95) AS b FROM m)
SELECT DISTINCT customer_id FROM m, q WHERE c_acctbal > a OR total_spend > b""")
def outlier_quantile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.outlier_detection(master(spark, sf_dir), ["c_acctbal", "total_spend"], 0.95, "customer_id")[1].select("customer_id").distinct()


_KEYS, _LINE = "l_orderkey, l_linenumber, l_partkey", ["l_orderkey", "l_linenumber", "l_partkey"]


def _ranges(name: str, bounds: str, made) -> None:
    """Three queries: what each method makes of the bounds on two columns of lineitem."""
    out = {c: f"coalesce({c} < {c}_lo OR {c} > {c}_hi, FALSE)" for c in ("l_quantity", "l_discount")}
    sql = {
        "set_nan": f"SELECT {_KEYS}, " + ", ".join(f"round(CASE WHEN NOT {t} THEN {c} END, 4) AS {c}" for c, t in out.items()) + " FROM lineitem, b",
        "drop": f"SELECT {_KEYS}, " + ", ".join(f"round({c}, 4) AS {c}" for c in out) + " FROM lineitem, b WHERE NOT (" + " OR ".join(out.values()) + ")",
        "clip": f"SELECT {_KEYS}, " + ", ".join(f"round(CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END, 4) AS {c}" for c in out) + " FROM lineitem, b",
    }
    for method, text in sql.items():
        def run(spark: SparkSession, sf_dir: str, method: str = method) -> DataFrame:
            return rounded(made(table(spark, sf_dir, "lineitem").select(*_LINE, "l_quantity", "l_discount"), method))

        run.__name__ = f"{name}_outliers_{method}"
        query(f"WITH b AS ({bounds}) {text}")(run)


_ranges("range", "SELECT 5.0 AS l_quantity_lo, 45.0 AS l_quantity_hi, 0.01 AS l_discount_lo, 0.09 AS l_discount_hi", lambda df, m: O.range_outliers(df, {"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09)}, m))
_ranges("quantile", "SELECT " + ", ".join(f"quantile_cont({c}, 0.1) AS {c}_lo, quantile_cont({c}, 0.9) AS {c}_hi" for c in ("l_quantity", "l_discount")) + " FROM lineitem", lambda df, m: O.quantile_outliers(df, {"l_quantity": (0.1, 0.9), "l_discount": (0.1, 0.9)}, m))
_ranges("iqr", "SELECT " + ", ".join(f"quantile_cont({c}, 0.25) - 0.3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, quantile_cont({c}, 0.75) + 0.3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi" for c in ("l_quantity", "l_discount")) + " FROM lineitem", lambda df, m: O.iqr_outliers(df, ["l_quantity", "l_discount"], multiplier=0.3, method=m))


@query(f"SELECT {_KEYS}, CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem")
def outlier_rule_one_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.apply_outlier_rule(table(spark, sf_dir, "lineitem").select(*_LINE, "l_quantity"), "drop", {"l_quantity": (None, 40.0)})


_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS n FROM lineitem) WHERE n = 1")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _ORDER.split(", ")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER.replace(',', ' DESC,')} DESC) AS n FROM lineitem) WHERE n = 1")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _ORDER.split(", "), "last").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def dedup_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], keep=False).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN value END, user_id::DOUBLE) AS a, event_type AS b FROM events")
def merge_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("x"), F.col("user_id").alias("y"), F.col("event_type").alias("z"))
    return C.merge_same_names(df.toDF("event_id", "a", "a", "b"))


@query("SELECT event_id, value FROM events")
def null_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", "value", F.when(k % 10 == 0, 1).alias("mostly_null"), F.lit(None).cast("string").alias("all_null"))
    return C.drop_null_columns(df, 80)


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("SELECT c_custkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{s}' AND c_custkey % 7 <> 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS c_mktsegment_{s.lower()}" for s in _SEGMENTS) + " FROM customer")
def onehot_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return C.one_hot(df, ["c_mktsegment"], keep=["c_custkey"])


@query("""WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind FROM events)
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM e)), 4) AS value, coalesce(kind, (SELECT kind FROM e WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS kind FROM e""")
def impute_mean_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", F.when(k % 7 != 0, F.col("value")).alias("value"), F.when(k % 11 == 0, "nan").otherwise(F.col("event_type")).alias("kind"))
    return rounded(C.impute(df, ["value"], ["kind"]))


@query("""WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind FROM events)
SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM e)), 4) AS value, coalesce(kind, 'none') AS kind FROM e""")
def impute_median_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", F.when(k % 7 != 0, F.col("value")).alias("value"), F.when(k % 11 != 0, F.col("event_type")).alias("kind"))
    return rounded(C.impute(df, ["value"], ["kind"], "median", "constant", "none"))


@query(f"{_M} SELECT customer_id, churn FROM m WHERE churn = 0")
def churn_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.filter_churned(master(spark, sf_dir))[0].select("customer_id", "churn")


@query(f"{_M} SELECT DISTINCT customer_id FROM m WHERE churn <> 0")
def churn_dropped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.filter_churned(master(spark, sf_dir), apply="False")[1]


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def split_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    poor = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return C.split_by_ids(table(spark, sf_dir, "orders"), poor, "o_custkey")[0].select("o_orderkey", "o_custkey")


@query(f"""{_M} SELECT customer_id, round(coalesce(total_spend, 0) + coalesce(avg_spend, 0), 6) AS s, round((coalesce(total_spend, 0) + coalesce(c_acctbal, 0)) / nullif((total_spend IS NOT NULL)::INT + (c_acctbal IS NOT NULL)::INT, 0), 6) AS m,
  round(least(c_acctbal, avg_spend), 6) AS lo, round(greatest(c_acctbal, avg_spend), 6) AS hi FROM m""")
def row_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = {"s": (["total_spend", "avg_spend"], "sum"), "m": (["total_spend", "c_acctbal"], "mean"), "lo": (["c_acctbal", "avg_spend"], "min"), "hi": (["c_acctbal", "avg_spend"], "max")}
    return rounded(C.row_aggregate(master(spark, sf_dir), {k: {"agg_cols": c, "agg_type": t} for k, (c, t) in how.items()}).select("customer_id", *how), 6)


@query(f"{_M} SELECT customer_id::VARCHAR AS customer_id, round(c_acctbal, 4) AS c_acctbal, " + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END::DOUBLE AS c_mktsegment_{s.lower()}" for s in _SEGMENTS) + ", c_nationkey::DOUBLE AS c_nationkey, churn::INTEGER AS churn FROM m")
def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = master(spark, sf_dir).select(F.col("customer_id").alias("Customer ID"), F.col("c_acctbal").cast("string").alias("C AcctBal"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey"), F.col("churn").cast("string").alias("Churn "), F.lit(None).cast("string").alias("empty"))
    df, types = C.format_master(raw, "Customer ID")
    return rounded(C.encode(df, types)["mdt_encoded"])


@query("SELECT c_custkey::VARCHAR AS k, c_mktsegment, n, n_name FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey LEFT JOIN (SELECT n_nationkey, n_name FROM nation) ON c_custkey = n_nationkey")
def join_dfs_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    b = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return J.join_left("k", a, b, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name"))


@query("""WITH a AS (SELECT p_brand AS feature, count(*) AS votes_a FROM part WHERE p_size > 25 GROUP BY 1), b AS (SELECT p_type AS feature, count(*) AS votes_b FROM part GROUP BY 1 UNION ALL SELECT DISTINCT p_brand, 1 FROM part WHERE p_size < 3)
SELECT feature, coalesce(votes_a, 0) AS votes_a, coalesce(votes_b, 0) AS votes_b FROM a FULL JOIN b USING (feature)""")
def join_rankings_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    a = p.filter("p_size > 25").groupBy(F.col("p_brand").alias("feature")).agg(F.count("*").alias("votes_a"))
    b = p.groupBy(F.col("p_type").alias("feature")).agg(F.count("*").alias("votes_b")).unionByName(p.filter("p_size < 3").select(F.col("p_brand").alias("feature"), F.lit(1).cast("bigint").alias("votes_b")).distinct())
    return J.join_rankings("feature", a, b)


@query("""WITH s AS (SELECT user_id, ts, value, lag(value) OVER w AS pred, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, value))
SELECT user_id, ts, round(value, 4) AS value, round(pred, 4) AS pred FROM s WHERE n > 1""")
def lag_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.lag_prediction(table(spark, sf_dir, "events").select("user_id", "ts", "value"), "ts", "value", "user_id"))


@query("""WITH t AS (SELECT avg(value) AS pred FROM events WHERE user_id % 2 = 0), b AS (SELECT value AS y, pred AS p FROM events, t WHERE user_id % 2 = 1)
SELECT round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2, round(avg(abs(y - p) / nullif(y, 0)) * 100, 4) AS mape, round(avg((y - p) * (y - p)), 4) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM b""")
def mean_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    found = T.regression_metrics(T.mean_prediction(e.filter("user_id % 2 = 0"), e.filter("user_id % 2 = 1"), "value"), "value", "pred")
    return found.select(F.round("r2", 6).alias("r2"), *[F.round(c, 4).alias(c) for c in ("mape", "mse", "rmse")])


@query("""WITH s AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events), g AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 4 HOUR)) AS ts FROM s),
v AS (SELECT date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1) SELECT g.ts, n FROM g LEFT JOIN v USING (ts)""")
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.count("*").alias("n"))
    return T.fill_gaps(hourly, "ts")


@query("SELECT user_id, round(stddev_pop(value) / avg(value), 6) AS cv FROM events GROUP BY 1")
def coefficient_of_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(T.variation(F.col("value")), 6).alias("cv"))


@query("""WITH RECURSIVE e(tag, dep) AS (SELECT DISTINCT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey UNION SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT r_name, 'ASIA' FROM region),
r(tag, dep) AS (SELECT tag, dep FROM e UNION SELECT r.tag, e.dep FROM r JOIN e ON r.dep = e.tag) SELECT tag, dep FROM r WHERE tag <> dep""")
def tag_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("tag"), F.col("c_nationkey").alias("n_nationkey")).distinct().join(nation, "n_nationkey").select("tag", F.col("n_name").alias("dep")).distinct()
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("tag"), F.col("r_name").alias("dep"))
    return D.transitive_closure(segments.unionByName(nations).unionByName(region.select(F.col("r_name").alias("tag"), F.lit("ASIA").alias("dep"))), "tag", "dep")


@query("""SELECT unnest(['null:p_name', 'surplus', 'illegal', 'unknown:p_type']) AS rule, unnest([count(*) FILTER (p_partkey % 9 = 0), count(*) - count(DISTINCT (p_brand, p_size)), 0, count(*) FILTER (p_type NOT IN (SELECT min(p_type) FROM part))]) AS n FROM part""")
def dictionary_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    first = p.agg(F.min("p_type")).first()[0]
    p = p.withColumns({"p_name": F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")), "p_brand": F.col("p_brand")})
    return D.violations(p, ["p_name"], ["p_brand", "p_size"], "p_brand", {"p_type": (first,)})


_TAGS = """WITH RECURSIVE t AS (SELECT 'tag ' || p_partkey AS tag, CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 60 = 1 THEN 'name, twice' ELSE 'name ' || p_partkey END AS name,
  CASE WHEN p_partkey % 5 < 3 THEN 'on_off' WHEN p_partkey % 5 = 3 THEN 'input' ELSE 'odd' END AS kind,
  CASE WHEN p_partkey % 4 = 0 THEN 'tag ' || (p_partkey // 2) || ', tag ' || (p_partkey + 1) WHEN p_partkey % 4 = 1 THEN ' tag ' || (p_partkey - 1) || ' ,' WHEN p_partkey % 4 = 2 THEN 'tag 0' END AS deps FROM part),
d AS (SELECT tag, dep FROM (SELECT tag, trim(unnest(string_split(deps, ','))) AS dep FROM t) WHERE dep <> ''),
r(tag, dep) AS (SELECT DISTINCT tag, dep FROM d UNION SELECT r.tag, d.dep FROM r JOIN d ON r.dep = d.tag)"""


@query(f"""{_TAGS} SELECT unnest(['null:tag', 'null:name', 'null:tag_type', 'null:data_type', 'surplus:tag', 'surplus:name', 'illegal', 'unknown:tag_type', 'unknown:data_type', 'dep_unknown', 'dep_kind', 'cycle']) AS rule,
unnest([0, (SELECT count(*) FROM t WHERE name IS NULL), 0, 0, 0, (SELECT count(*) - count(DISTINCT coalesce(name, '-')) FROM t), 0, (SELECT count(*) FROM t WHERE kind = 'odd'), 0,
  (SELECT count(*) FROM d WHERE dep NOT IN (SELECT tag FROM t)), (SELECT count(*) FROM d JOIN t ON d.dep = t.tag WHERE kind <> 'on_off'), (SELECT count(*) FROM r WHERE tag = dep)]) AS n""")
def tag_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    tag = lambda x: F.concat(F.lit("tag "), x.cast("string"))
    deps = F.when(k % 4 == 0, F.concat(tag(F.expr("p_partkey div 2")), F.lit(", "), tag(k + 1))).when(k % 4 == 1, F.concat(F.lit(" "), tag(k - 1), F.lit(" ,"))).when(k % 4 == 2, "tag 0")
    kind = F.when(k % 5 < 3, "on_off").when(k % 5 == 3, "input").otherwise("odd")
    name = F.when(k % 50 == 0, F.lit(None).cast("string")).when(k % 60 == 1, "name, twice").otherwise(F.concat(F.lit("name "), k.cast("string")))
    rest = [F.lit(v).alias(c) for c, v in (("data_type", "int64"), ("unit", "m"), ("range_min", 0), ("range_max", 1), ("derived", False))]
    return D.tag_violations(table(spark, sf_dir, "part").select(tag(k).alias("tag"), name.alias("name"), kind.alias("tag_type"), deps.alias("on_off_dependencies"), *rest))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 100, 'ATLANTIS'")
def add_absent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = D.filter_rows(table(spark, sf_dir, "nation"), "n_regionkey", 2).select("n_nationkey", "n_name")
    new = spark.createDataFrame([(100, "ATLANTIS")], "n_nationkey int, n_name string").unionByName(n)
    return D.add_absent(n, new, "n_nationkey")


@query("SELECT 'kind' AS col, round(avg((event_id % 11 = 0)::INT) * 100, 4) AS percent FROM events UNION ALL SELECT 'value', round(avg((event_id % 7 = 0)::INT) * 100, 4) FROM events UNION ALL SELECT 'event_id', 0.0 FROM events HAVING true")
def null_percents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", F.when(k % 11 != 0, F.col("event_type")).alias("kind"), F.when(k % 7 != 0, F.col("value")).alias("value"))
    return rounded(spark.createDataFrame([(c, v) for c, v in C.null_percent(df).items()], "col string, percent double"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def id_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select("c_custkey")
    return ids.subtract(table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")))


@query("SELECT p_brand, p_type, p_partkey, p_size, round(p_retailprice, 2) AS p_retailprice FROM part WHERE p_size > 40 ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.filter_rows(table(spark, sf_dir, "part"), "p_size", lambda c: c > 40)
    return found.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20).select("p_brand", "p_type", "p_partkey", "p_size", F.round("p_retailprice", 2).alias("p_retailprice"))


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.operators.geo import join_bounded

    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return join_bounded([a, b])


@query("""SELECT event_id, kind, mass FROM (SELECT event_id, event_type AS kind, (value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events) AS m FROM events) t, LATERAL (SELECT round(t.m, 6) AS mass)""")
def minmax_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.operators.models import fit_scaler, scale

    df = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"), F.col("value").alias("mass"))
    return rounded(scale(df, fit_scaler(df, ["mass"], "minmax")), 6)


@query("SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events), 6) AS value FROM events")
def standard_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.operators.models import fit_scaler, scale

    df = table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(scale(df, fit_scaler(df, ["value"])), 6)


def _orders_dict() -> D.DataDict:
    rows = [("o_orderkey", "int", "N", "N", "Y"), ("o_custkey", "str", "Y", "N", "N"), ("o_totalprice", "float", "Y", "N", "N"), ("o_orderdate", "timestamp", "Y", "N", "N"), ("o_orderstatus", "str", "N", "Y", "N")]
    return D.create_data_dict([{"column_id": c, "feature_group": "orders", "business_name": c, "data_type": t, "churn:feature": f, "churn:target": y, "churn:key": k} for c, t, f, y, k in rows], {"use_case_id": "churn"})


@query("SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, round(o_totalprice, 2)::DOUBLE AS o_totalprice, o_orderdate::TIMESTAMP AS o_orderdate, o_orderstatus FROM orders")
def dictionary_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).cast("string").alias("o_totalprice"), F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderstatus")
    return D.enforce_dictionary_schema(text, _orders_dict())


@query("SELECT o_orderkey, l_linenumber AS o_custkey FROM (SELECT l_orderkey AS o_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS n FROM lineitem) WHERE n = 1")
def dictionary_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("o_custkey"))
    return D.deduplicate_by_dictionary(lines, _orders_dict(), ["o_custkey"], "last")


_NATIONS = """WITH d AS (SELECT n_name AS id, n_nationkey AS k, CASE WHEN n_nationkey % 4 <> 0 THEN lower(r_name) || ' ' || n_nationkey END AS business FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query(f"""{_NATIONS} SELECT 'feature' AS mark, id AS col FROM d WHERE k % 2 = 0 UNION ALL SELECT 'number', id FROM d WHERE k % 2 = 0 AND k % 3 < 2
UNION ALL SELECT 'key', id FROM d WHERE k = 1 UNION ALL SELECT 'target', id FROM d WHERE k = 3 UNION ALL SELECT 'date', NULL UNION ALL SELECT 'name of ' || id, coalesce(business, id) FROM d
UNION ALL SELECT 'late', id FROM d WHERE k > 20 UNION ALL SELECT 'odd', id FROM d WHERE k % 7 = 3""")
def dictionary_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary whose columns are the nations: features, marks, names and conditions."""
    k = F.col("n_nationkey")
    mark = lambda c: F.when(c, "Y").otherwise("N")
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("n_name").alias("column_id"), F.col("r_name").alias("feature_group"), F.when(k % 4 != 0, F.concat(F.lower("r_name"), F.lit(" "), k.cast("string"))).alias("business_name"),
                       F.element_at(F.array(F.lit("int"), F.lit("Float"), F.lit("str")), k % 3 + 1).alias("data_type"), mark(k % 2 == 0).alias("uc:feature"), mark(k == 3).alias("uc:target"), mark(k == 1).alias("uc:key"), k.alias("place"))
    d = D.create_data_dict(rows, {"use_case_id": "uc"})
    found = [("feature", c) for c in d.features()] + [("number", c) for c in d.features(["float", "int"])] + [(m, d.variable(m)) for m in ("key", "target", "date")]
    found += [(f"name of {c}", d.name(c)) for c in d.keys()] + [("late", c) for c in d.select("place", lambda v: v > 20)] + [("odd", c) for c in d.select("place", lambda v: v % 7 == 3)]
    return spark.createDataFrame(found, "mark string, col string")


@query("SELECT c_custkey, c_name, c_acctbal, s_name, s_acctbal FROM customer FULL JOIN (SELECT s_suppkey AS c_custkey, s_name, s_acctbal FROM supplier) USING (c_custkey)")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name", "s_acctbal")
    return J.side_by_side("c_custkey", a, b)


_LAGGED = "SELECT value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts, value) AS p FROM events WHERE user_id % 2 = {}"
_SCORED = """SELECT '{0}' AS model, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2, round(avg(abs(y - p) / nullif(y, 0)) * 100, 4) AS mape, round(avg((y - p) * (y - p)), 4) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
(SELECT round(stddev_pop(value) / avg(value), 6) FROM events WHERE user_id % 2 = {1}) AS cv FROM ({2}) WHERE p IS NOT NULL"""


@query(" UNION ALL ".join([_SCORED.format("mean_test", 1, "SELECT value AS y, (SELECT avg(value) FROM events WHERE user_id % 2 = 0) AS p FROM events WHERE user_id % 2 = 1"), _SCORED.format("lag_test", 1, _LAGGED.format(1)), _SCORED.format("lag_train", 0, _LAGGED.format(0))]))
def baseline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    found = T.baseline_table(e.filter("user_id % 2 = 0"), e.filter("user_id % 2 = 1"), "ts", "value", "user_id")
    return found.select("model", F.round("r2", 6).alias("r2"), F.round("mape", 4).alias("mape"), F.round("mse", 4).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("cv", 6).alias("cv"))


@query("SELECT event_id, round(value, 4) AS value, round(lag(value) OVER (ORDER BY ts, value), 4) AS pred FROM events QUALIFY row_number() OVER (ORDER BY ts, value) > 1")
def lag_of_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.lag_prediction(table(spark, sf_dir, "events").select("event_id", "ts", "value"), "ts", "value").select("event_id", "value", "pred"))


@query("SELECT event_id, ts, value FROM events WHERE value IS NOT NULL AND event_id % 5 <> 0 AND ts > TIMESTAMP '2024-01-10'")
def complete_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    return C.select_cols(C.drop_nulls(T.after(e, "ts", "2024-01-10"), ["value"]), ["event_id", "ts", "value"])


@query("SELECT c_custkey, c_acctbal, c_nationkey FROM customer")
def columns_without_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(F.col("c_name").alias("Unnamed: 0"), "c_acctbal", "c_mktsegment", "c_nationkey", "c_custkey")
    return C.id_first(C.remove_cols(C.drop_unnamed(raw), ["c_mktsegment", "absent"]), "c_custkey")
