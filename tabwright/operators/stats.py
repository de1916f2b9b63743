"""Correlations, test statistics and feature votes; all data-sized work is one wide aggregation, the rest small frames by feature."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.cleaning import aggregate
from tabwright.operators.ordering import numbered
from tabwright.written import cut


def _d(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def variances(df: DataFrame, cols: list[str]) -> dict[str, float]:
    return aggregate(df, {c: F.var_pop(_d(c)) for c in cols})


def variance_filter(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """Columns whose population variance is above the threshold."""
    return [c for c, v in variances(df, cols).items() if v is not None and v > threshold]


def scaled_deviations(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Sample standard deviation of each column scaled to [0, 1]; 0 for a constant one."""
    found = aggregate(df, {c: F.stddev_samp(_d(c)) / F.nullif(F.max(_d(c)) - F.min(_d(c)), F.lit(0.0)) for c in cols})
    return {c: 0.0 if v is None or v != v else v for c, v in found.items()}


def scaled_variance_filter(df: DataFrame, cols: list[str], id_col: str, targets: list[str], threshold: float) -> list[str]:
    """The id, the columns that vary enough once scaled, and the targets, each once."""
    kept = [c for c, v in scaled_deviations(df, cols).items() if v > threshold]
    return list(dict.fromkeys([id_col, *kept, *targets]))


#: Distinct values that one task puts in order.
VALUES_A_RANGE = 100_000


def _placed_by(value: str, edges: np.ndarray):
    """Adds the number of each value's range, found among the sorted edges."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(_range=np.searchsorted(edges, f[value].to_numpy(float), side="left").astype("int32"))

    return run


def running_totals(counts: DataFrame, value: str, count: str, values_a_range: int = VALUES_A_RANGE) -> DataFrame:
    """``counts`` (one row a value) with ``_upto``, the sum of counts up to each value. Spark deals the values into ranges and sorts them
    within; sums by range are added up apart, one row a range, and joined back."""
    n = counts.count()
    if n <= values_a_range:
        return counts.withColumn("_upto", F.sum(count).over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    edges = [float("-inf"), *sorted(set(counts.approxQuantile(value, [i / -(-n // values_a_range) for i in range(1, -(-n // values_a_range))], 1 / max(1000, n // values_a_range * 4))))]
    placed = counts.mapInPandas(_placed_by(value, np.array(edges)), T.StructType([*counts.schema.fields, T.StructField("_range", T.IntegerType())]))
    before = placed.groupBy("_range").agg(F.sum(count).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.sum(count).over(Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_own", own).join(F.broadcast(before), "_range").withColumn("_upto", F.col("_own") + F.col("_before")).drop("_range", "_own", "_before")


def average_ranks(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each column's ranks, equal values sharing their mean rank; nulls stay null. Ranks are running totals of counts by distinct value."""
    for c in cols:
        counts = df.filter(F.col(f"`{c}`").isNotNull()).groupBy(_d(c).alias("_v")).count()
        ranks = running_totals(counts, "_v", "count").select("_v", (F.col("_upto") - (F.col("count") - 1) / 2).cast("double").alias("_r"))
        df = df.join(ranks, _d(c) == F.col("_v"), "left").drop("_v").withColumn(c, F.col("_r")).drop("_r")
    return df


def correlation_pairs(df: DataFrame, cols: list[str], method: str | Callable[[DataFrame, str, str], float | None] = "pearson") -> DataFrame:
    """(feature_i, feature_j, r) for each pair of columns in their order; rows that lack either are left out of a pair.

    pearson and point_biserial are one aggregation; spearman ranks first; kendall (tau-b) counts by merging within ranges of values. A method that is a
    function takes (df, a, b) and returns r.
    """
    spark = df.sparkSession
    pairs = list(combinations(cols, 2))
    if callable(method):
        rows = [(a, b, method(df, a, b)) for a, b in pairs]
    elif method == "kendall":
        rows = [(a, b, kendall(df, a, b)) for a, b in pairs]
    elif method == "spearman":
        rows = []
        for a, b in pairs:
            ranked = average_ranks(df.select(_d(a).alias("a"), _d(b).alias("b")).na.drop(), ["a", "b"])
            rows.append((a, b, ranked.agg(_corr("a", "b")).first()[0]))
    elif method in ("pearson", "point_biserial"):
        found = aggregate(df, {f"{i}": _corr(a, b) for i, (a, b) in enumerate(pairs)})
        rows = [(a, b, found[f"{i}"]) for i, (a, b) in enumerate(pairs)]
    else:
        raise ValueError(f"method {method!r} is not known")
    return frame(spark, [(a, b, None if r is None or r != r else float(r)) for a, b, r in rows], "feature_i string, feature_j string, r double")


def _corr(a: str, b: str) -> Column:
    """From covariance and deviations: null where a column is constant, for which ``corr`` itself divides by zero under ANSI mode."""
    both = _d(a).isNotNull() & _d(b).isNotNull()
    x, y = F.when(both, _d(a)), F.when(both, _d(b))
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


#: Distinct pairs of values that one task of Kendall's tau puts in order, and parts that a range is split into by one pass.
CELLS_A_RANGE, PARTS = 100_000, 64


def _concordance(b: np.ndarray, n: np.ndarray) -> float:
    """Sum over all pairs of n * m, negative where the later one has the smaller b, by merge counting; no two b are equal."""
    b, n = np.argsort(np.argsort(b)), n.astype(float)
    at, total, width = np.arange(len(b)), 0.0, 1
    while width < len(b):
        group, right = at // (2 * width), at // width % 2 == 1
        order = np.lexsort((b, group))
        g, w, r = group[order], n[order], right[order]
        left = np.where(r, 0.0, w)
        upto = np.cumsum(left)
        start, end = np.searchsorted(g, g), np.searchsorted(g, g, side="right")
        before = np.r_[0.0, upto]
        total += float((w * (2 * before[at] - before[start] - before[end]))[r].sum())
        width *= 2
    return total


def _between_parts(part: np.ndarray, n: np.ndarray) -> float:
    """Sum over all pairs, in order, of n * m: negative where the later one has the smaller part, and 0 within a part."""
    total, n = 0.0, n.astype(float)
    for p in np.unique(part):
        before = np.cumsum(np.where(part < p, n, np.where(part > p, -n, 0.0)))
        total += float((n * before)[part == p].sum())
    return total


def kendall(df: DataFrame, a: str, b: str, cells_a_range: int = CELLS_A_RANGE, parts: int = PARTS) -> float | None:
    """Tau-b over any number of rows, from counts of distinct (a, b), with no more than ``cells_a_range`` of them in a task.

    Ties are broken at first, equal a by b and equal b by a: then a pair of either kind counts as concordant, and their number is taken off again,
    from counts by value. In the order of a, ranges of ``cells_a_range`` are counted by merging, one to a task. Pairs of different ranges are
    counted level by level, as deep as the ranges' number has digits to the base ``parts``: in the order of b, blocks of one task count pairs of
    different digits among ranges that share the higher digits, and what blocks hold of each digit is added up from block to block.
    """
    cells = cut(df.select(_d(a).alias("a"), _d(b).alias("b")).na.drop().groupBy("a", "b").agg(F.count("*").alias("n")))
    n_cells, n, squares = cells.agg(F.count("*"), F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
    if not n_cells:
        return None
    placed = cut(numbered(cells, "a", "b").withColumnRenamed("_at", "at").withColumn("leaf", F.expr(f"at div {cells_a_range}")))

    def of_leaf(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("at")
        by_b = np.lexsort((f["at"].to_numpy(), f["b"].to_numpy()))
        return pd.DataFrame({"s": [_concordance(np.argsort(by_b), f["n"].to_numpy())]})

    s = placed.groupBy("leaf").applyInPandas(of_leaf, "s double").agg(F.sum("s")).first()[0]
    leaves, width = -(-n_cells // cells_a_range), 1
    while width < leaves:
        group, part = F.expr(f"leaf div {width * parts}"), F.expr(f"leaf div {width} % {parts}").cast("int")
        ordered = numbered(placed.select(group.alias("group"), part.alias("part"), "b", "at", "n"), "group", "b", "at")
        blocks = ordered.withColumn("block", F.expr(f"_at div {cells_a_range}"))

        def of_block(f: pd.DataFrame) -> pd.DataFrame:
            f = f.sort_values("_at")
            out = []
            for g, own in f.groupby("group"):
                p, w = own["part"].to_numpy(), own["n"].to_numpy()
                out.append((g, own["block"].iloc[0], _between_parts(p, w), np.bincount(p, w, parts).tolist()))
            return pd.DataFrame(out, columns=["group", "block", "s", "held"])

        found = cut(blocks.select("group", "part", "n", "block", "_at").groupBy("block").applyInPandas(of_block, "group bigint, block bigint, s double, held array<double>"))
        before = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        held = [F.col("held")[i] for i in range(parts)]
        sums = F.array(*[F.coalesce(F.sum(x).over(before), F.lit(0.0)) for x in held])
        summed = found.withColumn("sums", sums).withColumn("total", F.aggregate("sums", F.lit(0.0), lambda t, x: t + x))
        # of each digit: what earlier blocks hold of smaller digits less what they hold of larger ones
        across = F.aggregate(F.zip_with("held", "sums", lambda h, x: F.struct(h.alias("h"), x.alias("x"))), F.struct(F.lit(0.0).alias("less"), F.lit(0.0).alias("s")), lambda t, e: F.struct((t.less + e.x).alias("less"), (t.s + e.h * (2 * t.less + e.x - F.col("total"))).alias("s")), lambda t: t.s)
        s += summed.agg(F.sum(F.col("s") + across)).first()[0]
        width *= parts
    same = [cells.groupBy(c).agg(F.sum("n").cast("double").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).first()[0] for c in ("a", "b")]
    s -= sum((t - squares) / 2 for t in same)
    total, ties = n * (n - 1) / 2, [(t - n) / 2 for t in same]
    spread = ((total - ties[0]) * (total - ties[1])) ** 0.5
    return s / spread if spread else None


def over_threshold(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.filter(F.abs("r") > threshold)


def f_regression(df: DataFrame, cols: list[str], target: str) -> dict[str, float | None]:
    """F of a simple regression of the target on each column: r2 / (1 - r2) * (n - 2)."""
    y = _d(target)
    exprs = {}
    for c in cols:
        r2 = F.pow(_corr(c, target), 2)
        exprs[c] = r2 / F.nullif(1 - r2, F.lit(0.0)) * (F.count(F.when(_d(c).isNotNull() & y.isNotNull(), 1)) - 2)
    return aggregate(df, exprs)


def f_classif(df: DataFrame, cols: list[str], target: str) -> dict[str, float | None]:
    """One-way analysis of variance of each column over the target's classes, from counts, means and variances by class."""
    own = df.filter(F.col(f"`{target}`").isNotNull()).groupBy(F.col(f"`{target}`").alias("_y")).agg(*[x for i, c in enumerate(cols) for x in (F.count(_d(c)).alias(f"n{i}"), F.avg(_d(c)).alias(f"m{i}"), F.var_pop(_d(c)).alias(f"v{i}"))])
    exprs = {}
    for i, c in enumerate(cols):
        n, m, v = F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"v{i}")
        total, k = F.sum(n), F.count_if(n > 0)
        between = F.sum(n * m * m) - F.pow(F.sum(n * m), 2) / total
        exprs[c] = F.when((total > k) & (k > 1), (between / (k - 1)) / F.nullif(F.sum(n * v) / (total - k), F.lit(0.0)))
    return aggregate(own, exprs)


def test_ranking(df: DataFrame, cols: list[str], target: str, test: str) -> DataFrame:
    """(feature, f), the larger the more significant; degrees of freedom are the same, so p-values fall as F grows. None counts as most significant."""
    if test not in ("f_regression", "f_classif"):
        raise ValueError(f"test {test!r} is not known")
    found = (f_regression if test == "f_regression" else f_classif)(df, cols, target)
    return frame(df.sparkSession, [(c, None if v is None or v != v else float(v)) for c, v in found.items()], "feature string, f double")


def features_to_drop(pairs: DataFrame, ranking: DataFrame) -> DataFrame:
    """Of each correlated pair the feature with the lower p-value (larger F), the first one on ties: a quirk that is kept. Distinct."""
    high = F.coalesce(F.col("f"), F.lit(float("inf")))
    a, b = ranking.select(F.col("feature").alias("feature_i"), high.alias("fi")), ranking.select(F.col("feature").alias("feature_j"), high.alias("fj"))
    return pairs.join(a, "feature_i").join(b, "feature_j").select(F.when(F.col("fi") < F.col("fj"), F.col("feature_j")).otherwise(F.col("feature_i")).alias("feature")).distinct()


def pairwise_votes(df: DataFrame, cols: list[str], target: str, test: str, method: str, threshold: float) -> DataFrame:
    """(feature, vote): 1 for features that the filter of correlated pairs keeps."""
    name = f"pairwise_{method}_{target}_thresh_{str(threshold).replace('.', '')}_{test}"
    cols = [c for c in cols if c != target]
    dropped = features_to_drop(over_threshold(correlation_pairs(df, cols, method), threshold), test_ranking(df, cols, target, test)).withColumn("_gone", F.lit(1))
    everything = frame(df.sparkSession, [(c,) for c in cols], "feature string")
    return everything.join(dropped, "feature", "left").select("feature", F.when(F.col("_gone").isNull(), 1).otherwise(0).alias(name))


def mutual_information(df: DataFrame, cols: list[str], target: str, bins: int = 16, classes: bool = True) -> DataFrame:
    """(feature, mi) in nats from counts of bins of equal width; a numeric target is binned as well unless it holds ``classes``.

    The reference's library estimates by nearest neighbours with random noise, so values differ; order is what is used.
    """
    ends = aggregate(df, {f"{s}{c}": f(_d(c)) for c in [*cols, *([] if classes else [target])] for s, f in (("a", F.min), ("b", F.max))})

    def binned(c: str) -> Column:
        a, b = ends[f"a{c}"], ends[f"b{c}"]
        return F.lit(0) if a is None or a == b else F.least(F.floor((_d(c) - a) / (b - a) * bins), F.lit(bins - 1)).cast("int")

    y = F.col(f"`{target}`").cast("string") if classes else binned(target).cast("string")
    both = df.select(y.alias("y"), F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(binned(c), F.lit(-1)).alias("x")) for c in cols])).alias("p")).select("y", "p.*").filter("y IS NOT NULL")
    joint = both.groupBy("feature", "x", "y").count()
    of = lambda *k: F.sum("count").over(Window.partitionBy("feature", *k))
    n, nxy = of(), F.col("count")
    return joint.withColumn("t", nxy / n * F.log(nxy * n / (of("x") * of("y")))).groupBy("feature").agg(F.greatest(F.sum("t"), F.lit(0.0)).alias("mi"))


def top_percent(scores: DataFrame, value: str, percent: float, name: str) -> DataFrame:
    """(feature, name): 1 for the best ``percent`` of the features, the rest 0; ties go by name."""
    n = scores.count()
    order = Window.partitionBy(F.lit(0)).orderBy(F.col(value).desc_nulls_last(), "feature")
    return scores.select("feature", (F.row_number().over(order) <= max(1, int(n * percent / 100))).cast("int").alias(name))


def vote_sum(votes: DataFrame, cols: list[str]) -> Column:
    return sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in cols), F.lit(0))


def useful_features(votes: DataFrame) -> DataFrame:
    """Features with all votes but one at most."""
    cols = [c for c in votes.columns if c != "feature"]
    return votes.withColumn("statistical_test_rank", vote_sum(votes, cols)).filter(F.col("statistical_test_rank") >= len(cols) - 1)


def filtered_pairwise(votes: DataFrame, targets: dict[str, list[str]], methods: list[str]) -> DataFrame:
    """Features that keep all votes of each problem and method in turn. Every step filters what the step before left, and all that any step leaves count, in that order.

    A vote column belongs to a target whose name it contains. Rows are a few features: (feature, place)."""
    left, kept = [r.asDict() for r in votes.collect()], []
    for names in targets.values():
        for method in methods:
            cols = [c for t in names for c in votes.columns if t in c and method in c]
            left = [r for r in left if sum(r[c] or 0 for c in cols) >= len(cols)]
            kept += [r["feature"] for r in left if r["feature"] not in kept]
    return frame(votes.sparkSession, [(f, i) for i, f in enumerate(kept)], "feature string, place int")


def feature_types(votes: DataFrame, categorical: list[str], numerical: list[str], fundamentals: list[str] | None = None) -> DataFrame:
    use = lambda xs: [x for x in xs if fundamentals is None or x in fundamentals]
    kind = F.when(F.col("feature").isin(use(categorical)), "categorical_fundamental").when(F.col("feature").isin(use(numerical)), "numerical_fundamental")
    return votes.withColumn("feature_type", kind.otherwise("feature_not_used_on_fs"))


def final_ranking(votes: DataFrame, targets: dict[str, list[str]], useful: list[str], top: int | None = None, threshold: float | None = None) -> DataFrame:
    """(feature, feature_type, final_rank), best first: votes of the columns that contain each target's name, added up over targets.

    Exactly one of ``top`` (so many features) and ``threshold`` (least rank) must be given."""
    if (top is None) == (threshold is None):
        raise ValueError("exactly one of top and threshold must be given")
    cols = [c for c in votes.columns if c not in ("feature", "feature_type")]
    rank = sum((vote_sum(votes, [c for c in cols if t in c]) for ts in targets.values() for t in ts), F.lit(0))
    found = votes.filter((F.col("feature_type") != "feature_not_used_on_fs") & F.col("feature").isin(useful)).select("feature", "feature_type", rank.alias("final_rank"))
    found = found.orderBy(F.desc("final_rank"), F.desc("feature"))
    return found.limit(top) if top is not None else found.filter(F.col("final_rank") >= threshold)


def candidate_features(encoded: list[str], categorical: list[str], numerical: list[str], dataset: str, id_col: str, targets: list[str], fundamentals: list[str] | None = None) -> list[str]:
    """Features that a pairwise filter looks at: the fundamentals (all columns by default) of the kind that ``dataset`` names, without id and targets."""
    kinds = {"mdt_encoded": [*numerical, *categorical], "categorical_encoded": categorical, "numerical": numerical}
    if dataset not in kinds:
        raise ValueError(f"dataset must be one of {sorted(kinds)}, not {dataset!r}")
    wanted = [c for c in (encoded if fundamentals is None else fundamentals) if c in encoded and c in kinds[dataset]]
    return [c for c in dict.fromkeys(wanted) if c not in {id_col, *targets}]


def business_targets(targets: dict[str, list[str]]) -> list[str]:
    return list(dict.fromkeys(t for ts in targets.values() for t in ts))


def weighted_f1_by_prediction(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean F1 over classes, weighted by how often each is predicted: a quirk that is kept (the arguments are swapped where it is used)."""
    cells = df.groupBy(F.col(actual).alias("y"), F.col(predicted).alias("p")).count()
    of = lambda c: cells.groupBy(F.col(c).alias("k")).agg(F.sum("count").alias(f"n{c}"))
    right = cells.filter("y = p").select(F.col("y").alias("k"), F.col("count").alias("hit"))
    by = of("y").join(of("p"), "k", "full").join(right, "k", "left").fillna(0)
    f1 = F.when(F.col("ny") + F.col("np") > 0, 2 * F.col("hit") / (F.col("ny") + F.col("np"))).otherwise(0.0)
    return by.agg((F.sum(f1 * F.col("np")) / F.sum("np")).alias("f1"))


def vote_shares(votes: DataFrame, col: str) -> DataFrame:
    """(value, count, percent) of a vote column."""
    n = votes.count()
    return votes.groupBy(F.col(f"`{col}`").alias("value")).count().withColumn("percent", F.col("count") / F.lit(max(n, 1)) * 100)
