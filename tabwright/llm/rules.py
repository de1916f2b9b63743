"""Quality rules whose cutoffs are chosen with a guarantee: exact binomial tests on labelled holdouts bound the share of good documents that they reject."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut, map_arrow
from tabwright.llm.quality import Words, given_votes

#: Base rules: least words of a document, and the largest share of words in repeated windows, in hundredths.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: What the base counts, in the order of the result.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SHAPES = "symbol_words capitals doubled_marks word_repeats table_cells word_length sentence_ends insults common_words odd_words capital_letters commonest_word longest_run".split()
#: Scores that rules cut at, each from above, and the shapes from below as well (``low_``).
SCORES = ("symbols", "dup_lines", "repeat_words", *_SHAPES, *(f"low_{x}" for x in _SHAPES), "flagged", "flagged_share")
#: Levels of strictness, from lenient to strict. The first cutoffs lie beyond all good training documents of a stratum, by these parts of the
#: distance of their largest score from their median; at the others these shares of them lie above a rule's cutoff.
BEYOND, ABOVE = (1.0, 0.3, 0.1), (0.0, 0.0005, 0.001, 0.002, 0.004, 0.008)
LEVELS = len(BEYOND) + len(ABOVE)
#: A stratum's rules are taken one after another, each the one that at this level catches most bad training documents that the rules before
#: leave, while that is at least this share of them, and five times the share of good ones that it takes.
USEFUL_AT, USEFUL_SHARE = 4, 0.02
#: Labelled training documents that word lists are made from, about; how many letters a word's beginning has; share of a stratum's bad documents
#: that must hold a listed unit, of at least so many of them; how much commoner it must be there than in good ones.
LIST_DOCS, BEGINNING, LISTED_SHARE, LISTED_DOCS, LIFT = 40_000, 5, 0.02, 3, 8.0
_EDGES = ".,;:!?\"'()[]{}*#%&$|"


# --- base counts -----------------------------------------------------------------------------------------------------------------------------


def repeated_words(words: Words) -> np.ndarray:
    """How many words of each text lie in windows of three words that the text holds at least twice."""
    n, codes, of = len(words.codes), words.codes.astype(np.int64), words.of
    covered = np.zeros(n, bool)
    if n >= 3:
        at = np.flatnonzero(of[2:] == of[:-2])  # windows within one text
        ranks = lambda x: np.unique(x, return_inverse=True)[1].astype(np.int64)  # noqa: E731  small numbers again, so that products fit
        pair = ranks(codes[at] * (codes.max() + 1) + codes[at + 1])
        window = ranks(pair * (codes.max() + 1) + codes[at + 2])
        _, where, times = np.unique(window * words.rows + of[at], return_inverse=True, return_counts=True)
        again = at[times[where] >= 2]
        for k in range(3):
            covered[again + k] = True
    return np.bincount(of, covered, words.rows).astype(np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def base_counts(texts: pa.Array, words: Words) -> np.ndarray:
    """(texts, 5) counts of BASE."""
    lengths = pc.utf8_length(words.words).to_numpy().astype(np.int64)
    chars = np.bincount(words.of, lengths[words.codes], words.rows)
    symbols = pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy()
    lines = [repeated_lines(x) for x in texts.cast(pa.binary()).to_pylist()]
    return np.column_stack([words.n, chars, symbols, lines, repeated_words(words)]).astype(np.int64)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# --- word lists ------------------------------------------------------------------------------------------------------------------------------


def _units(words: Words) -> tuple[list[str], list[str]]:
    """Each different word in lower case without punctuation around it, and its beginning."""
    bare = pc.utf8_trim(pc.utf8_lower(words.words), characters=_EDGES)
    return bare.to_pylist(), pc.binary_join_element_wise(pc.utf8_slice_codeunits(bare, 0, BEGINNING), "-", "").to_pylist()


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stratum, unit, bad, good): in how many labelled documents of the batch a unit is found."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words, strata, bad = Words(batch.column("text")), batch.column("stratum").to_pylist(), batch.column("bad").to_pylist()
        found: dict[str, tuple[Counter, Counter]] = {}
        pairs = np.unique(words.of * np.int64(len(words.words) + 1) + words.codes)
        of, code = pairs // (len(words.words) + 1), pairs % (len(words.words) + 1)
        whole, begins = _units(words)
        for i, codes in enumerate(np.split(code, np.searchsorted(of, np.arange(1, words.rows)))):
            units = {x for c in codes.tolist() for x in (whole[c], begins[c])}
            found.setdefault(strata[i], (Counter(), Counter()))[bad[i]].update(units)
        for stratum, (good, bad_counts) in found.items():
            units = list(good.keys() | bad_counts.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([stratum] * len(units), pa.string()), pa.array(units, pa.string()), pa.array([bad_counts[u] for u in units], pa.int64()), pa.array([good[u] for u in units], pa.int64())],
                ["stratum", "unit", "bad", "good"],
            )


def word_lists(rows: DataFrame, given: DataFrame, list_docs: int = LIST_DOCS) -> dict[str, dict[str, float]]:
    """The words and beginnings of words of each stratum that mark its bad documents, with the logarithm of how much commoner they are there.

    They are made from about ``list_docs`` labelled documents, which take no part in anything else. A unit is listed if at least LISTED_SHARE of the stratum's bad
    documents hold it, so that a list is no longer than 1 / LISTED_SHARE times the units of a mean bad document.
    """
    chosen = given.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(given.count(), 1))) < list_docs)
    told = rows.join(F.broadcast(chosen.select("doc_id", (F.col("code") > 1).alias("bad"))), "doc_id").filter(_half() == -1)
    sizes = {r.stratum: (r.bad, r.good) for r in told.groupBy("stratum").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()}
    known = told.sparkSession.createDataFrame([(s, b, g) for s, (b, g) in sizes.items()], "stratum string, all_bad bigint, all_good bigint")
    counts = map_arrow(told.select("stratum", "text", "bad"), _unit_counts, "stratum string, unit string, bad bigint, good bigint", together=16 << 20)
    counts = counts.groupBy("stratum", "unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") >= LISTED_DOCS).join(F.broadcast(known), "stratum")
    lift = (F.col("bad") / F.col("all_bad")) / ((F.col("good") + 1) / (F.col("all_good") + 1))
    listed = counts.filter((F.col("bad") >= LISTED_SHARE * F.col("all_bad")) & (lift >= LIFT)).select("stratum", "unit", F.log(lift).alias("weight"))
    out: dict[str, dict[str, float]] = {}
    for r in listed.collect():
        out.setdefault(r.stratum, {})[r.unit] = r.weight
    return out


# --- scores ----------------------------------------------------------------------------------------------------------------------------------


def _half() -> Column:
    """-1: for the word lists (a quarter), 0: for the cutoffs (a quarter), 1 and 2: holdout. By the text, so that copies of one text are never apart."""
    return F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(11)), F.lit(4)).cast("int") - 1


def measure(rows: DataFrame, lists: dict[str, dict[str, float]]) -> DataFrame:
    """(doc_id, stratum, half, text_hash, the base counts, scores) of each row of (doc_id, stratum, text)."""
    held = rows.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column("text"), "")
            words, strata = Words(texts), np.array(batch.column("stratum").to_pylist(), object)
            base, shapes = base_counts(texts, words), words.shapes()
            n = np.maximum(base[:, 0], 1)
            flagged = np.zeros(words.rows)
            whole, begins = _units(words)
            for stratum in set(strata.tolist()) & held.value.keys():
                weight = held.value[stratum]
                of_word = np.fromiter((weight.get(a, 0.0) + weight.get(b, 0.0) for a, b in zip(whole, begins)), np.float64, len(whole))
                flagged = np.where(strata == stratum, np.bincount(words.of, of_word[words.codes], words.rows), flagged)
            scores = np.column_stack([base[:, 2] / n, base[:, 3], base[:, 4] / n, shapes, -shapes, flagged, flagged / n])
            lists_of = pa.ListArray.from_arrays(pa.array(np.arange(words.rows + 1) * len(SCORES), pa.int32()), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "stratum", "half", "text_hash")), *(pa.array(base[:, i]) for i in range(len(BASE))), lists_of],
                                             ["doc_id", "stratum", "half", "text_hash", *BASE, "scores"])

    keyed = rows.withColumn("half", _half()).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit("")), F.lit(12)))
    return map_arrow(keyed, run, f"doc_id bigint, stratum string, half int, text_hash bigint, {', '.join(f'{c} bigint' for c in BASE)}, scores array<double>")


# --- cutoffs ---------------------------------------------------------------------------------------------------------------------------------


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X: n trials of probability p."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i[1:] + 1) / i[1:]))]) + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs - logs.max()).sum() * math.exp(logs.max()))) if logs.max() > -700 else 0.0


def upper_bound(k: int, n: int, alpha: float) -> float:
    """The exact (Clopper-Pearson) bound: the share at which k or fewer of n have probability alpha."""
    lo, hi = 0.0, 1.0
    for _ in range(60 if k < n else 0):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if at_most(k, n, mid) > alpha else (lo, mid)
    return hi


@dataclass
class Stratum:
    """What was chosen for a stratum: cutoffs by rule, or none; and the holdout's numbers that vouch for them."""

    stratum: str
    level: int  # -1: no level passed its test, and nothing is rejected
    cutoffs: dict[str, float]
    holdout: int
    rejected: int
    bound: float  # of the share of good documents rejected, exact at the corrected error probability


def choose(patterns: list[tuple[int, bool, int]]) -> list[int]:
    """The rules to use, from (bits of the rules that reject a document, bad, how many such documents) of the training."""
    of = {bad: [(mask, n) for mask, x, n in patterns if x == bad] for bad in (True, False)}
    total = {bad: max(sum(n for _, n in x), 1) for bad, x in of.items()}
    share = lambda bad, r: sum(n for mask, n in of[bad] if mask >> r & 1) / total[bad]
    used: list[int] = []
    while True:
        best = max((r for r in range(len(SCORES)) if share(True, r) >= 5 * share(False, r)), key=lambda r: (share(True, r), -r), default=None)
        if best is None or share(True, best) < USEFUL_SHARE:
            return used
        used.append(best)
        of = {bad: [(mask, n) for mask, n in x if not mask >> best & 1] for bad, x in of.items()}


def certify(counts: dict[str, list[int]], last: dict[str, int], epsilon: float, alpha: float) -> dict[str, tuple[int, int, int, float]]:
    """(level, holdout, rejected, bound) of each stratum, from counts of the holdout's good texts by the first level that rejects them.

    In a stratum the levels are tested in a fixed order, from lenient to strict, and testing ends at the first that fails; so all of a
    stratum's tests take one error probability. Over the strata it is divided (Bonferroni) among those whose holdout is large enough to pass at
    all, which their size alone decides. With probability 1 - alpha no stratum's rules reject more than ``epsilon`` of its good texts.
    """
    by_size = sorted(counts, key=lambda s: (-sum(counts[s]), s))
    most = max((m for m in range(len(by_size) + 1) if m == 0 or (1 - epsilon) ** sum(counts[by_size[m - 1]]) <= alpha / m), default=0)
    able = set(by_size[:most])
    out = {}
    for s, c in counts.items():
        n, level, gone, share = sum(c), -1, 0, alpha / max(len(able), 1)
        for k in range(last.get(s, -1) + 1 if s in able else 0):
            if at_most(sum(c[: k + 1]), n, epsilon) > share:
                break
            level, gone = k, sum(c[: k + 1])
        out[s] = (level, n, gone, upper_bound(gone, n, share) if level >= 0 else 0.0)
    return out


def _first_level(score: Column, cutoffs: Column) -> Column:
    """The first level whose cutoff a score exceeds: cutoffs fall from level to level; their number if none."""
    return F.size(F.filter(cutoffs, lambda x: score <= x))


def _edges(scores: Column, i: int) -> Column:
    """The cutoffs of a rule by level."""
    found = F.percentile_approx(scores[i], F.array(F.lit(0.5), *[F.lit(1.0 - x) for x in ABOVE]), F.lit(20_000))
    return F.transform(F.array(found), lambda q: F.concat(F.array(*[q[1] + x * (q[1] - q[0]) for x in BEYOND]), F.slice(q, 2, len(ABOVE))))[0]


def fit_cutoffs(measured: DataFrame, given: DataFrame, epsilon: float, alpha: float) -> list[Stratum]:
    """Cutoffs by stratum. All labelled documents that pass the base rules take part, in aggregates of strata, rules and levels alone.

    One quarter of them gives the cutoffs of each level (quantiles of good documents), tells which rules are of use and after which level
    strictness no longer pays; the good texts of the holdout, each once however many copies it has, decide how strict the rules may be.
    """
    spark = measured.sparkSession
    told = measured.filter(~base_failed()).filter("half >= 0").join(given.select("doc_id", (F.col("code") > 1).alias("bad")), "doc_id")
    told = cut(told.groupBy("stratum", "half", "text_hash", "bad").agg(F.first("scores").alias("scores")))
    training = told.filter("half = 0")
    edges = cut(training.filter(~F.col("bad")).groupBy("stratum").agg(F.array(*[_edges(F.col("scores"), i) for i in range(len(SCORES))]).alias("cutoffs")))
    mask = F.aggregate(F.zip_with("scores", F.zip_with("cutoffs", F.sequence(F.lit(0), F.lit(len(SCORES) - 1)), lambda c, i: F.struct(c[USEFUL_AT].alias("c"), i.alias("i"))), lambda x, c: F.when(x > c.c, F.pow(F.lit(2.0), c.i)).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
    patterns: dict[str, list[tuple[int, bool, int]]] = {}
    for r in training.join(F.broadcast(edges), "stratum").groupBy("stratum", "bad", mask.cast("bigint").alias("mask")).count().collect():
        patterns.setdefault(r.stratum, []).append((r.mask, r.bad, r["count"]))
    used = {s: u for s, x in patterns.items() if (u := choose(x))}
    if not used:
        return []
    rules = F.broadcast(spark.createDataFrame(list(used.items()), "stratum string, used array<int>"))
    level = F.array_min(F.transform("used", lambda i: _first_level(F.get("scores", i), F.get("cutoffs", i))))
    joint = told.join(F.broadcast(edges), "stratum").join(rules, "stratum").withColumn("level", level).groupBy("stratum", "half", "bad", "level").count().collect()
    by = {(s, half, bad): [0] * (LEVELS + 1) for s in used for half in (0, 1, 2) for bad in (False, True)}
    for r in joint:
        by[r.stratum, r.half, r.bad][r.level] = r["count"]
    last = {s: _last(by[s, 0, False], by[s, 0, True]) for s in used}
    held = {s: [a + b for a, b in zip(by[s, 1, False], by[s, 2, False])] for s in used}
    values = {r.stratum: r.cutoffs for r in edges.filter(F.col("stratum").isin(list(used))).collect()}
    return [Stratum(s, k, {SCORES[i]: values[s][i][k] for i in used[s]} if k >= 0 else {}, n, gone, bound) for s, (k, n, gone, bound) in certify(held, last, epsilon, alpha).items()]


def _last(good: list[int], bad: list[int]) -> int:
    """The last level whose step still catches more bad training documents than it loses good ones."""
    paying = [k for k in range(LEVELS) if bad[k] > good[k]]
    return paying[-1] if paying else -1


def apply_rules(measured: DataFrame, strata: list[Stratum]) -> DataFrame:
    """``measured`` with base_failed, kept and the first rule that rejects a document (``rule``)."""
    spark = measured.sparkSession
    cuts = [(s.stratum, [s.cutoffs.get(x) for x in SCORES]) for s in strata if s.cutoffs]
    rows = measured.join(F.broadcast(spark.createDataFrame(cuts, "stratum string, cutoffs array<double>")), "stratum", "left")
    broken = F.filter(F.zip_with(F.array(*map(F.lit, SCORES)), F.zip_with("scores", "cutoffs", lambda a, b: F.coalesce(a > b, F.lit(False))), lambda n, b: F.when(b, n)), lambda x: x.isNotNull())
    rule = F.when(F.col("n_words") < LEAST_WORDS, "few_words").when(base_failed(), "repeated_windows").otherwise(F.get(F.when(F.col("cutoffs").isNotNull(), broken), F.lit(0)))
    return rows.withColumn("base_failed", base_failed()).withColumn("rule", rule).withColumn("kept", F.col("rule").isNull()).drop("cutoffs")


def judge(docs: DataFrame, labels: DataFrame, epsilon: float = 0.02, alpha: float = 0.05, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", list_docs: int = LIST_DOCS) -> tuple[DataFrame, list[Stratum]]:
    """(doc_id, stratum, base counts, base_failed, rule, kept for each row; the chosen cutoffs of each stratum).

    Two base rules hold everywhere: at least 50 words, and at most half of them in windows of three words that the text repeats. Beyond them
    a document is rejected if a score of its lies above the cutoff of its stratum. ``labels`` (doc_id, quality, toxic) say which documents
    are good; the cutoffs are the strictest, in a fixed order of levels, for which an exact binomial test on held-out good documents shows
    that at most ``epsilon`` of the stratum's good documents are rejected, all strata together with error probability ``alpha``.

    A stratum with too few labelled documents for such a test, or without bad ones, has the base rules alone, as all have without labels.
    A null stratum is one of its own; null text has no words and fails; repeated rows are judged alike and are one document in the holdout;
    rows without an id are judged but have no label; contradicting labels of an id make it bad; an empty table gives no rows; further columns are
    ignored. Strata are few (languages): their cutoffs come to the driver.
    """
    name = F.when(F.col(stratum_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(stratum_col).cast("string")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), name.alias("stratum"), F.col(text_col).cast("string").alias("text"))
    given = cut(given_votes(labels))
    measured = cut(measure(rows, word_lists(rows, given, list_docs)))
    strata = fit_cutoffs(measured, given, epsilon, alpha)
    return apply_rules(measured, strata).drop("half", "text_hash", "scores"), strata
