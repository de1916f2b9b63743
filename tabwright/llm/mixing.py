"""Temperature mixing of sources with DataFrame operations only: solve the exponent, then pick copies by budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import cut

#: Documents of one permuted block. A source has as many blocks as it needs, so a hot source is many small groups.
BLOCK_DOCS = 2000
#: Sections of the exponent's interval tried in one pass, and passes: 16 ** 8 is 2 ** 32, as 32 bisections.
SECTIONS, PASSES = 16, 8
WORDS = r"[^\x20\x09-\x0D]+"


def order_key(seed: int, doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 of the id, or else of the text: where a document stands in the permutation of its block."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), text.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")


def _key(source: Column) -> Column:
    """Null is a source of its own."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(key, docs, tokens) of each source; words are the tokens."""
    return docs.groupBy(_key(F.col(source_col)).alias("key")).agg(F.count("*").alias("docs"), F.sum(F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0))).cast("bigint").alias("tokens"))


def _total(sizes: DataFrame) -> float:
    return float(sizes.agg(F.sum("tokens")).first()[0] or 1)


def solve_exponent(sizes: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = 2.0) -> float:
    """The exponent t in [0, 1] for weights proportional to share ** t, by bisection.

    With ``target_entropy`` (in units of the largest possible, log of the number of sources) the largest t whose weights reach it: the
    entropy falls as t grows. Otherwise the smallest t at which no source is repeated more than ``repetition_limit`` times while the
    source repeated least is passed once. Repetition depends on the least and the largest share alone, so it takes one aggregation;
    entropy takes one aggregation over the sources for each 16 sections of the interval. Only single rows reach the driver.
    """
    some = cut(sizes.filter("tokens > 0").select(F.log(F.col("tokens") / F.lit(_total(sizes))).alias("p")))
    lo, hi = 0.0, 1.0
    if target_entropy is None:
        least, most = some.agg(F.min("p"), F.max("p")).first()
        for _ in range(48 if least is not None else 0):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if math.exp((mid - 1) * least) / math.exp((mid - 1) * most) <= repetition_limit else (mid, hi)
        return hi
    for _ in range(PASSES):
        edges = [lo + (hi - lo) * k / SECTIONS for k in range(SECTIONS + 1)]
        z = [F.sum(F.exp(t * F.col("p"))) for t in edges[1:-1]]
        entropies = [F.log(x) - t * F.sum(F.col("p") * F.exp(t * F.col("p"))) / x for x, t in zip(z, edges[1:-1])]
        reached = [bool(x) for x in some.agg(*[(h >= target_entropy * F.log(F.count("*"))).alias(f"x{i}") for i, h in enumerate(entropies)]).first()]
        k = (reached + [False]).index(False)  # true as far as the entropy is reached
        lo, hi = edges[k], edges[k + 1]
    return lo


def weights(sizes: DataFrame, exponent: float, budget_tokens: float | None = None) -> DataFrame:
    """(key, docs, tokens, weight, repeats): normalised weights, and how often each source is passed to spend the budget.

    Without ``budget_tokens`` the budget is the least that passes every source at least once. A source without tokens is passed once.
    """
    raw = sizes.withColumn("raw", F.when(F.col("tokens") > 0, F.exp(exponent * F.log(F.col("tokens") / F.lit(_total(sizes))))).otherwise(F.lit(0.0)))
    whole = raw.agg(F.sum("raw")).first()[0] or 1.0
    out = raw.withColumn("weight", F.col("raw") / F.lit(whole)).withColumn("passed", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    scale = budget_tokens if budget_tokens is not None else 1 / (out.agg(F.min("passed")).first()[0] or 1.0)
    return out.select("key", "docs", "tokens", "weight", F.round(F.coalesce(F.col("passed") * F.lit(float(scale)), F.lit(1.0)), 9).alias("repeats"))


def plan(docs: DataFrame, seed: int = 7, target_entropy: float | None = None, repetition_limit: float | None = 2.0, budget_tokens: float | None = None,
         block_docs: int = BLOCK_DOCS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(weights by source, cut-offs by source and block).

    A source's documents are dealt into blocks by hash, and every block is permuted by hash. All are passed floor(repeats) times; the
    rest of the budget goes to the documents at the front of each block's permutation, until the fraction of the block's tokens is spent
    (to the nearest document). ``cutoff`` is the order key of the last of them. Only ids, keys and word counts are shuffled, no texts.
    """
    sizes = cut(source_sizes(docs, source_col, text_col))
    exponent = solve_exponent(sizes, target_entropy, repetition_limit)
    found = cut(weights(sizes, exponent, budget_tokens).withColumn("blocks", F.ceil(F.col("docs") / block_docs).cast("bigint")))
    light = docs.select(_key(F.col(source_col)).alias("key"), order_key(seed, F.col(id_col), F.col(text_col)).alias("place"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).alias("n"))
    light = light.join(found.select("key", "blocks", "repeats"), "key").withColumn("block", F.col("place") % F.col("blocks"))
    block = Window.partitionBy("key", "block")
    upto = block.orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spent = light.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(block))
    extra = F.col("upto") - F.col("n") / 2.0 <= (F.col("repeats") - F.floor("repeats")) * F.col("total")
    cutoffs = spent.filter(extra).filter("repeats > floor(repeats)").groupBy("key", "block").agg(F.max("place").alias("cutoff"))
    return found, cut(cutoffs)  # written, so that their size is known: while they are few the texts stay where they are


def with_copies(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with exponentiated weight, block, place in the block's permutation and copies."""
    found, cutoffs = plan(docs, seed, id_col=id_col, source_col=source_col, text_col=text_col, **how)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", _key(F.col("row").getField(source_col)).alias("key"), order_key(seed, F.col("row").getField(id_col), F.col("row").getField(text_col)).alias("place"))
    rows = rows.join(found.select("key", "blocks", "weight", "repeats"), "key").withColumn("block", F.col("place") % F.col("blocks"))
    rows = rows.join(cutoffs, ["key", "block"], "left")
    copies = F.floor("repeats") + F.when(F.col("place") <= F.col("cutoff"), 1).otherwise(0)
    return rows.select("row", "weight", "block", "place", copies.cast("bigint").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as many times as its copies; see ``plan``.

    Null text has no tokens, a null source is one source, rows without an id are placed by their text; repeated rows are taken alike; an empty
    table gives no rows; further columns are kept, whatever their names.
    """
    rows = with_copies(docs, **how).filter("copies > 0")
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("n")).select("row.*")
