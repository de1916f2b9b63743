"""Source divergence audit: how far the sources of a language lie apart by their words, from an inverted index of term postings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import bytes_of, cut, map_arrow

#: Scale of the smoothed shares, and what is added to each count.
SCALE, SMOOTH = 1_000_000_000, 2
#: Distinct (source, term) counts that a task holds before it hands them on, bytes of text split at once, and sources in a block of postings.
HELD_TERMS, PIECE, BLOCK = 300_000, 1 << 20, 64
#: Terms are runs of letters A-Z and of anything beyond ASCII, which in UTF-8 are all bytes from 0x80: the others separate.
_TERMS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms, some megabyte at a time."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and _TERMS[text[end]] != 32:  # never inside a term
            end += 1
        yield text[start:end].translate(_TERMS).split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each source's terms, summed up as long as the task's memory allows."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in n.items():
            # decoded leniently: a text cut inside a character still has a defined term
            names = [pa.array([x] * len(found), pa.string()) for x in (lang, source)]
            terms = pa.array([x.decode("utf-8", "replace") for x in found], pa.string())
            numbers = [pa.array([c[x] for x in found], pa.int64()) for c in (found, docs[lang, source])]
            yield pa.RecordBatch.from_arrays([*names, terms, *numbers], ["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), bytes_of(batch, "text")):
            seen: set[bytes] = set()
            all_terms = n.setdefault((lang, source), Counter())
            for terms in _terms(text):
                all_terms.update(terms)
                seen.update(terms)
            docs.setdefault((lang, source), Counter()).update(seen)
            if sum(map(len, n.values())) > HELD_TERMS:
                yield from handed_on()
    yield from handed_on()


def postings(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): how often and in how many documents a source has a term."""
    rows = docs.select(_named(lang_col).alias("lang"), _named(source_col).alias("source"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = map_arrow(rows, _count, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in billionths, exactly: 1 + floor(10^9 (n + 2) / (total + 2 terms)). Decimals hold what a long would not."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", (wide(n) + F.lit(SMOOTH)) * F.lit(SCALE), wide(total) + wide(terms) * F.lit(SMOOTH))


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)): at most about 10^18, so that a long holds it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = 10, top_terms: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language, all its other sources and the terms that stand out in it.

    A language keeps the terms that occur in at least ``min_docs`` of its documents. Part 'pair' sums ``_apart`` of the two sources' smoothed
    shares over all kept terms, part 'term' has the ``top_terms`` terms whose share lies above the language's. All numbers are integers and exact.

    No term is compared for a pair of sources that both lack it. A pair begins at the number of terms times the value of two zero counts. What
    one source's counts change against another's zero depends on the count alone, so it is taken for each different count of a source, times
    its terms. Only where both have a term is there a posting for the pair, and it emits what is still missing, if that isn't zero. A
    term's postings lie in blocks of ``block`` sources, so that no row grows with the number of sources; the rows of the result do, by definition.

    Null lang, source and text are empty strings, and every row is a document, repeated ones too. Sources without any term are compared by their
    zero counts; a language without kept terms has values of zero and no terms; one with a single source has no pairs; an empty table gives no
    rows; further columns are ignored.
    """
    everything = cut(postings(docs, lang_col, source_col, text_col))
    kept = everything.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")
    found = cut(everything.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"))

    sources = docs.select(_named(lang_col).alias("lang"), _named(source_col).alias("source")).distinct()
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = found.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("terms"))
    groups = sources.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("total", "lang_total", "terms")])
    groups = cut(groups.withColumn("p0", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(1))))

    shares = found.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "p0", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), _share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = cut(shares)
    pairs = _pairs(groups, shares, block).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(by_value)) for x in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top_terms))


def _pairs(groups: DataFrame, shares: DataFrame, block: int) -> DataFrame:
    """(lang, source, other, value), both ways round."""
    side = lambda df, name: df.select("lang", *[F.col(x).alias(f"{name}_{x}") for x in df.columns if x != "lang"])
    left, right = side(groups.select("lang", "source", "p0", "terms"), "a"), side(groups.select("lang", "source", "p0"), "b")
    two = left.join(right, "lang").filter("a_source < b_source")
    start = two.select("lang", "a_source", "b_source", (F.col("a_terms") * _apart(F.col("a_p0"), F.col("b_p0"))).alias("value"))

    counts = side(shares.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("terms")), "a")
    alone = counts.join(right, "lang").filter("a_source <> b_source")
    alone = alone.select("lang", F.least("a_source", "b_source").alias("a_source"), F.greatest("a_source", "b_source").alias("b_source"),
                         (F.col("a_terms") * (_apart(F.col("a_p"), F.col("b_p0")) - _apart(F.col("a_p0"), F.col("b_p0")))).alias("value"))

    blocks = F.pmod(F.xxhash64("source"), F.ceil(F.count("*").over(Window.partitionBy("lang")) / block))
    blocked = shares.join(groups.select("lang", "source", blocks.alias("block")), ["lang", "source"])
    lists = blocked.groupBy("lang", "term", "block").agg(F.collect_list(F.struct("source", "p", "p0")).alias("has"))
    both = lists.alias("a").join(lists.alias("b"), ["lang", "term"]).filter("a.block <= b.block").select("lang", F.col("a.block").alias("a_block"), F.col("b.block").alias("b_block"), F.explode("a.has").alias("a"), F.col("b.has").alias("has"))
    both = both.select("lang", "a_block", "b_block", "a", F.explode("has").alias("b")).filter("a_block < b_block OR a.source < b.source")
    value = _apart(F.col("a.p"), F.col("b.p")) - _apart(F.col("a.p"), F.col("b.p0")) - _apart(F.col("a.p0"), F.col("b.p")) + _apart(F.col("a.p0"), F.col("b.p0"))
    both = both.select("lang", F.least("a.source", "b.source").alias("a_source"), F.greatest("a.source", "b.source").alias("b_source"), value.alias("value"))

    emitted = alone.filter("value <> 0").unionByName(both.filter("value <> 0")).unionByName(start)
    sums = emitted.groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("other")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("other"))))
    return sums.select("lang", ways.alias("way"), "value").select("lang", "way.source", "way.other", "value")
