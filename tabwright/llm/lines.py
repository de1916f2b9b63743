"""Line deduplication: lines that many documents share are dropped everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WHITE, cut

#: Largest number of shared lines (16 bytes each) that is broadcast, the commonest ones; further ones are joined.
BROADCAST_LINES = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(text: Column) -> Column:
    """128 bits of hash: two XXH64 with different beginnings."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def exploded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    r"""(doc_id, row, pos, line, h): the lines of each text by position, with the hash of the normalised line, null for an empty one.

    ``row`` is the hash of the whole text: it tells rows of the same id apart."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).filter("doc_id IS NOT NULL")
    lines = rows.withColumn("row", _hash(F.col("text"))).select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("bare", F.btrim("line", F.lit(WHITE.decode())))
    # lower() knows more letters than A-Z, but is quick where a line has no others
    low = F.when(F.length("bare") == F.octet_length("bare"), F.lower("bare")).otherwise(F.translate("bare", _UPPER, _UPPER.lower()))
    return lines.withColumn("key", low).withColumn("h", F.when(F.col("key") != "", _hash(F.col("key")))).drop("bare", "key")


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h, n): the line hashes found in at least ``min_docs`` documents: distinct pairs of hash and id first, so that no common line meets in one task."""
    return lines.filter("h IS NOT NULL").select("h", "doc_id").distinct().groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)


def dedup_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    r"""Drop every line whose key occurs in at least ``min_docs`` documents, and join the others by \n.

    A key is the line stripped of ASCII white space at both ends, with A-Z lower-cased; empty keys are never dropped. Documents are counted
    by distinct id: rows of the same id are one document for the count. Returns doc_id, n_lines, n_dropped and the kept text of each row,
    repeated rows too. Null text is one empty line; rows without an id are left out; further columns are ignored; an empty table gives no
    rows. Lines are exploded with their positions, marked, and put together by position; a task only ever holds one document's lines.
    The ``broadcast_lines`` commonest shared lines are broadcast; further ones are joined to hashes and positions alone.
    """
    lines = exploded(docs, id_col, text_col)
    shared = cut(shared_lines(lines, min_docs))
    more = shared.count() > broadcast_lines
    common = shared.orderBy(F.desc("n"), "h").limit(broadcast_lines) if more else shared
    marked = lines.join(F.broadcast(common.select("h", F.lit(True).alias("gone"))), "h", "left").select("doc_id", "row", "pos", "line", F.coalesce("gone", F.lit(False)).alias("gone"))
    if more:
        rare = cut(shared.join(common.select("h"), "h", "left_anti").select("h"))
        found = lines.select("doc_id", "row", "pos", "h").join(rare, "h").select("doc_id", "row", "pos", F.lit(None).cast("string").alias("line"), F.lit(True).alias("gone"))
        marked = marked.unionByName(found).repartition("doc_id", "row").groupBy("doc_id", "row", "pos").agg(F.max("line").alias("line"), F.max("gone").alias("gone"), F.count("line").alias("times"))
    else:
        marked = marked.withColumn("times", F.lit(1))
    kept = F.sort_array(F.collect_set(F.when(~F.col("gone"), F.struct("pos", "line"))))  # a set: repeated rows are put together once
    texts = marked.groupBy("doc_id", "row").agg((F.max("pos") + 1).cast("bigint").alias("n_lines"), kept.alias("kept"), F.sum(F.when(F.col("pos") == 0, F.col("times"))).alias("times"))
    out = texts.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept.line", "\n").alias("kept"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_"))
    return out.drop("_")
