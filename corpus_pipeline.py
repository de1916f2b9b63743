"""A corpus pipeline over documents: quality, near-duplicates, decontamination, mixing, token ids. Each stage's result is written and read again.

All stages take null text for empty, keep columns whatever their names, and give no rows for an empty table. Texts are taken whole however
long they are. Rows without an id pass all stages but the last, which numbers documents by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import decontam, mixing, quality, simhash, simple8b
from tabwright.llm.common import cut, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go; texts without words stay, and repeated rows fare alike."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays: sets of five-word shingles of a Jaccard similarity of 0.8 or more.

    Blank texts are copies of one another; repeated rows of the id that stays stay; rows without an id stay."""
    return simhash.keep_first(docs, words=5, budget=6, least=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; blank texts and rows without an id stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, and documents of small sources come up to twice; a null source is a source, and repeated rows are dealt alike."""
    return mixing.mix(docs, seed=7, repetition_limit=2.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The files of token ids, summed up by row in the order of ids; a blank text has the end id alone, and rows without an id are left out."""
    import public_tokenizers

    return simple8b.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_ids),
]

#: SQL can't express the classifier, XXH64 or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
