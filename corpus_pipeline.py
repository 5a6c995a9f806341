"""From raw documents to packed sequences: the corpus pipeline.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last keep the columns of ``documents``, whatever they are called; an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ocellus.llm import exact_dedup, mixing, ngram_join, packing, quality
from ocellus.llm.common import discard, scratch
from ocellus.session import prepare, read_table, scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps: those scored ``KEEP`` or
    more by a classifier learned from ``labels``; without labels, all.  Null
    texts are scored as empty ones, repeated rows alike."""
    prepare(spark)
    return quality.good_documents(spark, docs, read_table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest
    doc_id (null ids last); null and empty texts are one group."""
    prepare(spark)
    return exact_dedup.exact_duplicates_removed(spark, docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or
    more of their five-word shingles, one with the smallest doc_id; rows with
    null ids or without words stay."""
    prepare(spark)
    return ngram_join.near_duplicates_removed(spark, docs, size=5, num=4, den=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens have the source, language and topic
    shares, of 80 % of the tokens or nearly; no value's share is more than it
    has of these, so that a rare one does not hold back all others.  Null
    values are values of their own, rows of one id go together."""
    prepare(spark)
    return mixing.mixed_sample(spark, docs, within_reach=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens; null texts
    are empty ones, repeated rows are packed each."""
    prepare(spark)
    return packing.pack(spark, docs)


STAGES = [("quality", good_quality), ("exact_dedup", no_copies), ("near_dedup", no_near_copies),
          ("mixing", mix), ("packing", pack)]

#: Trained scores, raking and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.  A stage's
    intermediate tables and its input are deleted once its rows are written."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            path = scratch_path(spark, f"stage-{name}")
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        docs.scratch = path
        if before is not None:
            discard(spark, before)
        before = docs
    return docs
