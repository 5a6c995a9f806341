"""Exact dedup by progressive refinement, in DataFrame operations only.

Texts are equal when identical after each run of ASCII white space becomes one
space.  Groups are refined by length, then by a hash of the prefix, then by
the full hash; a row leaves the refinement as soon as it is alone in its
group, so only rows of equal length and prefix meet on their full hash.  The
text is scanned once into a narrow table.  Removing copies reads the rows once
more and shuffles each once, by its own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import SPACE, materialise, row_key, rows_without

PREFIX_CHARS = 64


def normalised(text: str = "text"):
    """The text as compared: null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def _crowded(spark: SparkSession, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share ``keys`` with another row.  Both sides of the join are
    written tables, so that Spark can split a group that is very large."""
    many = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return materialise(spark, rows.join(materialise(spark, many, "dedup-many"), keys, "left_semi"), "dedup-crowded")


def _narrow(spark: SparkSession, docs: DataFrame, *more) -> DataFrame:
    """The table that is refined, one row per row of ``docs``."""
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"), *more)
    return materialise(spark, norm.select(
        "*", F.monotonically_increasing_id().alias("row"), F.length("norm").alias("chars"),
        F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
        F.unhex(F.sha2("norm", 256)).alias("sha")).drop("norm"), "dedup-narrow")


def _refined(spark: SparkSession, narrow: DataFrame) -> DataFrame:
    return _crowded(spark, _crowded(spark, narrow, ["chars"]), ["chars", "prefix"])


def exact_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, sha``, one row per row of ``docs``.

    ``sha`` is the binary SHA-256 of the normalised text.  Of equal texts the
    row with the smallest doc_id stays; null ids come last, and of repeated
    rows with that same id one stays.  Null texts are empty texts.  Other
    columns of ``docs`` are ignored."""
    narrow = _narrow(spark, docs)
    groups = _refined(spark, narrow).groupBy("chars", "prefix", "sha").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "row")).alias("keep"),
        F.count("*").alias("group_size")).where("group_size > 1")
    out = narrow.join(materialise(spark, groups, "dedup-groups"), ["chars", "prefix", "sha"], "left")
    return out.select(
        "doc_id", F.coalesce("keep.doc_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), "sha")


def exact_duplicates_removed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs``, all its columns unchanged, with one row of each group of equal
    texts: the one with the smallest doc_id, null ids last, of repeated rows
    one.  Null and empty texts are one group.  An empty table gives none."""
    narrow = _narrow(spark, docs, *[c.alias(n) for c, n in zip(row_key(), ("ki", "kt"))])
    # rows with equal keys are repeated rows; they are counted before groups meet
    rows = _refined(spark, narrow).groupBy("chars", "prefix", "sha", "ki", "kt").agg(
        F.first("doc_id").alias("doc_id"), F.count("*").alias("times"))
    rows = materialise(spark, rows, "dedup-rows")
    groups = rows.groupBy("chars", "prefix", "sha").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "kt")).alias("keep"),
        F.sum("times").alias("size")).where("size > 1").drop("size")
    placed = rows.join(materialise(spark, groups, "dedup-groups"), ["chars", "prefix", "sha"]).select(
        "ki", "kt", "times", (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("kt") == F.col("keep.kt"))).alias("stays"))
    placed = materialise(spark, placed, "dedup-placed")
    return rows_without(docs, placed.where("not stays").select("ki", "kt"),
                        placed.where("stays and times > 1").select("ki", "kt"))
