"""Spelling variants by PartEnum signatures.

A word's letters, each with its count so far in the word, are a binary vector.
Words that differ by one replaced letter have vectors at Hamming distance at
most 2 and the same length; by one more letter, at distance 1.  The dimensions
are dealt to ``PARTS`` parts.  Vectors at distance ``d`` differ in at most ``d``
parts, so of all ways to leave out ``d`` parts one leaves equal projections:
a word's signatures are its projections on every choice of ``PARTS - d``
parts, for ``d = 2`` with words of its length, for ``d = 1`` with those one
letter longer or shorter.  Words that share a signature are joined and the
edit distance decides.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

PARTS = 7
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: A run loses a letter where this divides its checksum.
DROP = 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: str) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def word_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least ``MIN_LETTERS`` letters that occur at
    least ``MIN_COUNT`` times in ``docs(doc_id, text)``."""
    # a shorter run can't become a word
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        "text", F.lit(rf"[A-Za-zÀ-ÿ]{{{MIN_LETTERS},}}"), F.lit(0))).alias("run")).select("id", _lowered("run").alias("run"))
    code = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = (F.col("code") % F.length("run")).cast("int")
    less = F.concat(F.expr("left(run, cut)"), F.expr("substring(run, cut + 2)"))
    words = runs.withColumn("code", code).withColumn("cut", cut).select(
        F.when(F.col("code") % DROP == 0, less).otherwise(F.col("run")).alias("word"))
    return materialise(spark, words.where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT), "spelling-words")


def signatures(words: DataFrame) -> DataFrame:
    """``word, n, size, parts``: ``parts`` are the projections of the word's
    vector on the parts, as sorted text."""
    letters = F.array_sort(F.split("word", ""))
    # a letter's count so far is its distance from its first place in sorted order
    dims = F.expr("transform(letters, (c, i) -> struct(c, i - array_position(letters, c) as k))")
    dealt = [F.concat_ws("", F.expr(
        f"transform(filter(dims, d -> pmod(xxhash64(d.c, d.k), {PARTS}) = {p}), d -> d.c)")).alias(f"p{p}")
        for p in range(PARTS)]
    return (words.select("word", "n", F.length("word").alias("size"), letters.alias("letters"))
            .withColumn("dims", dims).select("word", "n", "size", F.array(*dealt).alias("parts")))


def _keyed(signed: DataFrame, distance: int, size: Column) -> DataFrame:
    """``sig, word, n``, a row for each choice of parts; equal projections
    within a choice and a size are equal signatures (a hash, verified later)."""
    sig = [F.xxhash64(size, F.lit(i), *[F.col("parts")[p] for p in kept])
           for i, kept in enumerate(combinations(range(PARTS), PARTS - distance))]
    return signed.select(F.explode(F.array(*sig)).alias("sig"), "word", "n")


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: every ordered pair of ``words(word, n)``
    that differ by exactly one inserted, deleted or replaced code point."""
    signed = materialise(spark, signatures(words), "spelling-signed")
    joined = None
    # equal lengths: each pair once; then the shorter word with the longer one
    for distance, left, right in ((2, F.col("size"), None), (1, F.col("size") + 1, F.col("size"))):
        a = materialise(spark, _keyed(signed, distance, left), "spelling-signatures")
        b = (materialise(spark, _keyed(signed, distance, right), "spelling-signatures") if right is not None else a)
        pairs = a.toDF("sig", "a", "a_n").join(b.toDF("sig", "b", "b_n"), "sig")
        if right is None:
            pairs = pairs.where("a < b")
        pairs = pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")
        joined = pairs if joined is None else joined.union(pairs)
    pairs = materialise(spark, joined.distinct(), "spelling-pairs")
    return pairs.union(pairs.select("b", "b_n", "a", "a_n")).toDF("word", "n", "other", "other_n")


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per word of ``docs``.

    A word's ``form`` is its near word of largest count (ties: the smallest in
    code-point order) if that is at least ``RATIO`` times its own, else null;
    ``root`` follows the forms to the last.  Null texts have no words; a null
    doc_id is an empty id in the checksum; repeated rows count each; texts are
    taken whole.  Other columns are ignored; an empty table gives no rows."""
    words = word_counts(spark, docs)
    near = near_words(spark, words)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("other_n")).alias("order"), F.col("other").alias("form"), F.col("other_n").alias("form_n"))).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.form_n") >= RATIO * F.col("n"), F.col("best")).alias("best"))
    found = materialise(spark, found.select("word", "n", "n_near", "best.form", "best.form_n"), "spelling-forms")
    # counts rise along the forms, so each step doubles the way until all are at the end
    links = materialise(spark, found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialise(spark, links.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-links")
        links = step.select("word", "root")
        if not step.where("moved").take(1):
            break
    return found.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
