"""Helpers shared by the training-data operators: written intermediate tables
and connected components over an edge table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.session import scratch_path

#: ASCII white space as the contracts define it.
SPACE = r"[\x20\x09-\x0D]+"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage ends there, and a lost executor re-reads instead of recomputing."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    if _SCOPES:
        _SCOPES[-1].append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``materialise`` writes inside are deleted at the end, when
    what was made from them has been written."""
    _SCOPES.append([])
    try:
        yield
    finally:
        discard(spark, *_SCOPES.pop())


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once nothing reads them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(conf).delete(path, True)


def fold_of(col: str, folds: int):
    """crc32 of the id written as text, modulo ``folds`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(folds)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them."""
    there, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in there:
            name += "_"
        out.append(name)
    return out


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells rows apart: the id as text (empty without one) and a hash of
    the text.  Rows that share both are repeated rows."""
    return [F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.xxhash64(F.col(text).isNull(), text)]


def rows_without(docs: DataFrame, gone: DataFrame, once: DataFrame) -> DataFrame:
    """``docs``, all columns, less the rows whose ``row_key`` is in ``gone``;
    of the repeated rows with a key in ``once`` one stays.  Both tables have
    two columns and no repeated rows.  Each row of ``docs`` is shuffled once,
    by its key, unless Spark finds the tables small enough to send around."""
    names = unused(docs, "key_id", "key_text")
    keyed = docs.withColumns(dict(zip(names, row_key())))
    if not once.take(1):
        return keyed.join(gone.toDF(*names), names, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    one = keyed.join(once.toDF(*names), names, "left_semi").dropDuplicates(names)
    rest = keyed.join(gone.union(once).toDF(*names), names, "left_anti")
    return rest.union(one).select(*[F.col(f"`{c}`") for c in docs.columns])


def components(spark: SparkSession, edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, root)`` per
    node that has an edge, ``root`` being the smallest node of its component.

    Alternating large-star and small-star steps until every component is a
    star around its smallest node; each step is a grouped minimum (combined
    before the shuffle) and a join back to the written minima, so that the
    adaptive skew join can split a hub's neighbours.  Only one flag of each
    round reaches the driver."""
    def stars(e):
        """No node has two smaller neighbours, or a smaller and a larger one."""
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select("v", F.lit(0), F.lit(1)))
        tangled = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
            "up > 1 or (up = 1 and down = 1)")
        return tangled.agg(F.count("*")).first()[0] == 0

    e = materialise(spark, edges.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not stars(e):
        both = e.union(e.select("v", "u").toDF("u", "v"))
        low = materialise(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialise(spark, large, name)
        least = materialise(spark, large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u")
        nxt = (small.select("u", "m").union(small.where("v != m").select("v", "m"))
               .toDF("u", "v").distinct())
        before, e = e, materialise(spark, nxt, name)
        discard(spark, before, low, large, least)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select("v", "v").distinct()))
