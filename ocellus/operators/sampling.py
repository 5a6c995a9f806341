"""Counting, batch planning, deterministic splitting, ranking and picking.

Splits and shuffles are keyed by an md5 hash of the row key instead of a
random draw, so the result does not depend on the number or order of input
partitions and survives task retries unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_bucket(key: Column | str, salt: str | None = None, modulo: int = 100) -> Column:
    """Stable bucket in [0, modulo): first 8 hex digits of md5 of the key."""
    k = F.col(key) if isinstance(key, str) else key
    text = k.cast("string") if salt is None else F.concat(F.lit(salt), k.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(modulo)).cast("int")


def hash_split(df: DataFrame, key: str, train_pct: int = 60, salt: str | None = None,
               split_col: str = "split", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Disjoint, covering split: rows whose key-hash bucket is below
    ``train_pct`` are the first split.  Row-local, no shuffle."""
    b = hash_bucket(key, salt)
    return df.withColumn(split_col, F.when(b < train_pct, F.lit(names[0])).otherwise(F.lit(names[1])))


def stratified_split(df: DataFrame, key: str, class_col: str, train_pct: int | Mapping = 30,
                     salt: str | None = None, split_col: str = "split",
                     names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Each class is split on its own share (a dict class -> pct, or one pct
    for all).  Every class keeps its share in both splits independent of the
    other classes' sizes; skew in one class does not move work anywhere.
    The class is part of the hashed key, so classes are drawn independently."""
    b = hash_bucket(F.concat_ws(":", F.col(class_col).cast("string"), F.col(key).cast("string")), salt)
    if isinstance(train_pct, Mapping):
        pct = F.lit(None).cast("int")
        for cls, p in train_pct.items():
            pct = F.when(F.col(class_col) == F.lit(cls), F.lit(int(p))).otherwise(pct)
    else:
        pct = F.lit(int(train_pct))
    return df.withColumn(split_col, F.when(b < pct, F.lit(names[0])).otherwise(F.lit(names[1])))


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split in one job (the reference ran one count per split)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def labelled_union(*parts: tuple[DataFrame, int], label_col: str = "label",
                   not_null: str | None = None) -> DataFrame:
    """Literal label per source, drop rows whose ``not_null`` column is null,
    bag union by name (duplicates kept)."""
    out = None
    for df, label in parts:
        d = df.withColumn(label_col, F.lit(int(label)))
        if not_null is not None:
            d = d.where(F.col(not_null).isNotNull())
        out = d if out is None else out.unionByName(d)
    return out


def first_n(df: DataFrame, order_cols: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by key: planned as a per-partition top-n plus merge."""
    return df.orderBy(*order_cols).limit(n)


def default_buckets(spark) -> int:
    return max(64, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def hash_prefix_bucket(hex_col: Column | str, num_buckets: int) -> Column:
    """Order-preserving bucket of an md5 hex string: its first 6 hex digits
    scaled to [0, num_buckets).  Uniform, so buckets are balanced."""
    h = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    prefix = F.conv(F.substring(h, 1, 6), 16, 10).cast("bigint")
    return F.floor(prefix * F.lit(num_buckets) / F.lit(16 ** 6)).cast("int")


def global_row_number(df: DataFrame, order_cols: Sequence[Column | str], out_col: str = "row_no",
                      bucket: Column | None = None, num_buckets: int | None = None) -> DataFrame:
    """1-based row number over the whole table in ``order_cols`` order
    (which should be unique) without pulling all rows into one partition.

    With ``bucket``, an order-preserving bucket of the row (null buckets come
    first), the row number is the running total of the earlier buckets' sizes
    plus the row number inside the bucket: bucket sizes come from a partial
    aggregate, and the offsets table has at most ``num_buckets`` + 1 rows.
    Without, the rows are range-partitioned (``range_row_number``).  Every row
    gets a number, null keys included.
    """
    n = num_buckets or default_buckets(df.sparkSession)
    if bucket is None:
        return range_row_number(df, order_cols, out_col, n)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    d = df.withColumn("__rn_b", F.coalesce(bucket, F.lit(-1)))
    sizes = d.groupBy("__rn_b").agg(F.count(F.lit(1)).alias("__rn_n"))
    # one row per bucket: an unpartitioned window here is over <= n rows
    offsets = sizes.select("__rn_b", F.coalesce(F.sum("__rn_n").over(
        Window.orderBy("__rn_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__rn_off"))
    within = F.row_number().over(Window.partitionBy("__rn_b").orderBy(*cols))
    return (d.join(F.broadcast(offsets), "__rn_b")
            .withColumn(out_col, (F.col("__rn_off") + within).cast("bigint"))
            .drop("__rn_b", "__rn_off"))


def range_row_number(df: DataFrame, order_cols: Sequence[Column | str], out_col: str = "row_no",
                     num_partitions: int | None = None) -> DataFrame:
    """Row number for any (composite) order key: range-partition on the
    whole key (the sampler splits a hot first column by the later ones),
    sort inside partitions, and checkpoint once to the shared checkpoint
    folder so the numbering pass and the partition-size pass read the same
    partitions.  Costs one extra write; use ``global_row_number`` with a
    bucket when an order-preserving bucket is known."""
    from ocellus.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or default_buckets(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("__rn_pid", F.spark_partition_id())
              .withColumn("__rn_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
              .checkpoint(eager=True))
    sizes = ranged.groupBy("__rn_pid").agg(F.count(F.lit(1)).alias("__rn_n"))
    offsets = sizes.select("__rn_pid", F.coalesce(F.sum("__rn_n").over(
        Window.orderBy("__rn_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__rn_off"))
    return (ranged.join(F.broadcast(offsets), "__rn_pid")
            .withColumn(out_col, F.col("__rn_off") + F.col("__rn_local") + 1)
            .drop("__rn_pid", "__rn_local", "__rn_off"))


def shuffle_rank(df: DataFrame, key: str, seed: str = "0", out_col: str = "shuffle_rank",
                 num_buckets: int | None = None) -> DataFrame:
    """A seeded random permutation, returned as a rank column:
    rows are ordered by md5(seed || key), ties broken by the key."""
    n = num_buckets or default_buckets(df.sparkSession)  # (a null key has no hash and comes first)
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    d = df.withColumn("__sr_h", h)
    return global_row_number(d, ["__sr_h", key], out_col, hash_prefix_bucket("__sr_h", n), n).drop("__sr_h")


def calculate_batch_size(total: Column, min_files: Column, start_cap: int = 10) -> Column:
    """Largest divisor of ``total`` not above min(min_files, start_cap);
    null when ``min_files`` is not positive (the reference divides by zero)."""
    start = F.least(min_files, F.lit(start_cap))
    divisors = F.filter(F.sequence(F.lit(1), start), lambda b: total % b == 0)
    return F.when(min_files > 0, F.array_max(divisors)).cast("int")


def batch_plan(df: DataFrame, group_col: str, class_col: str, start_cap: int = 10) -> DataFrame:
    """Per group (e.g. training / validation tree): files, classes, smallest
    class, batch size and predict steps = ceil(files / batch)."""
    per_class = df.groupBy(group_col, class_col).agg(F.count(F.lit(1)).alias("__rn_n"))
    per_group = per_class.groupBy(group_col).agg(
        F.sum("__rn_n").alias("n_files"),
        F.count(F.lit(1)).alias("n_classes"),
        F.min("__rn_n").alias("min_class_files"))
    bs = calculate_batch_size(F.col("n_files"), F.col("min_class_files"), start_cap)
    return (per_group.withColumn("batch_size", bs)
            .withColumn("steps", F.ceil(F.col("n_files") / F.col("batch_size")).cast("bigint")))


def indexed_items(items: DataFrame, order_col: str, value_col: str) -> tuple[DataFrame, int]:
    """A list with 0-based positions (the image list of the scoring app) and
    its length, of any size."""
    listed = range_row_number(items.select(order_col, F.col(value_col).alias("item")), [order_col], "__it_no")
    return listed.select((F.col("__it_no") - 1).alias("item_no"), "item"), items.count()


def rotation_assign(requests: DataFrame, order_col: str, items: DataFrame, item_order: str,
                    item_value: str) -> DataFrame:
    """Request i (in ``order_col`` order, from 0, null keys first) gets item
    i mod k; without items, null."""
    listed, k = indexed_items(items, item_order, item_value)
    numbered = global_row_number(requests, [order_col], "request_no").withColumn(
        "request_no", F.col("request_no") - 1)
    return (numbered.withColumn("item_no", F.col("request_no") % F.lit(max(k, 1)))
            .join(listed, "item_no", "left").withColumn("item_no", F.col("item_no").cast("int")))


def random_assign(requests: DataFrame, key: str, items: DataFrame, item_order: str, item_value: str,
                  seed: str = "0") -> DataFrame:
    """Uniform pick per request: md5(seed || key) mod k, inclusive bounds.  A
    null key is drawn as an empty one; without items, null."""
    listed, k = indexed_items(items, item_order, item_value)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return (requests.withColumn("item_no", hash_bucket(text, salt=seed, modulo=max(k, 1)).cast("bigint"))
            .join(listed, "item_no", "left").withColumn("item_no", F.col("item_no").cast("int")))
