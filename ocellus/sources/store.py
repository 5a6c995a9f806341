"""Keyed parquet stores for features, class indexes and models.

The reference saved features as positional arrays and paired them with
labels by file order; here every stored row carries its key, and the join
back is by key.  Feature and label tables are written bucketed and sorted
on the same key with the same bucket count, so joining them back needs no
shuffle of either side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.session import scratch_path


def save_bucketed(df: DataFrame, key: str, path: str, buckets: int, table: str | None = None) -> str:
    """Write ``df`` as a parquet table bucketed and sorted by ``key`` at
    ``path`` (a shared location) and register it; returns the table name."""
    name = table or f"ocellus_{uuid.uuid4().hex[:12]}"
    # one shuffle into the bucket layout first: each task then writes one
    # file per bucket instead of one file per (task, bucket)
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return name


def feature_store_roundtrip(spark: SparkSession, features: DataFrame, labels: DataFrame, key: str,
                            buckets: int | None = None, base: str | None = None) -> DataFrame:
    """Save features and labels as two keyed tables, load them, join by key."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = base or scratch_path(spark, "features")
    ft = save_bucketed(features, key, f"{base}/features", n)
    lt = save_bucketed(labels, key, f"{base}/labels", n)
    return spark.table(ft).join(spark.table(lt), key)


def save_class_index(table: DataFrame, path: str) -> None:
    """class string, class_index int."""
    table.write.mode("overwrite").parquet(path)


def load_class_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def stored_vector_checksum(df: DataFrame, vec_col: str) -> DataFrame:
    """dim and sum of a stored vector, for round-trip checks."""
    return df.withColumn("dim", F.size(vec_col)).withColumn(
        "feature_sum", F.aggregate(F.col(vec_col), F.lit(0.0), lambda a, x: a + x.cast("double")))
