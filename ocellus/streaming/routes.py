"""Record streams with a success and a failure route.

Every micro-batch is written once, split by its route, into a folder named by
its batch number.  A batch that is replayed after a failure (Spark replays
it with the same number and the same input) replaces its folder, so a record
lands on one route exactly once.  Inputs are removed once they are committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.streaming.scoring import listing_tasks

SUCCESS, FAILURE = "success", "failure"


def with_route(df: DataFrame, error: Column) -> DataFrame:
    """``error`` (null: none) and ``route``."""
    return df.withColumn("error", error).withColumn(
        "route", F.when(F.col("error").isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)))


def batch_writer(sink_dir: str, transform: Callable) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: ``transform`` gives rows with ``route``;
    one job writes both routes of the batch, in place of an earlier attempt's."""
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").partitionBy("route").parquet(f"{sink_dir}/batch={batch_id}")
    return write


def run_routed(spark: SparkSession, source_dir: str, schema: T.StructType | str, transform: Callable, sink_dir: str,
               checkpoint_dir: str, fmt: str = "parquet", options: dict | None = None,
               max_files_per_trigger: int | None = None, remove_input: bool = True,
               writer: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Run the files of ``source_dir`` that the checkpoint has not seen through
    ``transform`` into the routes, to the end; return ``routed``.  ``transform``
    takes and returns a DataFrame and adds ``route`` (``with_route``)."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if remove_input:
        reader = reader.option("cleanSource", "delete")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with listing_tasks(spark):
        query = (reader.load(source_dir).writeStream.foreachBatch(writer or batch_writer(sink_dir, transform))
                 .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
        query.awaitTermination()
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return routed(spark, sink_dir, transform(spark.createDataFrame([], kinds)).schema)


def routed(spark: SparkSession, sink_dir: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of both routes with ``batch`` and ``route``; without any batch
    yet, no rows of ``schema``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink_dir)
    if schema is not None and not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    return spark.read.parquet(sink_dir)


def success(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("route") == SUCCESS).drop("route", "error")


def failure(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("route") == FAILURE).drop("route")
