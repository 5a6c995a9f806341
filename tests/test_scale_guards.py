"""Size guards before broadcast/collect, and skew spreading."""

import pytest
from pyspark.sql import functions as F

from ocellus.functions.guards import TooLargeError, collect_small, require_small
from ocellus.operators import features as FE
from ocellus.session import ensure_checkpoint_dir
from ocellus.sources import fetch as FETCH


def test_guards_refuse_oversized_tables(spark):
    df = spark.range(0, 50)
    assert require_small(df, 50) == 50
    assert len(collect_small(df, 60)) == 50
    with pytest.raises(TooLargeError):
        require_small(df, 49)
    with pytest.raises(TooLargeError):
        collect_small(df, 10)


def test_no_shared_folder_on_a_cluster_is_an_error():
    """Without spark.checkpoint.dir only a local master may use a folder of
    its own."""
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_hot_host_spreads_over_many_tasks(spark):
    """A third of all URLs on one host: every task gets some of them."""
    urls = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("http://hot.example/"), F.col("id").cast("string")))
        .otherwise(F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".example/x"))).alias("url"))
    fetched = FETCH.fetch_urls(urls, lambda row: (200, b"x"), num_partitions=16)
    per_part = (fetched.where(F.col("url").startswith("http://hot.example/"))
                .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(per_part) == 16
    assert max(r["count"] for r in per_part) < 1000 * 0.2


def test_null_and_unseen_labels_have_no_hot_position(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "k int, label string")
    idx, model = FE.string_index(rows, "label")
    hot = {r.k: r.hot for r in FE.one_hot(idx, "label_index", len(model.labels), "hot").collect()}
    assert hot == {1: [1.0, 0.0], 2: [0.0, 1.0], 3: [1.0, 0.0], 4: [0.0, 0.0]}
    assert FE.one_hot(idx.where("false"), "label_index", 0, "hot").count() == 0


def test_class_index_of_200000_classes(spark):
    names = spark.range(0, 200_000).select(F.format_string("c%07d", "id").alias("name"))
    table = FE.class_index_table(names.unionByName(names).unionByName(
        spark.sql("SELECT CAST(null AS string) AS name")), "name")
    assert table.count() == 200_000
    assert table.where(F.substring("class", 2, 7).cast("int") != F.col("class_index")).count() == 0
