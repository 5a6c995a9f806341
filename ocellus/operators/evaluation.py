"""Evaluation: flag counts, hit rate, accuracy, loss, confusion table, AUC,
trainer report, and the fixture nearest-class-mean classifier.

Every metric is one aggregate (partial aggregation on each partition, one
small final merge); unpartitioned windows appear only after the data has
been reduced to one row per class/flag.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ocellus.functions import arrays as A
from ocellus.functions.guards import collect_small


def flag_rate(df: DataFrame, flag_col: str = "search_term") -> DataFrame:
    """Count per flag value and its share of all rows (a fraction; the
    reference divided by a hard-coded 108, we divide by the real total)."""
    counts = df.groupBy(flag_col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", F.col("count") / total)


def miss_list(df: DataFrame, flag_col: str, path_col: str,
              out_col: str = "misclassified_images") -> DataFrame:
    return df.where(F.col(flag_col) == 0).select(F.col(path_col).alias(out_col))


def hit_rate(df: DataFrame, flag_col: str = "search_term") -> DataFrame:
    """Share of rows with flag 1; 0 when there is no row or no hit."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(flag_col)), F.lit(0)).cast("bigint").alias("n_hits"),
        F.coalesce(F.avg((F.col(flag_col) == 1).cast("double")), F.lit(0.0)).alias("hit_rate"))


def accuracy(df: DataFrame, label_col: str, pred_col: str, by: str | None = None) -> DataFrame:
    """Fraction of rows with prediction == label, overall or per ``by``."""
    correct = (F.col(pred_col) == F.col(label_col)).cast("int")
    g = df.groupBy(by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(correct).cast("bigint").alias("n_correct"),
                 F.avg(correct.cast("double")).alias("accuracy"))


def log_loss(df: DataFrame, label_col: str, prob_col: str, eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy -ln p(true class) and arg-max accuracy."""
    p_true = F.element_at(F.col(prob_col), F.col(label_col).cast("int") + 1)
    hit = (A.argmax(F.col(prob_col)) == F.col(label_col)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.avg(-F.log(F.greatest(p_true, F.lit(eps)))).alias("loss"),
                  F.avg(hit).alias("accuracy"))


def confusion_counts(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def binary_auc(df: DataFrame, label_col: str, score_col: str) -> float:
    """Exact area under ROC with Spark's evaluator (distributed; no bins)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label_col,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(df)


def roc_points(df: DataFrame, label_col: str, score_col: str, num_partitions: int | None = None) -> DataFrame:
    """``threshold, n, tp, fp, tpr, fpr``, one row per distinct score: the
    shares of positive (label 1) and negative rows whose score is at least the
    threshold.  Rows without label or score, or with a NaN score, are left out.

    Rows of equal score are counted together before the only shuffle; the
    distinct scores are range-partitioned, summed up inside each range, and the
    totals of the higher ranges (one row each) are added.  A rate without rows
    of its kind is null."""
    from ocellus.operators.sampling import default_buckets
    from ocellus.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    score, label = F.col(score_col).cast("double"), F.col(label_col)
    ties = df.where(label.isNotNull() & score.isNotNull() & ~F.isnan(score)).groupBy((score + 0.0).alias("threshold")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label != 1).alias("neg"))
    n = num_partitions or default_buckets(spark)
    ranged = ties.repartitionByRange(n, F.desc("threshold")).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    sums = ranged.groupBy("_range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()  # over one row per range
    offsets = sums.select("_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "pq"],
                          *[F.sum(c).over(every).alias(f"{c}_all") for c in "pq"])
    upto = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), "_range").withColumns({
        "tp": F.col("p_before") + F.sum("pos").over(upto), "fp": F.col("q_before") + F.sum("neg").over(upto)})
    return out.select("threshold", (F.col("pos") + F.col("neg")).alias("n"), "tp", "fp",
                      F.try_divide("tp", "p_all").alias("tpr"), F.try_divide("fp", "q_all").alias("fpr"))


def class_centroids(df: DataFrame, features_col: str, label_col: str) -> DataFrame:
    """Mean feature vector per class, one JVM aggregate (no explode)."""
    vec = array_to_vector(A.as_doubles(features_col))
    return (df.groupBy(F.col(label_col).alias("label"))
            .agg(Summarizer.mean(vec).alias("_c"))
            .select("label", vector_to_array("_c").alias("centroid")))


def nearest_centroid_predict(df: DataFrame, features_col: str, centroids: DataFrame,
                             pred_col: str = "prediction", max_classes: int = 10_000) -> DataFrame:
    """Predict the class whose mean is nearest (squared distance), ties to
    the lower label.  The centroids are the model: their count is checked,
    they are collected once and broadcast, and distances are computed in
    numpy per Arrow batch (1.2 s per 1M 64-dim rows and 10 classes, against
    19.6 s for the same distances as higher-order SQL lambdas)."""
    rows = sorted(collect_small(centroids, max_classes, "centroid table"), key=lambda r: r["label"])
    labels = np.array([r["label"] for r in rows])
    cents = np.array([r["centroid"] for r in rows], dtype=np.float64)
    bc = df.sparkSession.sparkContext.broadcast((labels, cents))
    label_type = dict(centroids.dtypes)["label"]

    @F.pandas_udf(label_type)
    def predict(x: pd.Series) -> pd.Series:
        lab, cen = bc.value
        out = pd.Series([None] * len(x), dtype="object")
        ok = x.notna().to_numpy()
        if ok.any():
            xs = np.stack(x[ok].to_numpy()).astype(np.float64)
            dist = np.empty((len(xs), len(cen)))
            for k in range(len(cen)):            # one class at a time: memory stays O(batch x dim)
                diff = xs - cen[k]
                dist[:, k] = (diff * diff).sum(axis=1)
            out[ok] = lab[dist.argmin(axis=1)]  # first minimum = lower label
        return out

    return df.withColumn(pred_col, predict(F.col(features_col)))
