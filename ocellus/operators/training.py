"""Training: Spark ML's estimators (logistic regression, gradient-boosted
trees, multilayer perceptron), each fitted over all partitions by
``treeAggregate``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ocellus.functions import arrays as A
from ocellus.operators import evaluation as E

# Fixed settings of the reference's models
LR_SETTINGS = dict(maxIter=20, regParam=0.05, elasticNetParam=0.3)
GBT_SETTINGS = dict(lossType="logistic", maxDepth=5, maxBins=32, minInstancesPerNode=1, minInfoGain=0.0,
                    maxIter=5, stepSize=0.1, subsamplingRate=1.0)


# ------------------------------------------------------------ built-in models
def with_vector(df: DataFrame, features_col: str, out_col: str = "features") -> DataFrame:
    if dict(df.dtypes)[features_col].startswith("array"):
        return df.withColumn(out_col, array_to_vector(A.as_doubles(features_col)))
    return df if features_col == out_col else df.withColumn(out_col, F.col(features_col))


def fit_lr_pipeline(train: DataFrame, label_col: str = "label", features_col: str = "features",
                    stages_before: list | None = None, **overrides):
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, **{**LR_SETTINGS, **overrides})
    return Pipeline(stages=[*(stages_before or []), lr]).fit(train)


def fit_gbt(train: DataFrame, label_col: str = "label", features_col: str = "features", seed: int = 7,
            **overrides):
    gbt = GBTClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, **{**GBT_SETTINGS, **overrides})
    return Pipeline(stages=[gbt]).fit(train)


def fit_spark_mlp(train: DataFrame, n_features: int, n_classes: int, label_col: str = "label",
                  features_col: str = "features", hidden: tuple[int, ...] = (256,), max_iter: int = 50,
                  seed: int = 7):
    """Spark's built-in MLP (sigmoid hidden layers, softmax output, L-BFGS,
    no dropout): the distributed stand-in for the reference's Keras head."""
    mlp = MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col,
                                         layers=[n_features, *hidden, n_classes], maxIter=max_iter, seed=seed)
    return Pipeline(stages=[mlp]).fit(train)


def validation_loss(model, valid: DataFrame, label_col: str = "label") -> tuple[int, float, float]:
    """Rows, mean cross-entropy and accuracy of ``model`` on ``valid``."""
    scored = model.transform(valid).withColumn("_p", vector_to_array("probability"))
    row = E.log_loss(scored, label_col, "_p").first()
    return row["n"], row["loss"], row["accuracy"]


def fit_mlp_rounds(train: DataFrame, valid: DataFrame, n_features: int, n_classes: int, rounds: int = 10,
                   steps: int = 5, patience: int = 3, min_delta: float = 1e-6, label_col: str = "label",
                   features_col: str = "features", hidden: tuple[int, ...] = (256,), seed: int = 7):
    """Spark's MLP fitted in ``rounds`` of ``steps`` iterations, each from the
    weights of the one before, with the validation loss after each.  Ends
    early when the loss has not fallen by ``min_delta`` in ``patience`` rounds.
    Returns the model of the lowest loss and the history, one ``(round,
    n_validation, loss, accuracy)`` each.  Give tables that are written or
    cached: every round reads both."""
    layers = [n_features, *hidden, n_classes]
    weights, best, history, since = None, None, [], 0
    for n in range(1, rounds + 1):
        mlp = MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col, layers=layers,
                                             maxIter=steps, seed=seed)
        if weights is not None:
            mlp = mlp.setInitialWeights(weights)
        model = mlp.fit(train)
        weights = model.weights
        rows, loss, accuracy = validation_loss(model, valid, label_col)
        history.append((n, rows, loss, accuracy))
        if best is None or loss < best[0] - min_delta:
            best, since = (loss, model), 0
        else:
            since += 1
            if since >= patience:
                break
    return best[1], history


def compare_trainers(trainers: dict[str, Callable[[DataFrame], object]], train: DataFrame, test: DataFrame,
                     label_col: str = "label") -> DataFrame:
    """``trainer, n_test, n_correct, accuracy, seconds``, one row per trainer
    (a function from the training rows to a model); ``seconds`` is its fit."""
    spark, rows = train.sparkSession, None
    for name, fit in trainers.items():
        start = time.perf_counter()
        model = fit(train)
        took = time.perf_counter() - start
        one = E.accuracy(model.transform(test), label_col, "prediction").select(
            F.lit(name).alias("trainer"), F.col("n").alias("n_test"), "n_correct", "accuracy", F.lit(took).alias("seconds"))
        rows = one if rows is None else rows.unionByName(one)
    return rows if rows is not None else spark.createDataFrame(
        [], "trainer string, n_test bigint, n_correct bigint, accuracy double, seconds double")
