"""Own pipeline stages for images, saved and loaded with a Spark ML pipeline.

Their parameters are written by Spark's default writer, so ``Pipeline`` and
``PipelineModel`` save and load them like built-in stages (the package must be
importable where they are loaded).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ocellus.functions import arrays as A
from ocellus.operators.features import pooled_features


class PooledFeatures(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Image table (``data, height, width, n_channels``) -> feature vector of
    grid means, channel means and deviations.  Images without pixels are
    dropped, as the featurizer of undecodable files did."""

    grid = Param(Params._dummy(), "grid", "cells per side", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, outputCol: str = "features", grid: int = 2):
        super().__init__()
        self._setDefault(outputCol="features", grid=2)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pooled = pooled_features("data", "height", "width", "n_channels", self.getOrDefault(self.grid))
        out = self.getOutputCol()
        return dataset.withColumn(out, pooled).where(F.col(out).isNotNull()).withColumn(out, array_to_vector(out))


class ArgMaxLabel(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Probability vector -> ``outputCol`` (the name of the first largest
    class, upper-cased) and ``prediction_prob`` (its share in percent, rounded
    to 8 places before scaling).  A class beyond the names has a null name."""

    names = Param(Params._dummy(), "names", "class names by index", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names: list[str] | None = None, inputCol: str = "probability", outputCol: str = "prediction_label"):
        super().__init__()
        self._setDefault(inputCol="probability", outputCol="prediction_label", names=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = vector_to_array(self.getInputCol())
        names = F.array(*[F.lit(n) for n in self.getOrDefault(self.names)])
        return (dataset.withColumn(self.getOutputCol(), F.upper(F.get(names, A.argmax(p))))
                .withColumn("prediction_prob", F.round(F.array_max(p), 8) * 100.0))
