"""Feature engineering: pooled image features, ONNX featurizer plug-in,
vector assembly, standard scaling, label indexing and one-hot encoding.

Fitting uses Spark ML estimators (distributed aggregates); applying them is
row-local.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.functions import arrays as A
from ocellus.operators.sampling import range_row_number

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ----------------------------------------------------------- pooled features
def pool_batch(px: np.ndarray, grid: int) -> np.ndarray:
    """Per image of ``n x h x w x c``: [mean of each grid cell per channel
    (cell-major, channel-minor), mean per channel, population std per
    channel].  Cell (a, b) holds the pixels with floor(y*g/h) = a and
    floor(x*g/w) = b; an empty cell is 0.  Cell sums are differences in the
    batch's summed-area table, whatever the grid."""
    n, h, w, c = px.shape
    table = np.zeros((n, h + 1, w + 1, c))
    table[:, 1:, 1:] = px.cumsum(axis=1, dtype=float).cumsum(axis=2)
    y, x = (-(-np.arange(grid + 1) * size // grid) for size in (h, w))  # first row and column of each cell
    cut = table[:, y][:, :, x]
    sums = cut[:, 1:, 1:] - cut[:, :-1, 1:] - cut[:, 1:, :-1] + cut[:, :-1, :-1]
    counts = np.diff(y)[:, None] * np.diff(x)[None]
    cells = sums / np.maximum(counts, 1)[None, :, :, None]
    flat = px.reshape(n, h * w, c).astype(float)
    return np.hstack([cells.reshape(n, -1), flat.mean(axis=1), flat.std(axis=1)])


def pooled_features(data: ColumnOrName, height: ColumnOrName, width: ColumnOrName,
                    channels: ColumnOrName, grid: int = 2) -> Column:
    """Frozen, order-independent featurizer (grid mean-pool + channel
    mean/std), O(pixels) per image; images of equal shape together.  Null for
    a null image."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _pool(d: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"d": d, "h": h, "w": w, "c": c})
        out = pd.Series([None] * len(frame), index=frame.index, dtype="object")
        for (hh, ww, cc), same in frame.dropna().groupby(["h", "w", "c"]):
            px = np.stack(same["d"].to_numpy()).reshape(len(same), int(hh), int(ww), int(cc))
            out.loc[same.index] = pd.Series(list(pool_batch(px, grid)), index=same.index)
        return out

    return _pool(_c(data), _c(height), _c(width), _c(channels))


# --------------------------------------------------------- ONNX featurizer
_ONNX_SESSIONS: dict[str, object] = {}


def _onnx_session(model_path: str):
    """One inference session per Python worker and model file."""
    sess = _ONNX_SESSIONS.get(model_path)
    if sess is None:
        import onnxruntime as ort
        sess = ort.InferenceSession(model_path, providers=["CPUExecutionProvider"])
        _ONNX_SESSIONS[model_path] = sess
    return sess


def featurize_onnx(df: DataFrame, input_col: str, model_path: str, input_shape: Sequence[int],
                   out_col: str = "features", batch_rows: int = 64) -> DataFrame:
    """User-supplied ONNX model (e.g. a CNN without its top) as a frozen
    featurizer: rows flow in Arrow batches, the session is opened once per
    worker, output is flattened to array<float>.  The model file must be on
    a path every executor can read."""
    in_shape = tuple(int(s) for s in input_shape)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sess = _onnx_session(model_path)
        name = sess.get_inputs()[0].name
        for pdf in it:
            outs = []
            for start in range(0, len(pdf), batch_rows):
                chunk = pdf[input_col].iloc[start:start + batch_rows]
                x = np.stack([np.asarray(v, dtype=np.float32).reshape(in_shape) for v in chunk])
                y = sess.run(None, {name: x})[0]
                outs.extend(list(y.reshape(len(chunk), -1).astype(np.float32)))
            res = pdf.drop(columns=[input_col]).copy()
            res[out_col] = outs
            yield res

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes if n != input_col) + f", `{out_col}` array<float>"
    return df.mapInPandas(run, schema.lstrip(", "))


def featurize(df: DataFrame, featurizer: str = "pool", **kw) -> DataFrame:
    """One entry point: ``pool`` (grid mean-pool) or ``onnx`` (a user model)."""
    if featurizer == "pool":
        grid = kw.get("grid", 2)
        return df.withColumn(kw.get("out_col", "features"),
                             pooled_features("data", "height", "width", "n_channels", grid))
    if featurizer == "onnx":
        return featurize_onnx(df, kw["input_col"], kw["model_path"], kw["input_shape"], kw.get("out_col", "features"))
    raise ValueError(f"unknown featurizer {featurizer!r}")


# ------------------------------------------------------- tabular features
def assemble(df: DataFrame, label_col: str, out_col: str = "features",
             exclude: Sequence[str] = ()) -> DataFrame:
    """VectorAssembler over every column except the label (table order)."""
    cols = [c for c in df.columns if c != label_col and c not in exclude]
    return VectorAssembler(inputCols=cols, outputCol=out_col, handleInvalid="keep").transform(df)


def standard_scale(df: DataFrame, features_col: str, out_col: str = "features_normalized",
                   fit_df: DataFrame | None = None, with_mean: bool = True, with_std: bool = True):
    """Fit StandardScaler (sample std, n-1) on ``fit_df`` (the training rows
    by default — fitting on all rows leaks test data) and apply to ``df``.
    Accepts an array column or a vector column.  Returns (df, model)."""
    def vec(d: DataFrame) -> DataFrame:
        if dict(d.dtypes)[features_col].startswith("array"):
            return d.withColumn(features_col, array_to_vector(A.as_doubles(features_col)))
        return d

    model = StandardScaler(inputCol=features_col, outputCol=out_col, withMean=with_mean,
                           withStd=with_std).fit(vec(fit_df if fit_df is not None else df))
    return model.transform(vec(df)), model


def string_index(df: DataFrame, input_col: str, out_col: str = "label_index",
                 order: str = "frequencyDesc", fit_df: DataFrame | None = None):
    """StringIndexer: most frequent = 0, ties alphabetical (``frequencyDesc``),
    or alphabetical class order (``alphabetAsc``, the directory generator's
    class_indices).  Returns (df with int index, model)."""
    model = StringIndexer(inputCol=input_col, outputCol=out_col, stringOrderType=order,
                          handleInvalid="keep").fit(fit_df if fit_df is not None else df)
    return model.transform(df).withColumn(out_col, F.col(out_col).cast("int")), model


def one_hot(df: DataFrame, index_col: str, width: int | None = None, out_col: str = "label") -> DataFrame:
    """Full-width one-hot (no dropped last class) as array<double>.  A null
    index, or one outside the width (``string_index`` gives a null or unseen
    label the index after the last class), has no hot position: all zeros."""
    if width is None:
        width = (df.agg(F.max(index_col)).first()[0] or 0) + 1
    classes = F.sequence(F.lit(0), F.lit(width - 1)) if width > 0 else F.array().cast("array<int>")
    hot = F.transform(classes, lambda i: F.coalesce((i == F.col(index_col)).cast("double"), F.lit(0.0)))
    return df.withColumn(out_col, hot)


def class_index_table(df: DataFrame, class_col: str) -> DataFrame:
    """class name -> index in alphabetical order, for any number of classes:
    the distinct classes are range-partitioned and numbered.  Null is no
    class."""
    classes = df.select(F.col(class_col).alias("class")).where(F.col("class").isNotNull()).distinct()
    return range_row_number(classes, ["class"], "_no").select(
        "class", (F.col("_no") - 1).cast("int").alias("class_index"))
