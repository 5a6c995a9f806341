"""Image tables and per-image array work: thumbnail sizes, nearest resize,
BGR->RGB, float conversion and 1/255 rescale.

An image table has columns ``height int, width int, n_channels int,
data array<int>`` (row-major, channel-interleaved bytes 0..255) plus a key.
Short per-pixel maps (BGR->RGB, rescale) are built-in higher-order
functions; whole-image gathers (resize, thumbnails, decoding) run in numpy
per Arrow batch, since Spark evaluates lambdas without codegen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.operators import resample as R

ColumnOrName = Column | str

# Fixed values that must equal the reference's: model input size and the
# two thumbnail boxes of the downloader and the thumbnail job
MODEL_SIZE = (224, 224)
DOWNLOAD_THUMB_BOX = (200, 100)
THUMB_BOX = (200, 200)
RESCALE = 1.0 / 255.0


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------ size arithmetic
def thumbnail_size(width: ColumnOrName, height: ColumnOrName, box_w: int, box_h: int) -> tuple[Column, Column]:
    """Fit inside the box keeping the aspect ratio, never enlarging:
    first cap the width (scale the height down, floor, at least 1), then
    cap the height (scale the width down the same way).  Integer math."""
    w, h = _c(width).cast("bigint"), _c(height).cast("bigint")
    h1 = F.when(w > box_w, F.greatest(F.floor(h * box_w / w), F.lit(1))).otherwise(h)
    w1 = F.when(w > box_w, F.lit(box_w)).otherwise(w)
    w2 = F.when(h1 > box_h, F.greatest(F.floor(w1 * box_h / h1), F.lit(1))).otherwise(w1)
    h2 = F.when(h1 > box_h, F.lit(box_h)).otherwise(h1)
    return w2.cast("int"), h2.cast("int")


# ------------------------------------------------------------- pixel arrays
def image_from_vector(df: DataFrame, key: str, vec_col: str, width: int, channels: int = 1) -> DataFrame:
    """Fixture image table from a numeric vector in [-1, 1]:
    pixel = clamp(floor((x + 1) * 127.5), 0, 255).  The whole vector is used;
    the height follows from its size, and the last row is filled with 0."""
    v = _c(vec_col)
    px = F.transform(v, lambda x: F.least(F.greatest(F.floor((x.cast("double") + 1.0) * 127.5), F.lit(0)),
                                          F.lit(255)).cast("int"))
    height = F.ceil(F.size(v) / F.lit(width * channels)).cast("int")
    return df.select(F.col(key).alias("image_id"), height.alias("height"), F.lit(width).alias("width"),
                     F.lit(channels).alias("n_channels"),
                     F.concat(px, F.array_repeat(F.lit(0), height * width * channels - F.size(v))).alias("data"))


def resize_to_bytes(images: DataFrame, out_h: int, out_w: int, data_col: str = "data",
                    out_col: str = "resized", kind: str = "nearest") -> DataFrame:
    """Exact resize to out_h x out_w (aspect ratio not kept); the pixels of
    ``data_col`` (array of ints, or binary) are replaced by ``out_col``, one
    byte per value, null where the image is null or its data do not fill its
    shape, and empty where it has no pixel.  ``kind``: nearest neighbour, or
    the smoothing filters ``area``, ``linear`` and ``lanczos``.  Images of
    equal shape are resized together, and a batch goes out before it holds
    ``resample.BATCH_VALUES`` values."""
    keep = [f for f in images.schema.fields if f.name != data_col]
    schema = T.StructType([*keep, T.StructField(out_col, T.BinaryType())])
    return images.mapInArrow(lambda it: R.resized_batches(it, out_h, out_w, data_col, out_col, kind), schema)


def resize_images(images: DataFrame, out_h: int, out_w: int, data_col: str = "data",
                  out_col: str = "resized", kind: str = "nearest") -> DataFrame:
    """``resize_to_bytes`` with the pixels as array<int>."""
    return resize_to_bytes(images, out_h, out_w, data_col, out_col, kind).withColumn(out_col, bytes_to_ints(out_col))


def bgr_to_rgb(data: ColumnOrName, channels: ColumnOrName) -> Column:
    """Spark's image source stores BGR(A); models expect RGB(A).  Swap the
    first and third channel of every pixel when there are 3 or 4."""
    d, c = _c(data), _c(channels)

    def src(x, i):
        ch = i % c
        swapped = F.when(ch == 0, i + 2).when(ch == 2, i - 2).otherwise(i)
        return F.element_at(d, (F.when(c >= 3, swapped).otherwise(i) + 1).cast("int"))

    return F.transform(d, src)


def rescale(data: ColumnOrName, factor: float = RESCALE) -> Column:
    """To float array and multiply by ``factor`` (1/255 at train and score)."""
    return F.transform(_c(data), lambda x: x.cast("double") / F.lit(1.0 / factor))


# ------------------------------------------------- decoding and thumbnails
@F.pandas_udf(T.ArrayType(T.IntegerType()))
def bytes_to_ints(b: pd.Series) -> pd.Series:
    """Raw image bytes -> array<int>, vectorised per Arrow batch."""
    return b.map(lambda v: None if v is None else np.frombuffer(v, dtype=np.uint8).astype(np.int32))


def decode_image_struct(images: DataFrame, image_col: str = "image") -> DataFrame:
    """Rows of Spark's image source -> image table (BGR order kept; use
    ``bgr_to_rgb`` before a model)."""
    i = F.col(image_col)
    return images.select(i["origin"].alias("path"), i["height"].alias("height"),
                         i["width"].alias("width"), i["nChannels"].alias("n_channels"),
                         bytes_to_ints(i["data"]).alias("data"))


THUMB_SCHEMA = "path string, name string, width int, height int, n_channels int, bytes binary"


def _fit(w: int, h: int, box_w: int, box_h: int) -> tuple[int, int]:
    """``thumbnail_size`` of one shape."""
    if w > box_w:
        w, h = box_w, max(h * box_w // w, 1)
    if h > box_h:
        w, h = max(w * box_h // h, 1), box_h
    return w, h


def _thumbs(batches: Iterator[pa.RecordBatch], box_w: int, box_h: int, prefix: str, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, px in R.same_shapes(batch, "data", R.BATCH_VALUES):
            if px is None or not px[0].size:
                continue  # undecodable file: skipped, as the reference does
            n, h, w, c = px.shape
            tw, th = _fit(w, h, box_w, box_h)
            path = part.column("path")
            name = pc.replace_substring_regex(path, "^.*/", "")
            yield pa.RecordBatch.from_arrays(
                [path, pc.binary_join_element_wise(prefix, name, ""), *[pa.array([v] * n, pa.int32()) for v in (tw, th, c)],
                 R.as_binary(px if (tw, th) == (w, h) else R.resize(px, th, tw, kind))],
                names=["path", "name", "width", "height", "n_channels", "bytes"])


def thumbnail_job(images: DataFrame, image_col: str = "image", box: tuple[int, int] = THUMB_BOX,
                  allowed: tuple[str, ...] = ("jpg", "jpeg", "png"), prefix: str = "thumbnail",
                  kind: str = "nearest") -> DataFrame:
    """Image-source rows -> thumbnails (name = prefix + file name): only
    allowed extensions, undecodable files skipped, aspect kept, any filter of
    ``resize_to_bytes``; images of equal shape together.  Write the result to
    parquet, or as files with ``ocellus.sources.image_files``."""
    i = F.col(image_col)
    ext = F.lower(F.substring_index(F.substring_index(i["origin"], "/", -1), ".", -1))
    src = images.where(ext.isin(list(allowed))).select(
        i["origin"].alias("path"), i["height"].alias("height"), i["width"].alias("width"),
        i["nChannels"].alias("n_channels"), i["data"].alias("data"))
    return src.mapInArrow(lambda it: _thumbs(it, box[0], box[1], prefix, kind), THUMB_SCHEMA)


def write_thumbnails(thumbs: DataFrame, path: str) -> None:
    """Thumbnail set sink: parquet rows (name, bytes, width, height)."""
    thumbs.write.mode("overwrite").parquet(path)
