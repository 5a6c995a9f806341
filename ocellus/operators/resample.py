"""Resizing images in batches of equal shape.

Nearest neighbour is a gather.  The smoothing filters are separable: an output
pixel is a weighted sum over source rows and columns, so a batch of equal
shape is resized by two matrix products.  Pixels go to and from Python as
bytes, one per value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pixel values that one resized batch may hold.
BATCH_VALUES = 8_000_000


def nearest_indices(src: int, dst: int) -> np.ndarray:
    """Nearest source index per target index: floor((i + 0.5) * src / dst)."""
    return ((2 * np.arange(dst) + 1) * src) // (2 * dst)


def filter_weights(src: int, dst: int, kind: str) -> np.ndarray:
    """``dst x src`` weights, each row adding up to 1.  ``area``: the share of
    the target cell that a source pixel covers; ``linear`` and ``lanczos``: the
    window around the cell's middle, widened by the scale when shrinking."""
    scale = src / dst
    if kind == "area":
        edge = np.arange(dst + 1) * src  # in units of 1 / dst source pixels
        low, high = edge[:-1, None], edge[1:, None]
        pixel = np.arange(src + 1) * dst
        return np.clip(np.minimum(high, pixel[1:]) - np.maximum(low, pixel[:-1]), 0, None) / src
    wide = max(scale, 1.0)
    x = (np.arange(src) + 0.5 - (np.arange(dst)[:, None] + 0.5) * scale) / wide
    if kind == "linear":
        w = np.clip(1 - np.abs(x), 0, None)
    elif kind == "lanczos":
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    else:
        raise ValueError(f"unknown filter {kind!r}")
    return w / w.sum(axis=1, keepdims=True)


def resize(px: np.ndarray, out_h: int, out_w: int, kind: str = "nearest") -> np.ndarray:
    """``n x h x w x c`` bytes to ``n x out_h x out_w x c``; smoothed values are
    rounded, halves up, and kept within a byte."""
    n, h, w, c = px.shape
    if kind == "nearest":
        return px[:, nearest_indices(h, out_h)][:, :, nearest_indices(w, out_w)]
    rows = np.matmul(filter_weights(h, out_h, kind), px.reshape(n, h, w * c).astype(float))
    both = np.matmul(filter_weights(w, out_w, kind), rows.reshape(n * out_h, w, c))
    return np.clip(np.floor(both + 0.5), 0, 255).astype(np.uint8).reshape(n, out_h, out_w, c)


def same_shapes(batch: pa.RecordBatch, data_col: str, values: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None]]:
    """Parts of ``batch`` with images of one shape as ``n x h x w x c`` bytes,
    at most ``values`` values each (one image at least).  Rows without an
    image, or whose data do not fill the shape, come with None."""
    data = batch.column(data_col)
    binary = pa.types.is_binary(data.type) or pa.types.is_large_binary(data.type)
    size = pc.fill_null((pc.binary_length if binary else pc.list_value_length)(data), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    shape = np.stack([pc.fill_null(batch.column(c), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                      for c in ("height", "width", "n_channels")], axis=1)
    ok = pc.is_valid(data).to_numpy(zero_copy_only=False) & (shape >= 0).all(1) & (shape.prod(1) == size)
    if (~ok).any():
        yield batch.take(pa.array(np.flatnonzero(~ok))), None
    if binary:
        flat = np.frombuffer(b"".join(v for v in data.to_pylist() if v is not None), np.uint8)
    else:
        flat = data.flatten().to_numpy(zero_copy_only=False).astype(np.uint8)
    first = np.cumsum(size) - size
    kinds, which = np.unique(shape[ok], axis=0, return_inverse=True)
    rows = np.flatnonzero(ok)
    for k, (h, w, c) in enumerate(kinds):
        same = rows[which.ravel() == k]
        step = max(1, values // max(1, int(h * w * c)))
        for a in range(0, len(same), step):
            part = same[a:a + step]
            px = flat[first[part][:, None] + np.arange(h * w * c)].reshape(len(part), h, w, c)
            yield batch.take(pa.array(part)), px


def as_binary(px: np.ndarray) -> pa.Array:
    """One binary value per image."""
    n = len(px)
    raw = np.ascontiguousarray(px, np.uint8)
    offsets = np.arange(n + 1, dtype=np.int32) * (raw.size // n if n else 0)
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def resized_batches(batches, out_h: int, out_w: int, data_col: str, out_col: str, kind: str):
    """``data_col`` replaced by the resized ``out_col`` as bytes."""
    for batch in batches:
        kept = [c for c in batch.schema.names if c != data_col]
        deepest = max(1, pc.max(batch.column("n_channels")).as_py() or 1) if batch.num_rows else 1
        step = max(1, BATCH_VALUES // (out_h * out_w * deepest))
        for part, px in same_shapes(batch, data_col, BATCH_VALUES):
            for a in range(0, part.num_rows, step):
                rows = part.slice(a, step)
                if px is None:
                    out = pa.nulls(rows.num_rows, pa.binary())
                elif px[0].size:
                    out = as_binary(resize(px[a:a + step], out_h, out_w, kind))
                else:
                    out = pa.array([b""] * rows.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], out], names=[*kept, out_col])
