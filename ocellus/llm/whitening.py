"""Embedding whitening by a bidiagonal qd solver.

Blocks of centred rows are reduced to triangles by QR, and triangles are stacked
and reduced again until one is left; it has the singular values and right
directions of all rows.  Householder reflections make it bidiagonal.  The
differential qd algorithm with shifts finds the singular values to high
relative accuracy, and a twisted factorisation of the bidiagonal's normal matrix at each
value gives its direction, which the reflections carry back.

Vectors of each length are whitened on their own.  What is kept per length is
of the size of one triangle (length squared), whatever the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows of a block, at least; triangles that are merged at a time.
BLOCK_ROWS, FAN = 1024, 8
#: Bytes of whitening directions that are sent to tasks at once.
MODEL_BYTES = 64_000_000
EPS = float(np.finfo(float).eps)


# --- the solver, on one matrix -------------------------------------------

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(d, e, v)``: diagonal and superdiagonal of ``u.T @ r @ v``; ``v``
    orthogonal, by Householder reflections from both sides."""
    a = np.array(r, float)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x):
        w, size = x.copy(), np.linalg.norm(x)
        w[0] += math.copysign(size, x[0])
        length = np.linalg.norm(w)
        return w / length if length else None

    for k in range(n):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w = reflector(a[k, k + 1:])
            if w is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float):
    """One differential step with ``shift``; None where a value would turn
    negative, as the shift is too large."""
    d = q[0] - shift
    new_q, new_e = [], []
    for i in range(len(e)):
        s = d + e[i]
        if s <= 0 or d < 0:
            return None
        ratio = q[i + 1] / s
        new_q.append(s)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if not d >= 0:
        return None
    new_q.append(d)
    return new_q, new_e


def singular_squares(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix without zeros,
    largest first, by the dqds iteration: each step shifts by less than the
    smallest that is left, and the last one splits off."""
    parts = [((d * d).tolist(), (e * e).tolist(), 0.0)]
    found = []
    while parts:
        q, z, base = parts.pop()  # what is left, less ``base`` in shifts
        while len(q) > 1:
            if sum(q[:len(q) // 2]) < sum(q[len(q) // 2:]) / 3:  # the small ones to the end
                q, z = q[::-1], z[::-1]
            cut = next((i for i in range(len(z) - 1, -1, -1)
                        if z[i] <= max(EPS * EPS * (base + min(q[i], q[i + 1])), 1e-290)), None)
            if cut is not None:
                parts.append((q[:cut + 1], z[:cut], base))
                q, z = q[cut + 1:], z[cut + 1:]
                continue
            # the smaller one of the last two by two
            a, b, c = q[-2] + (z[-2] if len(z) > 1 else 0.0), z[-1], q[-1]
            half = 0.5 * (a - c + b)
            low = half + c + math.hypot(half, math.sqrt(b * c))
            small = a * (c / low) if low else 0.0
            for shift in (small * (1 - 4 * EPS), 0.75 * small - math.sqrt(b * c), 0.25 * small, 0.0):
                step = _dqds(q, z, shift) if shift >= 0 else None
                if step:
                    break
            if not step:  # zeros among them: lifted to a size that no value here shows
                shift, step = 0.0, _dqds([max(x, 1e-290) for x in q], z, 0.0)
            q, z = step
            base += shift
        found.append(q[0] + base)
    return np.sort(np.array(found))[::-1]


def twisted(d: np.ndarray, e: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """Unit vector of ``b.T @ b - value`` nearest to singular, ``b`` being the
    bidiagonal: the stationary factorisation from the top and the progressive
    one from the bottom meet where their common pivot is least.  With
    ``start``, one step of inverse iteration from it instead."""
    n = len(d)
    diag = d * d
    diag[1:] += e * e
    off = d[:-1] * e
    tiny = EPS * EPS * max(diag.max(), 1e-290)
    down, up = np.empty(n), np.empty(n)  # pivots from the top, from the bottom
    s = -value  # stationary qd: s carries what the shift has left
    for i in range(n):
        down[i] = d[i] * d[i] + s
        if abs(down[i]) < tiny:
            down[i] = tiny
        if i < n - 1:
            s = s * (e[i] / down[i]) * e[i] - value
    p = d[-1] * d[-1] - value  # progressive qd
    gamma = np.empty(n)
    for i in range(n - 1, 0, -1):
        up[i] = e[i - 1] * e[i - 1] + p
        if abs(up[i]) < tiny:
            up[i] = tiny
        p = p * (d[i - 1] / up[i]) * d[i - 1] - value
    up[0] = p if abs(p) >= tiny else tiny
    for i in range(n):  # the pivot where the two meet at i
        gamma[i] = down[i] + up[i] - (diag[i] - value)
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    if start is None:
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -off[i] * z[i + 1] / down[i]
        for i in range(r + 1, n):
            z[i] = -off[i - 1] * z[i - 1] / up[i]
    else:
        pivot = gamma[r] if abs(gamma[r]) > tiny else tiny
        y = start.copy()
        for i in range(1, r + 1):
            y[i] -= off[i - 1] / down[i - 1] * y[i - 1] if i < r else 0.0
        for i in range(n - 2, r, -1):
            y[i] -= off[i] / up[i + 1] * y[i + 1]
        if r:
            y[r] -= off[r - 1] / down[r - 1] * y[r - 1]
        if r < n - 1:
            y[r] -= off[r] / up[r + 1] * y[r + 1]
        z[r] = y[r] / pivot
        for i in range(r - 1, -1, -1):
            z[i] = (y[i] - off[i] * z[i + 1]) / down[i]
        for i in range(r + 1, n):
            z[i] = (y[i] - off[i - 1] * z[i - 1]) / up[i]
    size = np.abs(z).max()
    if not np.isfinite(size) or size == 0:
        z = np.zeros(n)
        z[r] = size = 1.0
    z = z / size
    return z / np.linalg.norm(z)


def _pairs(d: np.ndarray, e: np.ndarray, most: int):
    """``[(value, vector)]``: squares of the largest ``most`` singular values
    of an unreduced bidiagonal and their right directions."""
    values = singular_squares(d, e)
    out, rng = [], np.random.default_rng(len(d))
    for value in values[:most]:
        z = twisted(d, e, value)
        # values closer than vectors can tell apart: made orthogonal, and sharpened again
        close = [w for v, w in out if v - value <= 1e-3 * max(v, 1e-300)]
        for attempt in range(6 if close else 0):
            flat = z.copy()
            for _ in range(2):
                for w in close:
                    flat -= (w @ flat) * w
            left = np.linalg.norm(flat)
            z = flat / left if left > 0 else flat
            if left > 0.5 and attempt:
                break
            if left < 1e-8:
                z = rng.normal(size=len(d))
                continue
            z = twisted(d, e, value, z)
        if close:
            for w in close:
                z -= (w @ z) * w
            z /= np.linalg.norm(z)
        out.append((float(value), z))
    return out


def directions(r: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: the ``most`` largest squared singular values of
    ``r``, falling, and the unit right directions as rows.  Values below
    rounding of the largest are 0."""
    r = np.atleast_2d(np.asarray(r, float))
    n = r.shape[1]
    size = np.abs(r).max(initial=0.0)
    if not size:
        return np.zeros(min(most, n)), np.eye(n)[:most]
    d, e, v = bidiagonalise(np.vstack([r / size, np.zeros((max(0, n - len(r)), n))]))
    norm = max(np.abs(d).max(), np.abs(e).max(initial=0.0))
    d = np.where(np.abs(d) < EPS * EPS * norm, EPS * EPS * norm, d)
    cuts = [0, *(np.flatnonzero(np.abs(e) <= EPS * EPS * norm) + 1).tolist(), n]
    found = []
    for a, b in zip(cuts, cuts[1:]):
        for value, z in _pairs(d[a:b], e[a:b - 1], most):
            full = np.zeros(n)
            full[a:b] = z
            found.append((value, v @ full))
    found.sort(key=lambda x: -x[0])
    found = found[:most]
    values = np.array([x for x, _ in found])
    vectors = np.array([z for _, z in found])
    values[values < (4 * n * EPS) ** 2 * values[0]] = 0.0
    rank = int((values > 0).sum())
    if rank < len(values):  # no direction is marked out: any that completes the others
        vectors[rank:] = np.linalg.qr(vectors[:rank].T, mode="complete")[0].T[rank:len(values)]
    return values * size * size, vectors


# --- the rows, on Spark ---------------------------------------------------

def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, x, size``: rows whose vector is not null or empty and holds
    no null or non-finite entry; ``x`` are the long ``floor(64 c) + 1000000``.
    Entries whose ``x`` would leave the range of 62 bits count as not finite."""
    ok = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        "v is not null and size(v) > 0 and not exists(v, c -> c is null)"
        f" and forall(v, c -> not isnan(c) and abs(c) < {float(2 ** 61) / SCALE}D)")
    return ok.select("vec_id", F.expr(f"transform(v, c -> floor({SCALE} * c) + {SHIFT}L)").alias("x"),
                     F.size("v").alias("size"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _by_size(batch):
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def _sums(batches):
    """Exact sums per dimension, in two halves that fit their columns."""
    total: dict[int, list] = {}
    for batch in batches:
        for size, part in _by_size(batch):
            x = _matrix(part.column("x"))
            n, high, low = total.get(size, (0, 0, 0))
            total[size] = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    for size, (n, high, low) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
             pa.array(high), pa.array(low)], names=["size", "dim", "n", "high", "low"])


class Centre:
    """Mean of the vectors of one length: ``n`` and the sums, exact."""
    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = max(map(abs, sums)) < 1 << 61

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: longs, or Python's integers where they
        could be too large."""
        if self.small and (not x.size or max(abs(int(x.max())), abs(int(x.min()))) < (1 << 61) // self.n):
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list:
        """Exact sums of squares; None beyond a long."""
        off = self.offsets(x)
        if off.dtype != object and float(np.abs(off).max(initial=0)) ** 2 * off.shape[1] < 2.0 ** 62:
            return (off * off).sum(1).tolist()
        exact = [sum(int(v) * int(v) for v in row) for row in off]
        return [v if v < 1 << 63 else None for v in exact]


_TRIANGLE = "size int, part int, triangle binary"


def _triangle(size: int, part: int, r: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([part], pa.int32()),
                                       pa.array([r.tobytes()], pa.binary())], names=["size", "part", "triangle"])


def _reduce(centres: dict[int, Centre]):
    """The partition's triangle per length, from blocks of centred rows."""
    def run(batches):
        from pyspark import TaskContext

        held: dict[int, list[np.ndarray]] = {}

        def reduced(size):
            return np.linalg.qr(np.vstack(held[size]), mode="r")

        for batch in batches:
            for size, part in _by_size(batch):
                held.setdefault(size, []).append(centres[size].centred(_matrix(part.column("x"))))
                if sum(map(len, held[size])) > max(BLOCK_ROWS, 4 * size):
                    held[size] = [reduced(size)]
        for size in held:
            yield _triangle(size, TaskContext.get().partitionId(), reduced(size))
    return run


def _merge(frame):
    import pandas as pd

    size = int(frame["size"].iloc[0])
    r = None
    for raw in frame["triangle"]:
        t = np.frombuffer(raw, float).reshape(-1, size)
        r = t if r is None else np.linalg.qr(np.vstack([r, t]), mode="r")
    return pd.DataFrame([{"size": size, "part": int(frame["part"].iloc[0]) // FAN, "triangle": np.ascontiguousarray(r).tobytes()}])


_MODEL = "size int, values array<double>, vectors binary, trace double"


def _solve(centres: dict[int, Centre]):
    def run(batches):
        for batch in batches:
            for size, raw in zip(batch.column("size").to_pylist(), batch.column("triangle").to_pylist()):
                r = np.frombuffer(raw, float).reshape(-1, size)
                values, vectors = directions(r)
                n = centres[size].n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([(values / n).tolist()], pa.list_(pa.float64())),
                     pa.array([vectors.tobytes()], pa.binary()), pa.array([float((r * r).sum()) / n])],
                    names=["size", "values", "vectors", "trace"])
    return run


def _project(centre: Centre, model: dict, x: np.ndarray) -> np.ndarray:
    """Whitened rows; columns of components without variance are 0."""
    values = np.asarray(model["values"])
    vectors = np.frombuffer(model["vectors"], float).reshape(len(values), -1)
    with np.errstate(divide="ignore"):
        scale = np.where(values > 0, 1 / np.sqrt(values), 0.0)
    return centre.centred(x) @ vectors.T * scale


def _moments(centres, models):
    """Sums and product sums of the whitened fit list, per partition."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in _by_size(batch):
                w = _project(centres[size], models[size], _matrix(part.column("x")))
                w = np.hstack([w, np.ones((len(w), 1))])
                total[size] = total.get(size, 0) + w.T @ w
        for size, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(i), pa.int32()), pa.array(i, pa.int32()),
                                              pa.array(j, pa.int32()), pa.array(m[i, j])], names=["size", "i", "j", "v"])
    return run


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


def _whiten(centres, models, errors):
    def run(batches):
        for batch in batches:
            for size, part in _by_size(batch):
                x, model, centre = _matrix(part.column("x")), models[size], centres[size]
                values, rows = np.asarray(model["values"]), len(x)
                w, k = _project(centre, model, x), len(values)
                share = values / model["trace"] if model["trace"] else np.zeros(k)
                flat = np.tile(values > 0, rows)
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k)))
                deviation = pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                     pa.array(np.full(rows * k, centre.n), pa.int64()), deviation,
                     pa.array(w.ravel(), mask=~flat), pa.array(np.tile(share, rows)),
                     pa.array(np.full(rows * k, errors[size]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def fit(spark: SparkSession, fit_list: DataFrame, sizes: list[int], centres: dict[int, Centre]) -> dict[int, dict]:
    """The model of each length: values, vectors, trace."""
    triangles = materialise(spark, fit_list.where(F.col("size").isin(sizes)).mapInArrow(
        _reduce(centres), _TRIANGLE), "whitening-triangles")
    most = triangles.agg(F.max("part")).first()[0]
    while most:  # FAN neighbours at a time
        triangles = materialise(spark, triangles.groupBy("size", F.expr(f"part div {FAN}").alias("next")).applyInPandas(
            _merge, _TRIANGLE), "whitening-triangles")
        most //= FAN
    # a length's triangles may have come under one number only
    solved = triangles.groupBy("size").applyInPandas(_merge, _TRIANGLE).mapInArrow(_solve(centres), _MODEL)
    return {r["size"]: r.asDict() for r in solved.collect()}


def whitened(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained,
    identity_error``: for each usable row of ``rows(vec_id, embedding)`` (see
    ``usable``) its components up to the 16th.

    The fit list has each distinct ``x`` of a length once; vectors of every
    length are whitened on their own.  Repeated rows and null ids are returned
    as they come.  A component without variance (fewer distinct vectors than
    components, constant entries) has a null ``whitened`` and ``explained`` 0,
    and ``identity_error`` leaves it out.  ``deviation`` is null where it
    does not fit a long.  Other columns are ignored; an empty table gives no
    rows."""
    ok = materialise(spark, usable(rows).withColumn("vec_id", F.col("vec_id").cast("long")), "whitening-rows")
    fit_list = materialise(spark, ok.select("x", "size").distinct(), "whitening-fit")
    sums = fit_list.mapInArrow(_sums, "size int, dim int, n long, high long, low long").groupBy("size", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    by_size: dict[int, list] = {}  # a row per length and dimension
    for r in sums.orderBy("size", "dim").collect():
        by_size.setdefault(r["size"], []).append((r["n"], (int(r["high"]) << 32) + int(r["low"])))
    centres = {size: Centre(v[0][0], [s for _, s in v]) for size, v in by_size.items()}
    passes, room = [[]], MODEL_BYTES
    for size in sorted(centres):  # as many lengths at a time as may be sent
        need = 8 * size * (COMPONENTS + 4)
        if need > room and passes[-1]:
            passes.append([])
            room = MODEL_BYTES
        passes[-1].append(size)
        room -= need
    out = None
    for sizes in passes:
        own = {s: centres[s] for s in sizes}
        models = fit(spark, fit_list, sizes, own) if sizes else {}
        here = F.col("size").isin(sizes) if sizes else F.lit(False)
        moments = fit_list.where(here).mapInArrow(_moments(own, models), "size int, i int, j int, v double").groupBy(
            "size", "i", "j").agg(F.sum("v").alias("v")).collect()  # 153 rows per length
        errors = {}
        for s in sizes:
            m = np.zeros((len(models[s]["values"]) + 1,) * 2)
            for r in (r for r in moments if r["size"] == s):
                m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
            cov = m[:-1, :-1] / own[s].n - np.outer(m[:-1, -1], m[:-1, -1]) / own[s].n ** 2
            some = np.asarray(models[s]["values"]) > 0
            errors[s] = float(np.abs(cov - np.eye(len(cov)))[np.ix_(some, some)].max(initial=0.0))
        one = ok.where(here).mapInArrow(_whiten(own, models, errors), _OUT)
        out = one if out is None else out.union(one)
    return out
