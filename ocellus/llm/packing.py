"""Pattern packing of documents into fixed-length token sequences.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (one count per length) reaches the driver.  There, patterns of
one to three length classes that fill a sequence are enumerated, non-negative
least squares fits how often each is used, the counts are rounded down, and
what remains is packed best-fit, longest first, also into the gaps that the
patterns leave.  The plan is a list of intervals: the pieces of one length
with ranks in ``[lo, hi)`` go to consecutive sequences.  Each piece then finds
its place from its length and rank; nothing is gathered by sequence.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import materialise
from ocellus.llm.tokens import in_blocks, shared_encoder

VOCAB, END_ID, CAPACITY = "word_bpe_49k.json", 0, 2048
#: Length classes that the patterns distinguish.
CLASSES = 256


def _pieces(vocab: str, end_id: int, capacity: int, with_ids: bool):
    import zlib

    def run(batches):
        encoder, end = shared_encoder(vocab), np.array([end_id], "<u4").tobytes()
        task, met = TaskContext.get().partitionId(), defaultdict(int)
        width = 4 * capacity
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in in_blocks(texts):
                col = {c: [] for c in ("at", "piece", "length", "rank", "crc", "ids")}
                for i, raw in enumerate(encoder.encode(texts[a:b])):
                    raw += end
                    for piece, at in enumerate(range(0, len(raw), width)):
                        part = raw[at:at + width]
                        n = len(part) // 4
                        for c, v in zip(col, (a + i, piece, n, met[n], zlib.crc32(part), part if with_ids else None)):
                            col[c].append(v)
                        met[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(col["at"], pa.int64())), pa.array(col["piece"], pa.int32()),
                     pa.array(np.array(col["piece"], np.int64) * capacity), pa.array(col["length"], pa.int64()),
                     pa.array(col["crc"], pa.int64()), pa.array(col["ids"], pa.binary()),
                     pa.array([task] * len(col["at"]), pa.int32()), pa.array(col["rank"], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "rank"])
    return run


def nnls(a: np.ndarray, b: np.ndarray, tol: float = 1e-9) -> np.ndarray:
    """Lawson-Hanson: argmin ||ax - b|| with x >= 0."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    limit = tol * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * len(b)):
        slope = np.where(used, -np.inf, a.T @ (b - a @ x))
        j = int(np.argmax(slope))
        if slope[j] <= limit:
            break
        used[j] = True
        while True:
            at = np.flatnonzero(used)
            part = a[:, at]  # few columns: the full normal matrix would take the driver's memory
            z = np.linalg.lstsq(part.T @ part, part.T @ b, rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[at] = z
                break
            down = at[z <= 0]
            step = np.min(x[down] / np.maximum(x[down] - z[z <= 0], 1e-300))
            x[at] += step * (z - x[at])
            used[at[x[at] <= 1e-12]] = False
            x[~used] = 0
            if not used.any():
                break
    return x


def patterns(classes: int) -> list[tuple[int, ...]]:
    """Multisets of one to three length classes whose upper ends fill a sequence."""
    out = [(classes,)]
    for i in range(classes - 1, 0, -1):
        for j in range(min(i, classes - i), 0, -1):
            k = classes - i - j
            if k == 0:
                out.append((i, j))
            elif k <= j:
                out.append((i, j, k))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES):
    """``(intervals, sequences)`` for counts by piece length.  An interval
    ``(length, lo, hi, each, sequence, offset)`` puts the pieces of that
    length ranked ``lo`` to ``hi - 1``, ``each`` to a sequence one after
    another, from that sequence on at that offset.  Its size depends on the
    number of lengths, not on the number of pieces."""
    left = {n: c for n, c in histogram.items() if c}
    taken, intervals, sequences = defaultdict(int), [], 0
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> (first sequence, how many)

    def put(length, count, each, sequence, offset):
        intervals.append((length, taken[length], taken[length] + count, each, sequence, offset))
        taken[length] += count
        left[length] -= count

    width = -(-capacity // classes)
    shapes = [p for p in patterns(-(-capacity // width))]
    kind = lambda n: -(-n // width)
    wanted = np.zeros(max(p[0] for p in shapes))
    for n, c in left.items():
        wanted[kind(n) - 1] += c
    a = np.zeros((len(wanted), len(shapes)))
    for j, shape in enumerate(shapes):
        for i in shape:
            a[i - 1, j] += 1
    alive = wanted > 0
    usable = [j for j in range(len(shapes)) if alive[np.array(shapes[j]) - 1].all()]
    times = nnls(a[:, usable], wanted) if usable else []
    by_class = defaultdict(list)
    for n in sorted(left):
        by_class[kind(n)].append(n)

    def longest(c):
        while by_class[c] and not left[by_class[c][-1]]:
            by_class[c].pop()
        return by_class[c][-1] if by_class[c] else 0

    known = sorted(left)

    def fitting(free):
        """The longest length left that is at most ``free``."""
        i = bisect_right(known, free)
        while i and not left[known[i - 1]]:
            i -= 1
        return known[i - 1] if i else 0

    for j, x in sorted(zip(usable, times), key=lambda t: shapes[t[0]], reverse=True):
        count = int(x + 1e-9)
        while count > 0:
            lengths = [longest(c) for c in shapes[j]]
            if len(lengths) > 1:  # the last one fills the gap as well as it can
                lengths[-1] = fitting(capacity - sum(lengths[:-1]))
            need = {n: lengths.count(n) for n in lengths}
            if 0 in need or any(left[n] < k for n, k in need.items()):
                break
            run = min(count, *(left[n] // k for n, k in need.items()))
            offset = 0
            for n in lengths:
                put(n, run, 1, sequences, offset)
                offset += n
            if offset < capacity:
                room[capacity - offset].append((sequences, run))
            sequences += run
            count -= run

    for n in sorted(left, reverse=True):
        while left[n]:
            free = min((f for f, r in room.items() if f >= n and r), default=0)
            if not free:
                each = capacity // n
                count = -(-left[n] // each)
                room[capacity].append((sequences, count))
                sequences += count
                continue
            first, count = room[free].pop()
            each = free // n
            full = min(count, left[n] // each)
            if full:
                put(n, full * each, each, first, capacity - free)
                if free > each * n:
                    room[free - each * n].append((first, full))
            first, count = first + full, count - full
            if count and left[n]:
                rest = left[n]
                put(n, rest, rest, first, capacity - free)
                if free > rest * n:
                    room[free - rest * n].append((first, 1))
                first, count = first + 1, count - 1
            if count:
                room[free].append((first, count))
    return intervals, sequences


def _place(intervals: list[tuple[int, ...]]):
    table = np.array(sorted(intervals), np.int64).reshape(-1, 6)

    def run(batches):
        high = 1 << 44  # ranks stay below
        keys = table[:, 0] * high + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            _, lo, _, each, sequence, offset = table[np.searchsorted(keys, length * high + rank, "right") - 1].T
            near = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*near.columns, pa.array(sequence + (rank - lo) // each), pa.array(offset + (rank - lo) % each * length)],
                names=[*near.schema.names, "sequence_id", "offset"])
    return run


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, vocab: str = VOCAB,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``,
    one row per piece.  ``ids`` are the piece's token ids as little-endian
    unsigned 32-bit integers (null unless ``with_ids``), ``ids_crc32`` their
    checksum.  Every row of ``docs`` is packed: null and empty texts are just
    ``end_id``, texts over ``capacity`` tokens are cut, repeated rows and null
    ids are documents of their own.  Other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialise(spark, rows.mapInArrow(
        _pieces(vocab, end_id, capacity, with_ids),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, rank long"),
        "pack-pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    intervals, _ = plan(histogram, capacity)
    # pieces are ranked within their task when written; here the ranks of earlier tasks go before
    earlier = counts.select("task", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("earlier"))
    ranked = pieces.join(earlier, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("rank") + F.col("earlier")).alias("rank"))
    return ranked.mapInArrow(_place(intervals), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, ids binary, sequence_id long, offset long")
