"""Column expressions over numeric arrays (probabilities, logits, features).

All are built from Spark's higher-order functions, evaluated in the JVM; no
Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_doubles(col: ColumnOrName) -> Column:
    """array<float|int> -> array<double> (cast before any rounding so both
    engines see the same value)."""
    return F.transform(_c(col), lambda x: x.cast("double"))


def array_sum(col: ColumnOrName) -> Column:
    return F.aggregate(_c(col), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def softmax(col: ColumnOrName) -> Column:
    """Numerically stable softmax over one array."""
    a = _c(col)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = array_sum(e)
    return F.transform(e, lambda x: x / s)


def sigmoid(col: ColumnOrName) -> Column:
    return F.transform(_c(col), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def argmax(col: ColumnOrName) -> Column:
    """0-based index of the first maximum."""
    a = _c(col)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def topk(col: ColumnOrName, k: int) -> Column:
    """array<struct<idx int, prob double>> of the k largest values,
    descending; ties go to the lower index."""
    a = _c(col)
    keyed = F.transform(a, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx")))
    best = F.slice(F.array_sort(keyed), 1, k)
    return F.transform(best, lambda s: F.struct(s["idx"].cast("int").alias("idx"),
                                                (-s["neg"]).alias("prob")))


def any_element_matches(col: ColumnOrName, pattern: str) -> Column:
    """1 if any element, lower-cased, matches the regex ``pattern``
    (the pattern itself is used as given); a null array gives 0."""
    hit = F.exists(_c(col), lambda x: F.lower(x).rlike(pattern))
    return F.coalesce(hit.cast("int"), F.lit(0))
