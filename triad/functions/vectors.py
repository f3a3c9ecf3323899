"""Dense-vector expressions over ``array<float|double>`` columns (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def l2_distance(a, b) -> Column:
    d = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(_sum(F.transform(d, lambda x: x * x)))


def normalize(a) -> Column:
    n = norm(a)
    return F.transform(_c(a), lambda x: (x.cast("double") / n).cast("float"))
