"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalise(a: Column) -> Column:
    """Length one; null for null and all-zero vectors."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
