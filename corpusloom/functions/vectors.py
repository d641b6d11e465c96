"""Column expressions over vectors (arrays of numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    pair = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(pair, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero if either length is zero; the sizes must agree."""
    n = norm(a) * norm(b)
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors differ in size")).cast("double")).when(n == 0, 0.0).otherwise(dot(a, b) / n)


def unit(a: Column) -> Column:
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a.cast("array<double>"), lambda x: x / n)


def finite(a: Column) -> Column:
    return F.forall(a.cast("array<double>"), lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
