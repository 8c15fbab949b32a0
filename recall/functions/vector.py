"""Vector expressions on arrays, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity; null for a null or zero vector, or unequal lengths."""
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))
