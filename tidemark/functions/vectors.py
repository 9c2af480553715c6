"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle between two vectors; null if either has length zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.nullif(norms, F.lit(0.0))
