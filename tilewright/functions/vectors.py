"""Vector expressions over ``array`` columns, in double precision and without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column | str) -> Column:
    """``v`` as ``array<double>``."""
    return F.col(v).cast("array<double>") if isinstance(v, str) else v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product; arrays must have the same length, null when either is null."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda s, x: s + x * x))


def l2_normalise(v: Column, eps: float = 1e-12) -> Column:
    """``v / max(|v|, eps)`` for each component."""
    length = F.greatest(norm(v), F.lit(eps))
    return F.transform(v, lambda x: x / length)


def cosine(a: Column, b: Column, eps: float = 1e-8) -> Column:
    """Cosine similarity; each length counts as ``eps`` at least."""
    return dot(a, b) / (F.greatest(norm(a), F.lit(eps)) * F.greatest(norm(b), F.lit(eps)))


def argmax(v: Column) -> Column:
    """0-based place of the largest component; the first of equals."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")
