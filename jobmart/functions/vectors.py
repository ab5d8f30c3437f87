"""cosine similarity of two array<float> columns, natively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_similarity(a: Column, b: Column, b_norm: Column | None = None) -> Column:
    """NULL when either side is NULL, empty or all zero.  ``b_norm``: the norm of ``b`` where
    it is known already (one query vector for all rows)."""
    denom = norm(a) * (norm(b) if b_norm is None else b_norm)
    return F.when(denom > 0, dot(a, b) / denom)
