"""Vector expressions over ``array<float>`` columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(a: Column) -> Column:
    squares = F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector has no length.

    Rounded to 12 places, so that equal vectors tie exactly.
    """
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(F.round(dot(a, b) / norms, 12))
