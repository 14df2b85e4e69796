"""Vector arithmetic on array columns with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbwatch.functions.scalar import as_column


def to_double(vector: Column | str) -> Column:
    return as_column(vector).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(to_double(a), to_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vector: Column | str) -> Column:
    squares = F.aggregate(to_double(vector), F.lit(0.0), lambda acc, x: acc + x * x)
    return F.sqrt(squares)


def l2_normalize(vector: Column | str) -> Column:
    """Unit vector; the zero vector stays zero."""
    norm = l2_norm(vector)
    return F.transform(to_double(vector), lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; 0.0 when one of them is zero."""
    length = l2_norm(a) * l2_norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))


def mean_of_dimensions(vector: Column | str, dim: int) -> Column:
    """Aggregate expression: mean of each dimension, as an array.

    One average per dimension in one hash aggregate: rows are combined before the shuffle and
    nothing is exploded, so a key with a third of all vectors is a single row per input task.
    """
    vector = as_column(vector)
    return F.array(*[F.avg(F.get(vector, F.lit(i)).cast("double")) for i in range(dim)])


def net_intent(churn: Column, retention: Column, discount: float) -> Column:
    """Similarity to leaving minus a share of similarity to staying, in [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), churn - retention * F.lit(discount)))
