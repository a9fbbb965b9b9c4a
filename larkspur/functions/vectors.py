"""Arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; NULL if a side is NULL or has length zero."""
    return F.try_divide(dot(left, right), norm(left) * norm(right))


def mean_vector(vector: Column, size: int) -> list[Column]:
    """Aggregates for the component-wise mean of a vector column of known size."""
    return [F.avg(vector[index]).alias(f"m{index}") for index in range(size)]
