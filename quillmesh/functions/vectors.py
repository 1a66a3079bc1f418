"""Vector and matrix expressions over ARRAY<DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a - b)


def scale(number: Column, vector: Column) -> Column:
    return F.transform(vector, lambda v: number * v)


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def squared_norm(vector: Column) -> Column:
    return dot(vector, vector)


def apply_matrix(matrix, vector: Column) -> Column:
    """``matrix . vector`` for a small driver-side matrix."""
    rows = [F.array(*(F.lit(float(v)) for v in row)) for row in matrix]
    return F.array(*(dot(row, vector) for row in rows))


def outer(left: Column, right: Column) -> Column:
    """``left . right^T`` as an array of rows."""
    return F.transform(left, lambda a: F.transform(right, lambda b: a * b))


def divide_or_zero(number: Column, divisor: Column) -> Column:
    """0 whenever the numerator is 0, which covers 0/0 after underflow."""
    return F.when(number == 0, F.lit(0.0)).otherwise(number / divisor)


def pair_kernel(left: Column, right: Column, difference: Column) -> Column:
    """exp(-|d|^2), and 0 for a sample paired with itself."""
    return F.when(left == right, F.lit(0.0)).otherwise(F.exp(-squared_norm(difference)))
