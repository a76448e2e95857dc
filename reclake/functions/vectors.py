"""Vector expressions over ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(values: Column) -> Column:
    return values.cast("array<double>")


def literal(values: list[float]) -> Column:
    return F.array(*[F.lit(float(value)) for value in values])


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, value: acc + value)


def dot(left: Column, right: Column) -> Column:
    return total(F.zip_with(left, right, lambda a, b: a * b))


def scale(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda value: value * factor)


def sigmoid(value: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-value))


def zeros(dim: int, kind: str = "double") -> Column:
    return F.array_repeat(F.lit(0.0).cast(kind), dim)
