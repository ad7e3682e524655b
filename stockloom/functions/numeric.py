"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    """A money value as a decimal of ten places; NaN and infinities are null."""
    return value.try_cast("decimal(28,10)")


def exact_sum(value: Column) -> Column:
    """Sum of money values as a double; null when all are null or no number.

    Decimals are summed, so the result does not depend on the order of rows or on
    how often a lost task is repeated.
    """
    return F.sum(money(value)).cast("double")


def ratio_or(numerator: Column, denominator: Column, fallback: float) -> Column:
    """``numerator / denominator``; ``fallback`` where that is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(fallback))


def mean_of(columns: list[Column]) -> Column:
    """Row-wise mean; null unless every column has a value."""
    return reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns)))


def sample_std_of(columns: list[Column], mean: Column) -> Column:
    """Row-wise sample standard deviation (n - 1); null unless every column has a value."""
    squares = [(c - mean) * (c - mean) for c in columns]
    return F.sqrt(reduce(lambda a, b: a + b, squares) / F.lit(float(len(columns) - 1)))
