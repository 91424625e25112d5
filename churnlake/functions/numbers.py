"""Numeric column expressions with one defined result on every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` places, ties to even on the scaled value; never returns -0.0."""
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale + F.lit(0.0)


def exact_sum(value: Column, scale: int = 4) -> Column:
    """Sum through DECIMAL, so the result does not depend on the order of the rows."""
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def exact_mean(value: Column, scale: int = 4) -> Column:
    """Mean of the non-null values through an exact sum; null when there are none."""
    return F.try_divide(exact_sum(value, scale), F.count(value))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0.0 where it is not defined."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; null when ``whole`` is 0."""
    return round_even(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), digits)


def adjusted_skewness(value: Column) -> Column:
    """Bias-adjusted skewness (Spark's own is the population form); null below three values."""
    n = F.count(value).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n > 2, factor * F.skewness(value))


def adjusted_kurtosis(value: Column) -> Column:
    """Bias-adjusted excess kurtosis (Spark's own is the population form); null below four values."""
    n = F.count(value).cast("double")
    factor = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when(n > 3, factor * ((n + 1) * F.kurtosis(value) + F.lit(6.0)))
