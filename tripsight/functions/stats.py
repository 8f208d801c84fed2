"""Statistic helpers shared by profiles and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND_DIGITS = 6


def sample_skewness(x: Column) -> Column:
    """Bias-adjusted skewness (pandas ``.skew``): population form x sqrt(n(n-1))/(n-2)."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def pairwise_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both sides are present (pandas ``.corr``)."""
    both = a.isNotNull() & b.isNotNull()
    return F.corr(F.when(both, a), F.when(both, b))


def round6(x: Column, digits: int = ROUND_DIGITS) -> Column:
    """floor(x*10^d + 0.5) / 10^d: plain IEEE steps that any engine repeats bit for bit.

    (Built-in ``round`` implementations disagree on near-ties such as a mean of
    half-cent fares over 16 rows.) NaN and magnitudes beyond 1e12 pass through.
    """
    m = float(10 ** digits)
    return F.when(F.isnan(x) | (F.abs(x) >= 1e12), x).otherwise(
        F.floor(x * F.lit(m) + F.lit(0.5)).cast("double") / F.lit(m))


def round_floats(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every float column once, at the end of a checked query."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


MONEY_UNIT = 1000.0        # fares and distances: exact in thousandths
MINUTE_UNIT = 6.0e7        # durations in minutes: exact in microseconds


def grid_sum(x: Column, unit: float) -> Column:
    """Exact sum of values on a 1/unit grid: decimal sum of ``round(x*unit)``.

    A decimal sum is associative, so every partitioning (and every engine) gets
    the same result; a double sum depends on the order rows arrive in, and a
    long sum of microseconds overflows near 1e10 rows.
    """
    return F.sum(F.round(x * F.lit(unit)).cast("decimal(28,0)")).cast("double") / F.lit(unit)


def grid_mean(x: Column, unit: float = MONEY_UNIT) -> Column:
    """Mean of grid values from the exact sum (null on no rows)."""
    return F.try_divide(grid_sum(x, unit), F.count(x).cast("double"))


def decimal_mean(x: Column) -> Column:
    """Mean of measurements without a grid (latencies), summed exactly to nine places."""
    return F.try_divide(F.sum(x.cast("decimal(28,9)")).cast("double"), F.count(x).cast("double"))
