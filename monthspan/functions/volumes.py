"""Guarded arithmetic: no division error, no NaN, no value invented from null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; null when the denominator is zero or null, or when both are infinite."""
    return not_nan(F.try_divide(numerator, denominator))


def clip(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]. ``greatest`` and ``least`` skip nulls, so null needs its own guard."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def share(value: Column) -> Column:
    """A share keeps both of its ends, 0 and 1; anything outside is null."""
    return F.when(value.between(0.0, 1.0), value)
