"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles are summed as decimals of their shortest text: order-free, and free of binary noise.
_EXACT = "decimal(38,15)"


def stable_round(value: Column, scale: int) -> Column:
    """Half-up rounding, once.

    Meant for values that do not depend on the order of a sum: counts, extremes,
    and what ``stable_sum`` and ``stable_mean`` deliver.
    """
    return F.round(value, scale)


def _total(value: Column) -> Column:
    """Sum of doubles that is the same in any order; NULL for no values.

    Every value counts as the shortest decimal that stands for it, to 15 places.  With a NaN or an infinity
    the plain sum is the answer in any order too.  The query fails on a finite value beyond 23 digits.
    """
    value = value.cast("double")
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    exact = F.when(finite, value.try_cast(_EXACT))
    failed = F.raise_error("a value with more than 23 digits can't be summed exactly").cast("double")
    return (
        F.when(F.count_if(~finite) > 0, F.sum(value))
        .when(F.count_if(finite & exact.isNull()) > 0, failed)
        .otherwise(F.sum(exact).cast("double"))
    )


def stable_sum(value: Column, scale: int) -> Column:
    """Sum of doubles whatever the order, rounded once; 0.0 for no values."""
    return F.coalesce(F.round(_total(value), scale), F.lit(0.0))


def stable_mean(value: Column, scale: int) -> Column:
    """Mean of doubles whatever the order, rounded once; NULL for no values."""
    return F.round(F.try_divide(_total(value), F.count(value)), scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` in percent of ``whole``; NULL when ``whole`` is 0 or NULL."""
    return stable_round(F.try_divide(part, whole) * 100, scale)


def banded(value: Column, bands, default: str | None = None) -> Column:
    """Name of the first ``(name, lowest)`` band that ``value`` reaches."""
    out = F
    for name, lowest in bands:
        out = out.when(value >= lowest, F.lit(name))
    return out.otherwise(F.lit(default)) if default is not None else out
