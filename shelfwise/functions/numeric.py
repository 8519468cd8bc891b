"""Numeric cleaning and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLIP_BOUND = 1e6


def finite_or_null(c: Column) -> Column:
    """NaN and +/-Inf become NULL, so NULL is the only missing value downstream."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def fill_zero(c: Column) -> Column:
    return F.coalesce(finite_or_null(c), F.lit(0.0))


def clip(c: Column, lo: float = -CLIP_BOUND, hi: float = CLIP_BOUND) -> Column:
    """Fill first, then clip (``greatest`` skips NULLs, so order matters)."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def clip_prediction(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0))


def stable_round(c: Column, digits: int = 4) -> Column:
    """Tie-free rounding used for cross-engine comparisons.

    ``floor(x * 10^d + 0.501) / 10^d`` never lands on the .5 ties where engines
    disagree (decimal vs binary rounding of doubles).
    """
    scale = float(10 ** digits)
    return (F.floor(c * F.lit(scale) + F.lit(0.501)) / F.lit(scale)).cast("double")


def half_even(c: Column, digits: int = 2) -> Column:
    """Report rounding: numpy/pandas round half to even."""
    return F.bround(c, digits)
