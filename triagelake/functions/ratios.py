"""Ratio expressions shared by all metric tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SMOOTHING = 1e-8


def ratio(top: Column, bottom: Column) -> Column:
    """Division where a zero denominator gives 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def smoothed(top: Column, bottom: Column) -> Column:
    """Division with a small constant in the denominator, as the threshold search uses it."""
    return top.cast("double") / (bottom.cast("double") + F.lit(SMOOTHING))
