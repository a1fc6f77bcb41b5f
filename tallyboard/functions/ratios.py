"""Indicators that compare activity with targets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is NULL or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def attainment() -> Column:
    return guarded_ratio(F.col("actual_ytd"), F.col("target_start"))


def gap() -> Column:
    return F.col("actual_ytd").cast("double") - F.col("target_start")


def annual_share() -> Column:
    return guarded_ratio(F.col("actual_ytd"), F.col("target_annual"))
