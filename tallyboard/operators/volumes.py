"""Activity per unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.functions.weeks import WeekWindow
from tallyboard.operators.filters import segment_filter
from tallyboard.spec import ReportSpec


def measured(spec: ReportSpec, when: Column | None = None) -> Column:
    """The report's measure over the rows where ``when`` holds: a row count, or
    the sum of a column in which missing amounts count for nothing."""
    if spec.measure is None:
        return F.count("*") if when is None else F.count_if(when)
    amount = F.col("amount") if when is None else F.when(when, F.col("amount"))
    total = F.sum(amount)
    return F.coalesce(total, F.lit(0))


def volumes(spec: ReportSpec, extract: DataFrame, window: WeekWindow) -> DataFrame:
    """``unit_code, actual_week, actual_ytd`` in one pass and one shuffle.

    The week lies inside the year to date, so one range filter serves both
    counts. Counting starts before the shuffle: each task sends one row per
    unit, whatever the weight of a unit.
    """
    return _counted_rows(spec, extract, window).groupBy("unit_code").agg(
        measured(spec, window.in_week(F.col("activity_date"))).alias("actual_week"),
        measured(spec).alias("actual_ytd"),
    )


def volume_parts(spec: ReportSpec, extract: DataFrame, window: WeekWindow) -> DataFrame:
    """What every row adds to the volume of its unit, for an aggregation that
    meets other rows of the unit."""
    if spec.measure is None:
        part = F.lit(1).cast("bigint")
    else:
        part = F.coalesce("amount", F.lit(0))
    of_week = F.when(window.in_week(F.col("activity_date")), part)
    return _counted_rows(spec, extract, window).select(
        "unit_code", of_week.alias("actual_week"), part.alias("actual_ytd")
    )


def _counted_rows(spec: ReportSpec, extract: DataFrame, window: WeekWindow) -> DataFrame:
    shown = window.in_year_to_date(F.col("activity_date")) & F.col("unit_code").isNotNull()
    return segment_filter(spec, extract).filter(shown)
