"""The scoreboard of one report and one week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.functions.weeks import WeekWindow
from tallyboard.operators.board import align, board, sort_board
from tallyboard.operators.volumes import volume_parts
from tallyboard.spec import ReportSpec


def excluded_unit(spec: ReportSpec) -> Column:
    return F.lit(spec.excluded_unit).cast("string")


def aligned_units(
    spec: ReportSpec, extract: DataFrame, targets: DataFrame, week: str
) -> DataFrame:
    return align(volume_parts(spec, extract, WeekWindow(week, spec.cutoff)), targets)


def scoreboard(spec: ReportSpec, extract: DataFrame, targets: DataFrame, week: str) -> DataFrame:
    """From a clean extract and clean targets, in display order.

    Only the year to date of the wanted columns is read, and only one row per
    unit and task is shuffled.
    """
    aligned = aligned_units(spec, extract, targets, week)
    return sort_board(board(aligned, excluded_unit(spec)))
