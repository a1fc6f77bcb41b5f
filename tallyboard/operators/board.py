"""From volumes and targets to the scoreboard.

Every step takes ``keys``, extra columns that tell boards apart (``report``,
``week``); without keys it builds a single board.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.functions.ratios import annual_share, attainment, gap

UNIT, TOTAL, TOTAL_EXCLUDED = "unit", "total", "total_excl"

BOARD_COLUMNS = (
    "unit_code",
    "actual_week",
    "actual_ytd",
    "target_start",
    "attainment",
    "gap",
    "target_annual",
    "annual_share",
    "row_type",
)

TOTAL_LABEL = "All units"
EXCLUDED_LABEL = "All units except "

_COUNTS = ("actual_week", "actual_ytd")
_TARGETS = ("target_start", "target_annual")


def align(activity: DataFrame, targets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every unit that has activity or a target: a full outer alignment without
    a join, by one aggregation over the rows of both.

    ``activity`` holds any number of rows per unit, parts that add up; a NULL
    ``actual_ytd`` is no activity. ``targets`` hold a unit once. Adding up
    starts before the only shuffle, so a unit with a third of all rows costs
    one row per task. Further columns of ``activity`` are added up too.
    """
    planned = targets.select(*keys, "unit_code", *_TARGETS, F.lit(True).alias("has_target"))
    further = [c for c in activity.columns if c not in (*keys, "unit_code", *_COUNTS)]
    rows = activity.unionByName(planned, allowMissingColumns=True)
    return rows.groupBy(*keys, "unit_code").agg(
        *(F.sum(c).alias(c) for c in further),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS),
        *(F.max(c).alias(c) for c in _TARGETS),
        (F.count("actual_ytd") > 0).alias("has_activity"),
        (F.count("has_target") > 0).alias("has_target"),
    )


def totals(
    aligned: DataFrame,
    excluded_unit: Column,
    keys: Sequence[str] = (),
    seed: DataFrame | None = None,
) -> DataFrame:
    """Total rows, both from one aggregate.

    A target total is NULL only when every target is. The second total exists
    only if the excluded unit has activity or a target. ``seed`` lists the keys
    that must have a total even without a single unit; a board without keys
    always has one. Boards with keys have their excluded unit in a column
    ``excluded`` of ``aligned`` and ``seed``; a single board gives it as a literal.
    """
    group = [*keys, "excluded"] if keys else []
    units = aligned.select(*keys, "unit_code", *_COUNTS, *_TARGETS, excluded_unit.alias("excluded"))
    if seed is not None:
        units = units.unionByName(seed.select(*group), allowMissingColumns=True)
    figures = (*_COUNTS, *_TARGETS)
    rest = "FILTER (WHERE unit_code <> excluded)"
    sums = units.groupBy(*group).agg(
        *(F.expr(f"sum({c}) AS all_{c}") for c in figures),
        *(F.expr(f"sum({c}) {rest} AS rest_{c}") for c in figures),
        F.expr("max(unit_code = excluded) AS found_excluded"),
    )
    sums = sums.withColumn("excluded", F.when(F.col("found_excluded"), excluded_unit))

    def row(label: str, prefix: str, whole: bool) -> Column:
        fields = [f"{label} AS unit_code", f"{whole} AS whole"]
        fields += [f"coalesce({prefix}_{c}, 0) AS {c}" for c in _COUNTS]
        fields += [f"{prefix}_{c} AS {c}" for c in _TARGETS]
        return F.expr(f"struct({', '.join(fields)})")

    # Without the excluded unit its label is NULL, and the row is dropped below.
    rows = F.array(
        row(f"'{TOTAL_LABEL}'", "all", True),
        row(f"concat('{EXCLUDED_LABEL}', excluded)", "rest", False),
    )
    # As a conditional of two constants, the row type lets the optimizer see
    # that a board reduced to its units needs no totals at all.
    row_type = F.when(F.col("whole"), TOTAL).otherwise(TOTAL_EXCLUDED)
    return (
        sums.select(*keys, F.inline(rows))
        .filter("unit_code IS NOT NULL")
        .select(*keys, "unit_code", *_COUNTS, *_TARGETS, row_type.alias("row_type"))
    )


def board(
    aligned: DataFrame,
    excluded_unit: Column,
    keys: Sequence[str] = (),
    seed: DataFrame | None = None,
) -> DataFrame:
    """Unit rows and total rows with their indicators, which are always computed
    from the figures of the row itself, never averaged."""
    units = aligned.select(
        *keys, "unit_code", *_COUNTS, *_TARGETS, F.lit(UNIT).alias("row_type")
    )
    return with_indicators(units.unionByName(totals(aligned, excluded_unit, keys, seed)), keys)


def with_indicators(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Board columns of rows that have their figures and their type."""
    return rows.withColumns(
        {"attainment": attainment(), "gap": gap(), "annual_share": annual_share()}
    ).select(*keys, *BOARD_COLUMNS)


def sort_board(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units by code, then the totals."""
    rank = F.when(F.col("row_type") == UNIT, 0).when(F.col("row_type") == TOTAL, 1).otherwise(2)
    return rows.orderBy(*keys, rank, "unit_code")


def unit_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("row_type") == UNIT)


def total_row(rows: DataFrame) -> DataFrame:
    """The overall total of each board."""
    return rows.filter(F.col("row_type") == TOTAL)


def units_without_target(aligned: DataFrame) -> DataFrame:
    return aligned.filter("has_activity AND NOT has_target").select("unit_code", "actual_ytd")


def units_without_activity(aligned: DataFrame) -> DataFrame:
    found = aligned.filter("has_target AND NOT has_activity")
    return found.select("unit_code", "target_start", "target_annual")
