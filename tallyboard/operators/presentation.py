"""Scoreboards as readers see them: published blocks, formatted rows, cards."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.errors import PublishError
from tallyboard.functions.display import (
    gap_arrow,
    gap_class,
    gap_text,
    integer_text,
    percent_text,
)
from tallyboard.operators.board import TOTAL, TOTAL_EXCLUDED, UNIT
from tallyboard.operators.ranking import with_rank
from tallyboard.sinks.scratch import written
from tallyboard.spec import ReportSpec

# Headers of the published scoreboard, by board column.
SCOREBOARD_HEADERS = {
    "unit_code": "Unit",
    "actual_week": "Actual week",
    "actual_ytd": "Actual year to date",
    "target_start": "Start-of-year target",
    "attainment": "Attainment",
    "gap": "Gap",
    "target_annual": "Annual target",
    "annual_share": "Share of annual target",
}
TARGET_HEADERS = {
    name: SCOREBOARD_HEADERS[name] for name in ("unit_code", "target_start", "target_annual")
}


def _renamed(data: DataFrame, headers: dict[str, str]) -> DataFrame:
    return data.select(*(F.col(name).alias(shown) for name, shown in headers.items()))


def block(name: str, detail: DataFrame, targets: DataFrame, rows: DataFrame) -> DataFrame:
    """One of the three blocks a report can publish."""
    if name == "detail":
        return detail
    if name == "targets":
        return _renamed(targets, TARGET_HEADERS)
    if name == "scoreboard":
        return _renamed(rows, SCOREBOARD_HEADERS)
    raise PublishError(f"unknown block {name!r}")


def display_rows(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every scoreboard row as text."""
    return rows.select(
        *keys,
        "unit_code",
        *(
            integer_text(F.col(name)).alias(name)
            for name in ("actual_week", "actual_ytd", "target_start")
        ),
        percent_text(F.col("attainment")).alias("attainment"),
        gap_text(F.col("gap")).alias("gap"),
        gap_class(F.col("gap")).alias("gap_class"),
        gap_arrow(F.col("gap")).alias("gap_arrow"),
        integer_text(F.col("target_annual")).alias("target_annual"),
        percent_text(F.col("annual_share")).alias("annual_share"),
        (F.col("row_type") != UNIT).alias("is_total"),
    )


def kpi_cards(spec: ReportSpec, rows: DataFrame) -> DataFrame:
    """``position, label, value, detail, tone``: three cards from the overall
    total and, if it exists, one from the total without the excluded unit."""
    total, excluded = F.col("row_type") == TOTAL, F.col("row_type") == TOTAL_EXCLUDED
    difference = F.col("gap")

    def card(only: Column, position: int, label: Column, value: Column, detail: Column, tone: Column):
        return F.when(
            only,
            F.struct(
                F.lit(position).alias("position"),
                label.alias("label"),
                value.alias("value"),
                detail.alias("detail"),
                tone.alias("tone"),
            ),
        )

    week, ytd = integer_text(F.col("actual_week")), integer_text(F.col("actual_ytd"))
    start, annual = integer_text(F.col("target_start")), integer_text(F.col("target_annual"))
    reached, plain = percent_text(F.col("attainment")), F.lit("neutral")
    against = F.concat(gap_arrow(difference), F.lit(" "), gap_text(difference))
    cards = F.array(
        card(
            total,
            1,
            F.lit(f"Actual year to date ({spec.measure_label})"),
            ytd,
            F.concat(week, F.lit(" this week")),
            plain,
        ),
        card(
            total,
            2,
            F.lit("Overall attainment"),
            reached,
            F.concat(against, F.lit(" vs target")),
            gap_class(difference),
        ),
        card(
            total,
            3,
            F.lit("Start-of-year target"),
            start,
            F.concat(F.lit("annual target "), annual),
            plain,
        ),
        card(
            excluded,
            4,
            F.col("unit_code"),
            reached,
            F.concat(ytd, F.lit(" year to date")),
            gap_class(difference),
        ),
    )
    return (
        rows.filter(total | excluded)
        .select(F.inline(F.array_compact(cards)))
        .orderBy("position")
    )


def chart_series(
    rows: DataFrame,
    keys: Sequence[str] = (),
    keep: Callable[[DataFrame, str], DataFrame] = written,
) -> DataFrame:
    """Unit bars with their ``rank``: best attainment first, equal ones by code.
    ``keep`` writes the bars once, as ranks look at them several times; the rank
    outlives the order of rows."""
    found = rows.filter((F.col("row_type") == UNIT) & F.col("attainment").isNotNull())
    bars = keep(found.select(*keys, "unit_code", "attainment"), "bars")
    ranked = with_rank(bars, "attainment", "unit_code", keys)
    label = percent_text(F.col("attainment"), 0).alias("bar_label")
    return ranked.select(*keys, "unit_code", "attainment", label, "rank").orderBy(*keys, "rank")
