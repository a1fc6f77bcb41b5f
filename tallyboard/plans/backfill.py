"""Every past week of all reports in one job.

Replaying weeks one by one would read an extract once per week and report. Here
it is read once: rows are counted per unit and week of entry, and a running sum
over at most 54 weekly rows per line and year turns that into the year to date.
A line is a unit of a report or one of its totals: a total adds up the entries
of its units, not their weeks, so it is a line like any other when the running
sums are taken and the weeks are spelled out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyboard.functions.weeks import WeekWindow, monday_of, week_id, week_span
from tallyboard.operators.board import (
    BOARD_COLUMNS,
    EXCLUDED_LABEL,
    TOTAL,
    TOTAL_EXCLUDED,
    TOTAL_LABEL,
    UNIT,
    with_indicators,
)
from tallyboard.operators.filters import wanted_by_any, wanted_values
from tallyboard.operators.routing import by_report, name_list, report_facts
from tallyboard.operators.tally import cutoffs, value_keys
from tallyboard.operators.volumes import measured
from tallyboard.plans.many import RawInputs, shared_extracts, targets_by_report, union_all
from tallyboard.sources.datasets import literal_rows
from tallyboard.spec import ReportSpec

KEYS = ("report", "monday")
# Reports, their extract, the first day that counts and the day after the last.
EntriesFrom = Callable[[list[ReportSpec], DataFrame, dt.date, dt.date], list[DataFrame]]
_TARGETS = ("target_start", "target_annual")


def _mondays(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 7 days"))


def _first_monday(year: int) -> dt.date:
    january = dt.date(year, 1, 1)
    return january + dt.timedelta(days=-january.weekday() % 7)


def activity_entries(
    specs: Sequence[ReportSpec], extract: DataFrame, first: dt.date, end: dt.date, kept: bool = False
) -> DataFrame:
    """``report, unit_code, year, monday, of_week, measured, row_count``: what
    each week adds to the cumulation of ``year``, the civil year of its Monday.

    A row enters the cumulation in the week of its day, or a week later if it
    falls past a midnight cut-off on Sunday. It is counted for that week only in
    the first case. Days of January before the year's first Monday count twice:
    in the straddling week, for the old year, and from the first Monday on, for
    the new one.

    ``kept`` tells that the extract is already added up by day (`daily_totals`).
    """
    spec = specs[0]
    day = F.col("activity_date")
    monday = monday_of(day)
    late = F.lit(False)
    if spec.cutoff == "midnight":
        late = day > F.date_add(monday, 6).cast("timestamp_ntz")
        if kept:
            late = (day == F.date_add(monday, 6)) & F.col("after_midnight")
    entry = F.when(late, F.date_add(monday, 7)).otherwise(monday)

    # Nothing before 1 January of the first week's year can matter.
    reach = (day >= F.lit(first.replace(month=1, day=1))) & (day < F.lit(end))
    wanted = wanted_by_any(specs, extract).filter(reach & F.col("unit_code").isNotNull())
    # Reports that keep the same rows, above all a single one, need no keys to
    # tell their rows apart.
    alike = all(wanted_values(s) == wanted_values(spec) for s in specs)
    weekly = wanted.groupBy(
        "unit_code",
        entry.alias("monday"),
        late.alias("late"),
        F.year(day).alias("day_year"),
        *([] if alike else value_keys(specs)),
    ).agg(
        (F.sum("measured") if kept else measured(spec)).alias("measured"),
        (F.sum("row_count") if kept else F.count("*")).alias("row_count"),
    )

    week_year = F.year("monday")
    own = F.when(~F.col("late"), F.col("measured"))
    none = F.when(F.lit(False), F.col("measured"))

    def contribution(year: Column, start: Column, of_week: Column) -> Column:
        return F.struct(
            year.alias("year"),
            start.alias("monday"),
            of_week.alias("of_week"),
            F.col("measured"),
            F.col("row_count"),
        )

    into_week = contribution(week_year, F.col("monday"), own)
    into_new_year = contribution(F.col("day_year"), F.date_add("monday", 7), none)
    # A late row of 31 December enters no week at all: its own week is closed
    # for it, and the next one cumulates on the new year.
    contributions = F.array_compact(
        F.array(
            F.when(week_year <= F.col("day_year"), into_week),
            F.when(week_year < F.col("day_year"), into_new_year),
        )
    )
    if alike:
        rows = weekly.select("*", F.explode(name_list([s.name for s in specs])).alias("report"))
    else:
        rows = by_report(specs, weekly)
    return rows.select("report", "unit_code", F.inline(contributions))


def entries_of(
    specs: Sequence[ReportSpec], extract: DataFrame, first: dt.date, end: dt.date, kept: bool = False
) -> list[DataFrame]:
    """Entries of reports that share an extract, by what their last day means."""
    return [
        activity_entries([s for s in specs if s.cutoff == cutoff], extract, first, end, kept)
        for cutoff in cutoffs(specs)
    ]


def target_entries(targets: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Targets as entries without activity in the first week of every year, so
    that a unit with a target has a line in every week."""
    years = range(first.year, last.year + 1)
    starts = F.array(
        *(
            F.struct(F.lit(y).alias("year"), F.lit(_first_monday(y)).alias("monday"))
            for y in years
        )
    )
    return targets.select(
        "report", "unit_code", *_TARGETS, F.lit(True).alias("has_target"), F.inline(starts)
    )


def board_lines(
    specs: Sequence[ReportSpec], entries: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Entries of every line of the boards: units as they are, totals summed by
    week of entry. ``presence`` is positive where an entry lets its line show;
    the total without a unit shows because of that unit alone.

    Totals start before the shuffle, as partial sums of at most 54 rows per
    report and year; an entry of every year's first week keeps the overall total
    of a report without a single unit.
    """
    spark = entries.sparkSession
    figures = ("of_week", "measured", *_TARGETS)
    units = entries.select(
        "report",
        F.lit(UNIT).alias("row_type"),
        "unit_code",
        "year",
        "monday",
        *figures,
        F.col("row_count").alias("presence"),
        "has_target",
    )
    every = entries.join(report_facts(spark, specs).select("report", "excluded"), "report")
    own = F.col("unit_code") == F.col("excluded")

    def line(kind: str, label: Column, counted: Column | None, shows: Column | None) -> Column:
        def part(name: str, when: Column | None) -> Column:
            return (F.col(name) if when is None else F.when(when, F.col(name))).alias(name)

        return F.struct(
            F.lit(kind).alias("row_type"),
            label.alias("label"),
            *(part(name, counted) for name in figures),
            part("row_count", shows),
            part("has_target", shows),
        )

    both = F.array(
        line(TOTAL, F.lit(TOTAL_LABEL), None, None),
        line(TOTAL_EXCLUDED, F.concat(F.lit(EXCLUDED_LABEL), F.col("excluded")), ~own, own),
    )
    totals = (
        every.select("report", "year", "monday", F.inline(both))
        .filter("label IS NOT NULL")
        .groupBy("report", "row_type", F.col("label").alias("unit_code"), "year", "monday")
        .agg(
            *(F.sum(name).alias(name) for name in figures),
            F.sum("row_count").alias("presence"),
            F.max("has_target").alias("has_target"),
        )
    )
    starts = [
        (s.name, TOTAL, TOTAL_LABEL, year, _first_monday(year))
        for s in specs
        for year in range(first.year, last.year + 1)
    ]
    columns = "report string, row_type string, unit_code string, year int, monday date"
    return (
        units.unionByName(totals)
        .unionByName(literal_rows(spark, columns, starts), allowMissingColumns=True)
    )


def weekly_lines(
    groups: Sequence[tuple[Sequence[ReportSpec], DataFrame]],
    targets: DataFrame,
    first: str,
    last: str,
    entries_from: EntriesFrom = entries_of,
) -> DataFrame:
    """Every line of every board with its figures, week by week. A group is the
    reports that share an extract; ``targets`` hold a unit once per ``report``.

    Activity and targets meet in the aggregation by line, year and week. One
    shuffle by line and year serves it and the running sums; weeks are spelled
    out only afterwards.
    """
    start, end = week_span(first, last)
    past = WeekWindow(last).sunday + dt.timedelta(days=1)
    entries = union_all(
        [e for members, extract in groups for e in entries_from(members, extract, start, past)]
    ).unionByName(target_entries(targets, start, end), allowMissingColumns=True)
    specs = [s for members, _ in groups for s in members]
    line = ("report", "row_type", "unit_code", "year")
    steps = (
        board_lines(specs, entries, start, end)
        .repartition(*line)
        .groupBy(*line, "monday")
        .agg(
            *(F.sum(c).alias(c) for c in ("of_week", "measured", "presence")),
            *(F.max(c).alias(c) for c in (*_TARGETS, "has_target")),
        )
    )
    in_order = Window.partitionBy(*line).orderBy("monday")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    december = F.trunc(F.make_date("year", F.lit(12), F.lit(31)), "week")
    until = F.coalesce(
        F.date_sub(F.lead("monday").over(in_order), 7), F.least(december, F.lit(end))
    )
    running = steps.select(
        "report",
        "row_type",
        "unit_code",
        F.col("monday").alias("since"),
        until.alias("until"),
        F.coalesce("of_week", F.lit(0)).alias("of_week"),
        F.coalesce(F.sum("measured").over(so_far), F.lit(0)).alias("actual_ytd"),
        F.sum("presence").over(so_far).alias("presence"),
        *(F.max(c).over(so_far).alias(c) for c in (*_TARGETS, "has_target")),
    )
    shown = (F.col("row_type") == TOTAL) | (F.col("presence") > 0) | F.col("has_target")
    # Weeks without activity carry the running total forward.
    held = _mondays(F.greatest("since", F.lit(start)), F.col("until"))
    reached = (F.col("since") <= F.col("until")) & (F.col("until") >= F.lit(start))
    weeks = running.filter(reached & shown).select("*", F.explode(held).alias("monday"))
    own_week = F.col("monday") == F.col("since")
    return weeks.select(
        *KEYS,
        "unit_code",
        F.when(own_week, F.col("of_week")).otherwise(F.lit(0)).alias("actual_week"),
        "actual_ytd",
        *_TARGETS,
        "row_type",
    )


def boards_of_entries(
    groups: Sequence[tuple[Sequence[ReportSpec], DataFrame]],
    targets: DataFrame,
    first: str,
    last: str,
    entries_from: EntriesFrom = entries_of,
) -> DataFrame:
    """Board rows of every week and report, in no particular order."""
    rows = with_indicators(weekly_lines(groups, targets, first, last, entries_from), KEYS)
    return rows.select("report", week_id(F.col("monday")).alias("week"), *BOARD_COLUMNS)


def backfill(
    spec: ReportSpec, extract: DataFrame, targets: DataFrame, first: str, last: str
) -> DataFrame:
    """The scoreboard of every week from ``first`` to ``last``, with a ``week``
    column: for each week exactly the rows of a run of that week, in no
    particular order."""
    planned = targets.withColumn("report", F.lit(spec.name))
    return boards_of_entries([([spec], extract)], planned, first, last).drop("report")


def backfill_reports(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs], first: str, last: str
) -> DataFrame:
    """Every week of every report, ready for the weekly sink. Reports that share
    an extract share its scan; all share one pass over their lines."""
    return boards_of_entries(
        shared_extracts(specs, inputs), targets_by_report(specs, inputs), first, last
    )
