"""One pass over an extract that serves every figure of every report.

A *tally* keeps one row per unit and combination of requested segments and
filter values, with all counters a week needs, once for each meaning of its last
day. It is the only step that touches the full extract; boards, warnings and run
metrics of all reports that share the extract are derived from it. Counting
starts before the shuffle, so a unit or segment that holds a third of the rows
costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.functions.weeks import CUTOFFS, WeekWindow
from tallyboard.operators.filters import wanted_by_any
from tallyboard.operators.routing import known_value, report_facts, requested_values, with_keepers
from tallyboard.operators.volumes import measured
from tallyboard.spec import ReportSpec

# Counters that depend on what the last day of the week means.
CLOSED = ("rows_later", "rows_ytd", "actual_week", "actual_ytd")


def filter_headers(specs: Iterable[ReportSpec]) -> list[str]:
    return sorted({name for spec in specs for name in spec.filters})


def cutoffs(specs: Iterable[ReportSpec]) -> list[str]:
    """The meanings of the last day that the reports declare."""
    declared = {spec.cutoff for spec in specs}
    return [cutoff for cutoff in CUTOFFS if cutoff in declared]


def value_keys(specs: Iterable[ReportSpec]) -> list[Column]:
    """Grouping columns that tell apart what some report keeps.

    Values nobody asks for fall together, so the number of groups follows the
    declared lists and not what the columns happen to hold.
    """
    return [known_value(column, values).alias(column) for column, values in requested_values(specs).items()]


def tally(
    specs: Sequence[ReportSpec], extract: DataFrame, week: str, boards_only: bool = False
) -> DataFrame:
    """``specs`` share this clean extract (equal ``extract_key``).

    ``boards_only`` counts just the rows that boards show, whose period and
    values can be pushed into the scan; warnings and run metrics need all rows.
    """
    spec = specs[0]
    windows = {cutoff: WeekWindow(week, cutoff) for cutoff in cutoffs(specs)}
    day = F.col("activity_date")
    if boards_only:
        longest = next(iter(windows.values()))  # the whole day ends last
        shown = longest.in_year_to_date(day) & F.col("unit_code").isNotNull()
        extract = wanted_by_any(specs, extract).filter(shown)
    closed = [
        counter.alias(f"{name}_{cutoff}")
        for cutoff, window in windows.items()
        for name, counter in zip(
            CLOSED,
            (
                F.count_if(window.after(day)),
                F.count_if(window.in_year_to_date(day)),
                measured(spec, window.in_week(day)),
                measured(spec, window.in_year_to_date(day)),
            ),
        )
    ]
    unread = F.col("amount_unreadable") if spec.measure else F.lit(False)
    return extract.groupBy("unit_code", *value_keys(specs)).agg(
        F.count("*").alias("rows_read"),
        F.count_if(day.isNotNull() | F.col("date_unreadable")).alias("dates_given"),
        F.count_if("date_unreadable").alias("dates_unreadable"),
        F.count_if(unread).alias("amounts_unreadable"),
        *closed,
    )


def routed(specs: Sequence[ReportSpec], counted: DataFrame, whole: bool = True) -> DataFrame:
    """Every tally row once per report that keeps it, with the ``cutoff`` and the
    ``excluded`` unit of the report and the counters of that cut-off under plain
    names; and, with ``whole``, once without a report, for what holds for the
    extract as a whole."""
    names = F.col("keepers")
    if whole:
        names = F.concat(names, F.array(F.lit(None).cast("string")))
    rows = with_keepers(specs, counted).withColumn("report", F.explode(names)).drop("keepers")
    facts = report_facts(counted.sparkSession, specs)
    rows = rows.join(facts, "report", "left" if whole else "inner")

    def closing(name: str) -> Column:
        choices = [F.when(F.col("cutoff") == c, F.col(f"{name}_{c}")) for c in cutoffs(specs)]
        return F.coalesce(*choices)

    helpers = [f"{name}_{c}" for name in CLOSED for c in cutoffs(specs)]
    return rows.withColumns({name: closing(name) for name in CLOSED}).drop(*helpers)


def activity_lines(
    specs: Sequence[ReportSpec], counted: DataFrame, counters: bool = True
) -> DataFrame:
    """Parts of the figures of every report and unit, from a tally: only what
    the report keeps.

    Counters of the whole extract (``rows_read``, unreadable values) stand on
    the NULL unit of the first report and hold for all of ``specs``;
    ``run_metrics`` gives them to each. Boards alone need no ``counters``. Rows
    without activity in the year to date, or without a unit, have NULL
    ``actual_*``, which keeps them out of every board.
    """
    rows = routed(specs, counted, counters)
    kept = F.col("report").isNotNull()
    on_board = F.col("unit_code").isNotNull() & (F.col("rows_ytd") > 0)

    def once(counter: str) -> Column:
        return F.when(~kept, F.col(counter)).alias(counter)

    return rows.select(
        F.coalesce("report", F.lit(specs[0].name)).alias("report"),
        F.when(kept, F.col("unit_code")).alias("unit_code"),
        once("rows_read"),
        once("dates_unreadable"),
        once("amounts_unreadable"),
        F.when(kept, F.col("rows_read")).alias("rows_kept"),
        F.col("rows_later"),
        F.when(on_board, F.col("actual_week")).alias("actual_week"),
        F.when(on_board, F.col("actual_ytd")).alias("actual_ytd"),
    )


def on_board(ledger: DataFrame) -> DataFrame:
    """The units a board shows: with activity in the year to date or a target."""
    return ledger.filter("has_activity OR has_target")
