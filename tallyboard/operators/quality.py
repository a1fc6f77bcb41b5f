"""What a reader should know about a run: warnings, run metrics, segments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.functions.ratios import attainment
from tallyboard.functions.weeks import WeekWindow
from tallyboard.operators.filters import wanted_values
from tallyboard.operators.routing import report_facts, requested_values
from tallyboard.operators.tally import routed
from tallyboard.sources.datasets import header, literal_rows
from tallyboard.spec import ReportSpec

UNKNOWN_SEGMENT = "unknown_segment"
UNKNOWN_VALUE = "unknown_filter_value"
NOTHING_KEPT = "nothing_kept"
LATER_ROWS = "later_rows"
NO_TARGET = "unit_without_target"
NO_EXCLUDED = "excluded_unit_missing"
UNREADABLE_AMOUNTS = "unreadable_amounts"

_FINDING = "report string, code string, subject string, n bigint, targeted boolean"


def _finding(code: str, subject: Column, n: Column, targeted: bool = False) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        subject.cast("string").alias("subject"),
        n.cast("bigint").alias("n"),
        F.lit(targeted).alias("targeted"),
    )


def _value_code(column: str) -> str:
    return UNKNOWN_SEGMENT if column == "segment" else UNKNOWN_VALUE


def _value_prefix(column: str) -> str:
    return "" if column == "segment" else f"{column.removeprefix('filter_on_')}="


def _requests(specs: Sequence[ReportSpec]) -> list[tuple[str, str, str]]:
    """``report, code, subject`` of every value that a report asks for."""
    return [
        (spec.name, _value_code(column), _value_prefix(column) + value)
        for spec in specs
        for column, values in wanted_values(spec).items()
        for value in values
    ]


def _expected(specs: Sequence[ReportSpec]) -> list[tuple]:
    """Findings that reports must look for even when no row mentions them."""
    nothing = [(spec.name, NOTHING_KEPT, "") for spec in specs]
    excluded = [(s.name, NO_EXCLUDED, s.excluded_unit) for s in specs if s.excluded_unit]
    return [(*row, 0, False) for row in (*nothing, *_requests(specs), *excluded)]


def evidence(specs: Sequence[ReportSpec], counted: DataFrame, week: str) -> DataFrame:
    """``report, code, subject, n, targeted`` from the tally that ``specs``
    share, for and against every finding, in one pass over it."""
    unit, amounts = F.col("unit_code"), specs[0].measure
    sunday = F.lit(WeekWindow(week).sunday.isoformat())
    of_reports = [
        _finding(NOTHING_KEPT, F.lit(""), F.col("rows_read")),
        _finding(LATER_ROWS, sunday, F.col("rows_later")),
        _finding(NO_TARGET, unit, F.col("rows_ytd")),
        _finding(NO_EXCLUDED, F.col("excluded"), F.when(unit == F.col("excluded"), F.col("rows_ytd"))),
        _finding(UNREADABLE_AMOUNTS, F.lit(amounts), F.col("amounts_unreadable")),
    ]
    # Values are sought in the whole extract and stand for every report that
    # asks for them, which a small relation tells.
    of_values = [
        _finding(_value_code(c), F.concat(F.lit(_value_prefix(c)), header(c)), F.col("rows_read"))
        for c in requested_values(specs)
    ]
    found = F.when(F.col("report").isNotNull(), F.array(*of_reports))
    if of_values:
        found = found.otherwise(F.array(*of_values))
    rows = routed(specs, counted, bool(of_values)).select("report", F.inline(found))
    rows = rows.filter("n > 0 AND subject IS NOT NULL")
    if not of_values:
        return rows
    askers: dict[tuple[str, str], list[str]] = {}
    for report, code, subject in _requests(specs):
        askers.setdefault((code, subject), []).append(report)
    known = literal_rows(
        counted.sparkSession,
        "code string, subject string, askers array<string>",
        [(*request, names) for request, names in askers.items()],
    )
    rows = rows.join(known, ["code", "subject"], "left")
    readers = F.when(F.col("report").isNull(), F.col("askers")).otherwise(F.array("report"))
    return rows.select(F.explode(readers).alias("report"), "code", "subject", "n", "targeted")


def target_evidence(specs: Sequence[ReportSpec], targets: DataFrame) -> DataFrame:
    """What targets (with a ``report`` column) say about findings."""
    unit = F.col("unit_code")
    planned = F.when(unit == F.col("excluded"), unit)
    both = F.array(_finding(NO_TARGET, unit, F.lit(0), True), _finding(NO_EXCLUDED, planned, F.lit(0), True))
    facts = report_facts(targets.sparkSession, specs)
    rows = targets.join(facts, "report").select("report", F.inline(both))
    return rows.filter("subject IS NOT NULL")


def warnings(specs: Sequence[ReportSpec], gathered: DataFrame, targets: DataFrame, week: str) -> DataFrame:
    """``report, week, code, subject, n``: one row per finding.

    ``gathered`` is the evidence of all extracts, ``targets`` the clean targets
    with a ``report`` column. Everything meets in a single aggregation.
    """
    seed = literal_rows(gathered.sparkSession, _FINDING, _expected(specs))
    rows = seed.unionByName(gathered).unionByName(target_evidence(specs, targets))
    found = rows.groupBy("report", "code", "subject").agg(
        F.sum("n").alias("n"), F.max("targeted").alias("targeted")
    )
    absent = F.col("code").isin(UNKNOWN_SEGMENT, UNKNOWN_VALUE, NOTHING_KEPT, NO_EXCLUDED)
    holds = F.when(absent, F.col("n") == 0).otherwise(F.col("n") > 0) & ~F.col("targeted")
    return found.filter(holds).select("report", F.lit(week).alias("week"), "code", "subject", "n")


def run_metrics(
    ledger: DataFrame, seed: DataFrame, week: str, sharing: Iterable[Sequence[str]]
) -> DataFrame:
    """One row per report. ``ledger`` is the aligned activity by report, with
    its run counters; ``seed`` lists the reports; ``sharing`` names the reports
    of each extract, whose counters stand on the first of them."""
    readers = literal_rows(
        ledger.sparkSession,
        "host string, reader string",
        [(names[0], name) for names in sharing for name in names],
    )
    whole = ("rows_read", "dates_unreadable", "amounts_unreadable")
    figures = [c for c in ledger.columns if c not in ("report", *whole)]
    shared = (F.col("report") == F.col("host")) & F.col("rows_read").isNotNull()
    ledger = ledger.join(readers, shared, "left")
    reader = F.coalesce("reader", "report")
    own = reader == F.col("report")
    ledger = ledger.select(reader.alias("report"), *whole, *(F.when(own, F.col(c)).alias(c) for c in figures))
    shown = F.col("has_activity") | F.col("has_target")
    rows = ledger.unionByName(seed.select("report"), allowMissingColumns=True)
    counters = ("rows_read", "rows_kept", "rows_later", "dates_unreadable", "amounts_unreadable")
    summary = rows.groupBy("report").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters),
        F.count_if(shown).alias("unit_count"),
        F.coalesce(F.sum(F.when(shown, F.col("actual_ytd"))), F.lit(0)).alias("actual_ytd"),
        F.sum(F.when(shown, F.col("target_start"))).alias("target_start"),
    )
    return summary.select(
        "report",
        F.lit(week).alias("week"),
        *counters,
        "unit_count",
        "actual_ytd",
        "target_start",
        attainment().alias("attainment"),
    )


def segment_check(spec: ReportSpec, extract: DataFrame) -> DataFrame:
    """Distinct segments of the unfiltered extract next to the requested ones.

    ``status`` is ``kept`` (requested and present), ``ignored`` (present only)
    or ``unknown`` (requested only).
    """
    requested = literal_rows(
        extract.sparkSession,
        "segment string, requested boolean",
        [(value, True) for value in spec.segments],
    )
    present = extract.filter("segment IS NOT NULL").select(
        "segment", F.lit(False).alias("requested")
    )
    # Distinct before the union: the extract then sends one row per value and task.
    values = present.distinct().withColumn("present", F.lit(True))
    values = values.unionByName(requested.withColumn("present", F.lit(False)))
    merged = values.groupBy("segment").agg(
        F.max("requested").alias("requested"), F.max("present").alias("present")
    )
    status = (
        F.when(~F.col("present"), "unknown").when(F.col("requested"), "kept").otherwise("ignored")
    )
    return merged.select("segment", status.alias("status"))
