"""All reports of one week in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyboard.errors import SpecError
from tallyboard.operators.board import align, board, sort_board
from tallyboard.operators.quality import evidence, run_metrics, warnings
from tallyboard.operators.routing import name_list, report_facts
from tallyboard.operators.tally import activity_lines, filter_headers, on_board, tally
from tallyboard.sources.datasets import literal_rows
from tallyboard.sources.extract import clean_extract
from tallyboard.sources.targets import clean_targets
from tallyboard.spec import ReportSpec

KEYS = ("report",)


@dataclass(frozen=True)
class RawInputs:
    """The datasets of one report, as delivered."""

    extract: DataFrame
    targets: DataFrame


@dataclass(frozen=True)
class ExtractGroup:
    """Reports that share an extract, with the tally that serves them all."""

    specs: tuple[ReportSpec, ...]
    counted: DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def shared_extracts(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs]
) -> list[tuple[list[ReportSpec], DataFrame]]:
    """The distinct clean extracts, each with the reports that read it: equal
    declarations share one only where the delivered data is the same."""
    refuse_repeated(specs)
    groups: list[list[ReportSpec]] = []
    for spec in specs:
        for members in groups:
            if members[0].extract_key == spec.extract_key and same_data(
                inputs[members[0].name].extract, inputs[spec.name].extract
            ):
                members.append(spec)
                break
        else:
            groups.append([spec])
    return [
        (members, clean_extract(members[0], inputs[members[0].name].extract, filter_headers(members)))
        for members in groups
    ]


def same_data(one: DataFrame, other: DataFrame) -> bool:
    return one is other or one.sameSemantics(other)


def refuse_repeated(specs: Sequence[ReportSpec]) -> None:
    """A report given twice would count twice."""
    names = [spec.name for spec in specs]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise SpecError(f"reports given more than once: {twice}")


def tally_groups(
    specs: Sequence[ReportSpec],
    inputs: Mapping[str, RawInputs],
    week: str,
    boards_only: bool = False,
) -> list[ExtractGroup]:
    """One tally, hence one scan, per distinct extract."""
    return [
        ExtractGroup(tuple(members), tally(members, extract, week, boards_only))
        for members, extract in shared_extracts(specs, inputs)
    ]


def targets_by_report(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs]
) -> DataFrame:
    """Clean targets with a ``report`` column. Targets that several reports read
    the same way are read and cleaned once."""
    shared: list[list[ReportSpec]] = []
    for spec in specs:
        for members in shared:
            if members[0].target_key == spec.target_key and same_data(
                inputs[members[0].name].targets, inputs[spec.name].targets
            ):
                members.append(spec)
                break
        else:
            shared.append([spec])
    return union_all(
        [
            clean_targets(members[0], inputs[members[0].name].targets).withColumn(
                "report", F.explode(name_list([s.name for s in members]))
            )
            for members in shared
        ]
    )


def report_list(spark: SparkSession, specs: Sequence[ReportSpec]) -> DataFrame:
    return literal_rows(spark, "report string", [(s.name,) for s in specs])


def listing(spark: SparkSession, specs: Sequence[ReportSpec]) -> DataFrame:
    """The declared reports: what they read and which segments they keep."""

    def origin(feed):
        return feed.pattern or f"{feed.database}.{feed.dataset}"

    rows = [
        (s.name, s.label, origin(s.source), origin(s.targets), ", ".join(s.segments) or "all")
        for s in specs
    ]
    columns = "report string, label string, source string, targets string, segments string"
    return literal_rows(spark, columns, rows)


def ledger(
    groups: Sequence[ExtractGroup], targets: DataFrame, counters: bool = True
) -> DataFrame:
    """Activity and targets by report and unit, with the run counters."""
    activity = union_all([activity_lines(g.specs, g.counted, counters) for g in groups])
    return align(activity, targets, KEYS)


def boards(specs: Sequence[ReportSpec], entries: DataFrame) -> DataFrame:
    """Unsorted scoreboard rows of every report, from the ledger."""
    facts = report_facts(entries.sparkSession, specs).select("report", "excluded")
    shown = on_board(entries).join(facts, "report")
    return board(shown, F.col("excluded"), KEYS, facts)


def scoreboards(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs], week: str
) -> DataFrame:
    groups = tally_groups(specs, inputs, week, boards_only=True)
    entries = ledger(groups, targets_by_report(specs, inputs), counters=False)
    return sort_board(boards(specs, entries), KEYS)


def report_warnings(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs], week: str
) -> DataFrame:
    return group_warnings(
        tally_groups(specs, inputs, week), targets_by_report(specs, inputs), week
    )


def group_warnings(groups: Sequence[ExtractGroup], targets: DataFrame, week: str) -> DataFrame:
    specs = [s for g in groups for s in g.specs]
    gathered = union_all([evidence(g.specs, g.counted, week) for g in groups])
    return warnings(specs, gathered, targets, week)


def report_metrics(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs], week: str
) -> DataFrame:
    groups = tally_groups(specs, inputs, week)
    return group_metrics(specs, groups, ledger(groups, targets_by_report(specs, inputs)), week)


def group_metrics(
    specs: Sequence[ReportSpec], groups: Sequence[ExtractGroup], entries: DataFrame, week: str
) -> DataFrame:
    sharing = [[s.name for s in g.specs] for g in groups]
    return run_metrics(entries, report_list(entries.sparkSession, specs), week, sharing)
