"""A scheduled run: check everything, read each extract once, write the week."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyboard.functions.weeks import WeekWindow, current_week
from tallyboard.operators.board import sort_board
from tallyboard.operators.filters import wanted_by_any
from tallyboard.operators.presentation import block, chart_series, display_rows, kpi_cards
from tallyboard.operators.quality import UNKNOWN_SEGMENT, segment_check
from tallyboard.operators.routing import by_report, name_list, report_facts
from tallyboard.operators.tally import cutoffs, filter_headers, routed
from tallyboard.plans.many import (
    KEYS,
    ExtractGroup,
    RawInputs,
    boards,
    group_metrics,
    group_warnings,
    ledger,
    tally_groups,
    targets_by_report,
    union_all,
)
from tallyboard.sinks.publish import PublishOutcome, check_destination, plan, publish
from tallyboard.sinks.scratch import Scratch
from tallyboard.sinks.weekly import KEYS as PARTITIONS
from tallyboard.sinks.weekly import (
    partition_path,
    read_partitions,
    write_findings,
    write_partitions,
    write_report,
)
from tallyboard.sources.datasets import literal_rows, open_feed
from tallyboard.sources.extract import (
    ROLE_COLUMNS,
    clean_extract,
    refuse_unreadable_dates,
    rejected_values,
    segments_of,
)
from tallyboard.sources.landing import literal_path
from tallyboard.sources.targets import clean_targets, duplicate_targets, refuse_duplicates
from tallyboard.spec import ReportBook, ReportSpec


@dataclass(frozen=True)
class RunOutcome:
    """What a run wrote. The three results are small tables read back lazily."""

    week: str
    reports: tuple[str, ...]
    scoreboard: DataFrame
    warnings: DataFrame
    metrics: DataFrame
    published: PublishOutcome | None


def open_inputs(
    spark: SparkSession, specs: Sequence[ReportSpec], landing: str | None
) -> dict[str, RawInputs]:
    """The datasets of every report; each feed is resolved once per run."""
    opened: dict = {}

    def resolve(feed, what: str) -> DataFrame:
        if feed not in opened:
            opened[feed] = open_feed(spark, feed, landing, what)
        return opened[feed]

    return {s.name: RawInputs(resolve(s.source, "source"), resolve(s.targets, "targets")) for s in specs}


def _check_dates(groups: Sequence[ExtractGroup], inputs: Mapping[str, RawInputs]) -> None:
    for group in groups:
        given, unreadable = group.counted.agg(
            F.sum("dates_given"), F.sum("dates_unreadable")
        ).first()
        if given and given == unreadable:
            spec = group.specs[0]
            refuse_unreadable_dates(spec, inputs[spec.name].extract)


def _check_targets(targets: DataFrame, out: str, week: str, reports: Sequence[str], scratch: Scratch) -> None:
    """One job over the targets of all reports. Offenders are written as
    ``duplicate_targets`` before the run stops."""
    found = scratch.keep(duplicate_targets(targets, KEYS), "duplicate_targets")
    if not found.isEmpty():
        write_findings(found.withColumn("week", F.lit(week)), f"{out}/duplicate_targets", week, reports)
        refuse_duplicates(found.orderBy(*KEYS, "unit_code"))


def _write_rejected(
    groups: Sequence[ExtractGroup], inputs: Mapping[str, RawInputs], path: str, week: str
) -> None:
    """The values that could not be read, once per report that reads them. Only
    extracts whose tally counts some are looked at again."""
    for group in groups:
        names = [s.name for s in group.specs]
        unread = group.counted.agg(F.sum("dates_unreadable"), F.sum("amounts_unreadable")).first()
        rows = rejected_values(group.specs[0], inputs[names[0]].extract)
        rows = rows.select("*", F.explode(name_list(names)).alias("report"), F.lit(week).alias("week"))
        write_findings(rows if any(unread) else rows.limit(0), path, week, names)


def _details(
    specs: Sequence[ReportSpec], inputs: Mapping[str, RawInputs], week: str
) -> DataFrame:
    """The kept rows of the year to date of reports that share an extract, in
    one pass over it."""
    extract = clean_extract(specs[0], inputs[specs[0].name].extract, filter_headers(specs))
    shown = {c: WeekWindow(week, c).in_year_to_date(F.col("activity_date")) for c in cutoffs(specs)}
    longest = next(iter(shown.values()))  # the whole day ends last
    rows = by_report(specs, wanted_by_any(specs, extract).filter(longest))
    if len(shown) > 1:
        rows = rows.join(report_facts(extract.sparkSession, specs), "report")
        rows = rows.filter(F.coalesce(*(F.when(F.col("cutoff") == c, test) for c, test in shown.items())))
    return rows.select(*ROLE_COLUMNS, "report", F.lit(week).alias("week"))


def _write_details(
    groups: Sequence[ExtractGroup],
    inputs: Mapping[str, RawInputs],
    wanted: set[str],
    path: str,
    week: str,
) -> None:
    """One scan per extract; the tally tells which reports have no row."""
    for group in groups:
        specs = [s for s in group.specs if s.name in wanted]
        if not specs:
            continue
        rows = _details(specs, inputs, week)
        write_partitions(rows, path, rebalance=False)
        busy = routed(specs, group.counted, whole=False).filter("rows_ytd > 0").select("report").distinct()
        for name in {s.name for s in specs} - {row.report for row in busy.collect()}:
            write_report(rows.limit(0), path, week, name)


def _segments(
    groups: Sequence[ExtractGroup],
    inputs: Mapping[str, RawInputs],
    warned: set[str],
    scratch: Scratch,
) -> DataFrame:
    """``report, segment, status``: what is there, for every report that asks for
    a segment which is not."""
    spark = scratch.spark
    found = [literal_rows(spark, "report string, segment string, status string", [])]
    for position, group in enumerate(groups):
        specs = [s for s in group.specs if s.name in warned]
        if specs:
            every = segments_of(specs[0], inputs[specs[0].name].extract)
            present = scratch.keep(every.distinct(), f"segments_{position}")
            found += [segment_check(s, present).withColumn("report", F.lit(s.name)) for s in specs]
    return union_all(found)


def _block_source(
    spec: ReportSpec, inputs: RawInputs, rows: DataFrame, detail: DataFrame
) -> Callable[[str], DataFrame]:
    def blocks(name: str) -> DataFrame:
        own = rows.filter(F.col("report") == spec.name)
        return block(name, detail, clean_targets(spec, inputs.targets), sort_board(own))

    return blocks


def run(
    spark: SparkSession,
    book: ReportBook,
    out: str,
    week: str | None = None,
    names: Sequence[str] | None = None,
    landing: str | None = None,
    inputs: Mapping[str, RawInputs] | None = None,
    destination: str | None = None,
    template: str | None = None,
    keep_detail: bool = False,
    keep_rejected: bool = False,
    today: dt.date | None = None,
) -> RunOutcome:
    """Runs the named reports (all by default) for one week (the current one).

    Report names, the week, the publish map, all headers and the uniqueness of
    targets are checked before the first extract is read. Each distinct extract
    is then read once into a tally, from which every figure is derived; once
    more, for all its reports together, if details are kept or published; and
    one column of it if a requested segment is not there. ``out`` is a folder
    shared by the cluster; it receives, by week and report, ``scoreboard``,
    ``run_metrics``, ``warnings``, ``segments``, what readers see of the board
    (``display``, ``cards``, ``chart``), with ``keep_detail`` ``detail`` and with
    ``keep_rejected`` ``rejected``, the dates and amounts that cannot be read.
    """
    specs = book.select(names)
    week = WeekWindow(week or current_week(today)).week
    if destination is not None:
        feeds = [feed for s in specs for feed in (s.source, s.targets)]
        check_destination(spark, destination, template, [f.database for f in feeds if f.database])
    if inputs is None:
        inputs = open_inputs(spark, specs, landing)
    groups = tally_groups(specs, inputs, week)
    targets = targets_by_report(specs, inputs)
    reports = [s.name for s in specs]

    with Scratch(spark, out) as scratch:
        _check_targets(targets, out, week, reports, scratch)
        groups = [
            ExtractGroup(g.specs, scratch.keep(g.counted, f"tally_{i}"))
            for i, g in enumerate(groups)
        ]
        _check_dates(groups, inputs)
        entries = ledger(groups, targets)
        rows = boards(specs, entries).withColumn("week", F.lit(week))
        straight = {s.name: _details([s], inputs, week).select(*ROLE_COLUMNS) for s in specs}
        produced = {s.name: _block_source(s, inputs[s.name], rows, straight[s.name]) for s in specs}
        rules = [rule for rule in book.publish if names is None or rule.report in produced]
        if destination is not None:
            plan(spark, rules, produced, destination, template)  # a bad rule stops the run before it writes

        def written(name: str, frame: DataFrame) -> DataFrame:
            return read_partitions(spark, f"{out}/{name}", frame.schema, week, reports)

        write_partitions(rows, f"{out}/scoreboard")
        board_rows = written("scoreboard", rows)
        metrics = group_metrics(specs, groups, entries, week)
        write_partitions(metrics, f"{out}/run_metrics")
        found = scratch.keep(group_warnings(groups, targets, week), "warnings")
        write_findings(found, f"{out}/warnings", week, reports)
        warned = found.filter(F.col("code") == UNKNOWN_SEGMENT).select("report").distinct()
        segments = _segments(groups, inputs, {row.report for row in warned.collect()}, scratch)
        write_findings(segments.withColumn("week", F.lit(week)), f"{out}/segments", week, reports)

        cards = [
            kpi_cards(s, board_rows.filter(F.col("report") == s.name)).select(
                F.lit(week).alias("week"), F.lit(s.name).alias("report"), "*"
            )
            for s in specs
        ]
        write_partitions(display_rows(board_rows, PARTITIONS), f"{out}/display")
        write_partitions(union_all(cards), f"{out}/cards")
        write_findings(chart_series(board_rows, PARTITIONS, scratch.keep), f"{out}/chart", week, reports)
        if keep_rejected:
            _write_rejected(groups, inputs, f"{out}/rejected", week)

        published = None
        kept = set(reports) if keep_detail else set()
        if destination is not None:
            kept |= {rule.report for rule in rules if rule.block == "detail"}
        details = f"{out if keep_detail else scratch.path}/detail"
        _write_details(groups, inputs, kept, details, week)
        if destination is not None:
            for s in specs:
                detail = straight[s.name]
                if s.name in kept:
                    where = literal_path(partition_path(details, week, s.name))
                    detail = spark.read.schema(detail.schema).parquet(where)
                produced[s.name] = _block_source(s, inputs[s.name], board_rows, detail)
            published = publish(spark, rules, produced, destination, template)

    return RunOutcome(
        week=week,
        reports=tuple(reports),
        scoreboard=sort_board(board_rows, KEYS),
        warnings=written("warnings", found),
        metrics=written("run_metrics", metrics),
        published=published,
    )
