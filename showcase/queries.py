"""One query per operator: (spark, folder) -> DataFrame.

Dates leave as ISO text, so that they compare equal in every engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from showcase import datasets as d
from tallyboard.functions import weeks
from tallyboard.functions.weeks import WeekWindow
from tallyboard.operators import board as boards
from tallyboard.operators import presentation
from tallyboard.operators.filters import retained_detail, segment_filter
from tallyboard.operators.quality import segment_check
from tallyboard.operators.volumes import volumes
from tallyboard.plans.backfill import backfill, backfill_reports
from tallyboard.plans.history import History, backfill_kept
from tallyboard.plans.many import RawInputs, report_metrics, report_warnings, scoreboards
from tallyboard.plans.scoreboard import aligned_units, scoreboard
from tallyboard.sinks.scratch import shared_path
from tallyboard.sources.extract import (
    ROLE_COLUMNS,
    clean_extract,
    date_quality,
    rejected_values,
    segments_of,
)
from tallyboard.sources.targets import clean_targets, duplicate_targets
from tallyboard.spec import ReportSpec

Query = Callable[[SparkSession, str], DataFrame]


def iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def iso_day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _orders(spark: SparkSession, folder: str, spec: ReportSpec) -> DataFrame:
    return clean_extract(spec, d.orders_wide(spark, folder))


def _nation_board(spark: SparkSession, folder: str, week: str = d.WEEK, **changes) -> DataFrame:
    spec = d.orders_spec(**changes)
    targets = clean_targets(spec, d.nation_targets(spark, folder))
    return scoreboard(spec, _orders(spark, folder, spec), targets, week)


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec()
    targets = clean_targets(spec, d.nation_targets(spark, folder))
    return aligned_units(spec, _orders(spark, folder, spec), targets, d.WEEK)


def customer_spec() -> ReportSpec:
    return d.orders_spec(
        name="revenue",
        source_columns={"date": "o_orderdate", "segment": "c_mktsegment", "unit": "c_name"},
        measure="o_totalprice", measure_type="decimal(18,2)",
        measure_label="revenue",
        excluded_unit="Customer#000000007",
    )


def _customer_board(spark: SparkSession, folder: str) -> DataFrame:
    spec = customer_spec()
    targets = clean_targets(spec, d.customer_targets(spark, folder))
    return scoreboard(spec, _orders(spark, folder, spec), targets, d.WEEK)


def _as_double(rows: DataFrame) -> DataFrame:
    """Sums are exact decimals; compared as doubles."""
    return rows.withColumns({c: F.col(c).cast("double") for c in ("actual_week", "actual_ytd")})


# ------------------------------------------------------------------ sources
def extract_clean(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.dirty_spec()
    extract = clean_extract(spec, d.dirty_orders(spark, folder))
    return extract.select(iso("activity_date"), "segment", "unit_code", "date_unreadable")


def date_quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return date_quality(clean_extract(d.dirty_spec(), d.dirty_orders(spark, folder)))


def targets_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_targets(d.orders_spec(), d.dirty_targets(spark, folder))


def duplicate_targets_query(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec()
    return duplicate_targets(clean_targets(spec, d.repeated_targets(spark, folder)))


# ------------------------------------------------------- filters and volumes
def segment_filter_query(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.dirty_spec()
    extract = clean_extract(spec, d.dirty_orders(spark, folder))
    kept = segment_filter(spec, extract).select(*ROLE_COLUMNS)
    return kept.select(iso("activity_date"), "segment", "unit_code")


def retained_detail_query(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.dirty_spec()
    extract = clean_extract(spec, d.dirty_orders(spark, folder))
    detail = retained_detail(spec, extract, WeekWindow(d.WEEK))
    return detail.select(iso("activity_date"), "segment", "unit_code")


def volumes_query(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec()
    return volumes(spec, _orders(spark, folder, spec), WeekWindow(d.WEEK))


def target_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return _aligned(spark, folder)


def units_without_target(spark: SparkSession, folder: str) -> DataFrame:
    return boards.units_without_target(_aligned(spark, folder))


def units_without_activity(spark: SparkSession, folder: str) -> DataFrame:
    return boards.units_without_activity(_aligned(spark, folder))


# ------------------------------------------------------------------- boards
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return _nation_board(spark, folder)


def scoreboard_straddling(spark: SparkSession, folder: str) -> DataFrame:
    return _nation_board(spark, folder, d.STRADDLING_WEEK, segments=())


def scoreboard_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(_nation_board(spark, folder, measure="o_totalprice", measure_type="decimal(18,2)"))


def scoreboard_filtered(spark: SparkSession, folder: str) -> DataFrame:
    filters = {"o_orderpriority": ("1-URGENT", "2-HIGH"), "o_orderstatus": ("O", "F")}
    return _nation_board(spark, folder, filters=filters)


def scoreboard_region(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec(
        source_columns={"date": "o_orderdate", "segment": "c_mktsegment", "unit": "r_name"},
        excluded_unit="ASIA",
    )
    extract = clean_extract(spec, d.orders_by_region(spark, folder))
    targets = clean_targets(spec, d.region_targets(spark, folder))
    return scoreboard(spec, extract, targets, d.WEEK)


def scoreboard_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(_customer_board(spark, folder))


def events_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    """The same week with both meanings of its last day, from one tally."""
    specs = [d.events_spec(name=cutoff, cutoff=cutoff) for cutoff in weeks.CUTOFFS]
    inputs = RawInputs(d.events_wide(spark, folder), d.event_targets(spark, folder))
    rows = scoreboards(specs, {s.name: inputs for s in specs}, d.EVENTS_WEEK)
    return rows.withColumnRenamed("report", "cutoff")


def unit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return boards.unit_rows(_nation_board(spark, folder))


def total_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _nation_board(spark, folder)
    return rows.filter(F.col("row_type") != boards.UNIT)


# ------------------------------------------------------------------ quality
def _many(spark: SparkSession, folder: str) -> tuple[list[ReportSpec], dict[str, RawInputs]]:
    """Three reports on orders that share one scan, one on events."""
    orders = RawInputs(d.orders_wide(spark, folder), d.nation_targets(spark, folder))
    events = RawInputs(d.events_wide(spark, folder), d.event_targets(spark, folder))
    urgent = {"o_orderpriority": ("1-URGENT", "0-NEVER")}
    specs = [
        d.orders_spec(),
        d.orders_spec(name="everything", segments=(), excluded_unit=None),
        d.orders_spec(name="urgent", filters=urgent, excluded_unit="NATION_88"),
        d.events_spec(segments=("signup",), excluded_unit="U9"),
    ]
    return specs, {s.name: events if s.name == "events" else orders for s in specs}


def multi_report(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _many(spark, folder)
    return scoreboards(specs, inputs, d.WEEK)


def _dirty(spark: SparkSession, folder: str) -> tuple[list[ReportSpec], dict[str, RawInputs]]:
    specs, inputs = _many(spark, folder)
    cases = RawInputs(d.dirty_orders(spark, folder), d.nation_targets(spark, folder))
    return [*specs, d.dirty_spec()], {**inputs, "cases": cases}


def warnings_query(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _dirty(spark, folder)
    return report_warnings(specs, inputs, d.WEEK)


def run_metrics_query(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _dirty(spark, folder)
    return report_metrics(specs, inputs, d.WEEK)


def unknown_segments(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.dirty_spec()
    return segment_check(spec, segments_of(spec, d.dirty_orders(spark, folder)))


def _amounts(spark: SparkSession, folder: str) -> tuple[list[ReportSpec], dict[str, RawInputs]]:
    """Sums of a text column of which some values are no amounts."""
    inputs = RawInputs(d.dirty_orders(spark, folder), d.nation_targets(spark, folder))
    specs = [d.amounts_spec(), d.amounts_spec(name="all amounts", segments=(), excluded_unit=None)]
    return specs, {s.name: inputs for s in specs}


def scoreboard_amounts(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _amounts(spark, folder)
    return _as_double(scoreboards(specs, inputs, d.WEEK))


def amount_warnings(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _amounts(spark, folder)
    return report_warnings(specs, inputs, d.WEEK)


def amount_metrics(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _amounts(spark, folder)
    rows = report_metrics(specs, inputs, d.WEEK)
    return rows.withColumn("actual_ytd", F.col("actual_ytd").cast("double"))


def rejected_values_query(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_values(d.amounts_spec(), d.dirty_orders(spark, folder))


# -------------------------------------------------------------------- weeks
def week_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Every day on which something happened, with its week."""
    days = d.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    days = days.unionByName(
        d.table(spark, folder, "events").select(F.col("ts").cast("date").alias("day"))
    ).distinct()
    named = days.withColumn("week", weeks.week_id(F.col("day")))
    monday = weeks.monday_of_week(F.col("week"))
    dated = named.withColumn("monday", monday).withColumns(
        {
            "sunday": weeks.sunday_of(F.col("monday")),
            "year_start": weeks.year_start_of(F.col("monday")),
            "label": weeks.week_label(F.col("monday")),
        }
    )
    return dated.select(
        iso_day("day"), "week", iso_day("monday"), iso_day("sunday"), iso_day("year_start"), "label"
    )


def week_parsing(spark: SparkSession, folder: str) -> DataFrame:
    """Week ids of every quality: weeks 00 to 99, and misshapen ones."""
    key = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    number = F.lpad((key % 100).cast("string"), 2, "0")
    text = F.when(key % 10 == 9, F.concat(year, F.lit("-"), number)).otherwise(
        F.concat(year, F.lit("-W"), number)
    )
    ids = d.table(spark, folder, "orders").select(text.alias("week")).distinct()
    parsed = ids.withColumn("monday", weeks.monday_of_week(F.col("week")))
    return parsed.select("week", iso_day("monday"))


# ----------------------------------------------------------------- backfill
def backfill_weeks(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec()
    targets = clean_targets(spec, d.nation_targets(spark, folder))
    extract = _orders(spark, folder, spec)
    return backfill(spec, extract, targets, d.FIRST_WEEK, d.LAST_WEEK)


def backfill_events(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks closed at midnight on timestamped rows."""
    spec = d.events_spec(cutoff="midnight")
    targets = clean_targets(spec, d.event_targets(spark, folder))
    extract = clean_extract(spec, d.events_wide(spark, folder))
    return backfill(spec, extract, targets, "2023-W52", "2024-W06")


def backfill_sum(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec(
        source_columns={"date": "o_orderdate", "segment": "c_mktsegment", "unit": "r_name"},
        excluded_unit="ASIA",
        measure="o_totalprice", measure_type="decimal(18,2)",
    )
    targets = clean_targets(spec, d.region_targets(spark, folder))
    extract = clean_extract(spec, d.orders_by_region(spark, folder))
    return _as_double(backfill(spec, extract, targets, d.FIRST_WEEK, d.LAST_WEEK))


def backfill_reports_query(spark: SparkSession, folder: str) -> DataFrame:
    specs, inputs = _many(spark, folder)
    return backfill_reports(specs, inputs, d.FIRST_WEEK, d.LAST_WEEK)


def backfill_kept_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every week from daily totals that are counted once and kept."""
    specs, inputs = _many(spark, folder)
    return backfill_kept(specs, inputs, d.FIRST_WEEK, d.LAST_WEEK, History(spark, shared_path(spark, "history")))


# ------------------------------------------------------------- presentation
def block_scoreboard(spark: SparkSession, folder: str) -> DataFrame:
    rows = _nation_board(spark, folder)
    return presentation.block("scoreboard", rows, rows, rows)


def block_targets(spark: SparkSession, folder: str) -> DataFrame:
    spec = d.orders_spec()
    targets = clean_targets(spec, d.dirty_targets(spark, folder))
    return presentation.block("targets", targets, targets, targets)


def display_rows(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.display_rows(_customer_board(spark, folder))


def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.kpi_cards(customer_spec(), _customer_board(spark, folder))


def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.chart_series(_customer_board(spark, folder))


QUERIES: dict[str, Query] = {
    "scoreboard": flagship,
    "extract_clean": extract_clean,
    "date_quality": date_quality_query,
    "targets_clean": targets_clean,
    "duplicate_targets": duplicate_targets_query,
    "segment_filter": segment_filter_query,
    "retained_detail": retained_detail_query,
    "volumes": volumes_query,
    "target_alignment": target_alignment,
    "units_without_target": units_without_target,
    "units_without_activity": units_without_activity,
    "scoreboard_straddling": scoreboard_straddling,
    "scoreboard_sum": scoreboard_sum,
    "scoreboard_filtered": scoreboard_filtered,
    "scoreboard_region": scoreboard_region,
    "scoreboard_customers": scoreboard_customers,
    "events_cutoff": events_cutoff,
    "unit_rows": unit_rows,
    "total_rows": total_rows,
    "multi_report": multi_report,
    "warnings": warnings_query,
    "run_metrics": run_metrics_query,
    "unknown_segments": unknown_segments,
    "scoreboard_amounts": scoreboard_amounts,
    "amount_warnings": amount_warnings,
    "amount_metrics": amount_metrics,
    "rejected_values": rejected_values_query,
    "week_dimension": week_dimension,
    "week_parsing": week_parsing,
    "backfill_weeks": backfill_weeks,
    "backfill_events": backfill_events,
    "backfill_sum": backfill_sum,
    "backfill_reports": backfill_reports_query,
    "backfill_kept": backfill_kept_query,
    "block_scoreboard": block_scoreboard,
    "block_targets": block_targets,
    "display_rows": display_rows,
    "kpi_cards": kpi_cards,
    "chart_series": chart_series,
}
