"""Which extract rows a report looks at."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tallyboard.functions.weeks import WeekWindow
from tallyboard.sources.datasets import header
from tallyboard.sources.extract import ROLE_COLUMNS, filter_column
from tallyboard.spec import ReportSpec


def wanted_values(spec: ReportSpec) -> dict[str, tuple[str, ...]]:
    """Extract column -> values to keep, for every list that is not empty."""
    lists = {"segment": spec.segments}
    lists.update({filter_column(name): values for name, values in spec.filters.items()})
    return {column: values for column, values in lists.items() if values}


def segment_filter(spec: ReportSpec, extract: DataFrame) -> DataFrame:
    """The rows that one report keeps."""
    return wanted_by_any([spec], extract)


def wanted_by_any(specs: Iterable[ReportSpec], extract: DataFrame) -> DataFrame:
    """Without rows that no report can keep: where all reports restrict a
    column, its value is in one of their lists. Bare predicates, one per column
    however many reports there are, so that they can be pushed down. For one
    report, or reports with equal lists, these are exactly the kept rows."""
    lists = [wanted_values(spec) for spec in specs]
    for column in lists[0]:
        if all(column in wanted for wanted in lists):
            values = {value for wanted in lists for value in wanted[column]}
            extract = extract.filter(header(column).isin(*sorted(values)))
    return extract


def retained_detail(spec: ReportSpec, extract: DataFrame, window: WeekWindow) -> DataFrame:
    """The kept rows of the year to date. Rows without a unit stay in."""
    kept = segment_filter(spec, extract)
    return kept.filter(window.in_year_to_date(F.col("activity_date"))).select(*ROLE_COLUMNS)
