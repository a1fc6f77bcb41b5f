"""Weeks that run from Monday to Sunday, on the driver and inside a plan.

Ids look like ``2026-W37`` and compare as text in the order of time. Two periods
belong to a week: its seven days, and the days from New Year to its Sunday. The
New Year meant is that of the civil year its Monday lies in, so a week across
the turn of the year closes the old one.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tallyboard.errors import WeekError

WEEK_ID = r"^\d{4}-W\d{2}$"
CUTOFFS = ("day", "midnight")

_DAY = dt.timedelta(days=1)


# --------------------------------------------------------------- driver side
def week_of(day: dt.date) -> str:
    iso = day.isocalendar()
    return f"{iso.year:04d}-W{iso.week:02d}"


def current_week(today: dt.date | None = None) -> str:
    return week_of(today if today is not None else dt.date.today())


@dataclass(frozen=True)
class WeekWindow:
    """The two periods a scoreboard of one week looks at.

    ``cutoff`` decides what the upper bound means for timestamps: ``day`` keeps
    all of Sunday, ``midnight`` stops at Sunday 00:00. Predicates compare the
    bare column with date literals so that they reach the file scan.
    """

    week: str
    cutoff: str = "day"

    def __post_init__(self) -> None:
        if self.cutoff not in CUTOFFS:
            raise WeekError(f"unknown cutoff {self.cutoff!r}, expected one of {list(CUTOFFS)}")
        self.monday  # a week that does not exist is refused here

    @property
    def monday(self) -> dt.date:
        if not re.fullmatch(WEEK_ID, self.week or "", re.ASCII):
            raise WeekError(f"expected a week like 2026-W37, got {self.week!r}")
        try:
            return dt.date.fromisocalendar(int(self.week[:4]), int(self.week[6:]), 1)
        except ValueError:
            raise WeekError(f"no such week: {self.week}") from None

    @property
    def sunday(self) -> dt.date:
        return self.monday + 6 * _DAY

    @property
    def ytd_start(self) -> dt.date:
        return self.monday.replace(month=1, day=1)

    @property
    def label(self) -> str:
        # Fixed format: week number, then day/month bounds, year on the second.
        return f"S{self.week[6:]} - du {self.monday:%d/%m} au {self.sunday:%d/%m/%Y}"

    def after(self, moment: Column) -> Column:
        if self.cutoff == "midnight":
            return moment > F.lit(self.sunday)
        return moment >= F.lit(self.sunday + _DAY)

    def _until_end(self, moment: Column) -> Column:
        if self.cutoff == "midnight":
            return moment <= F.lit(self.sunday)
        return moment < F.lit(self.sunday + _DAY)

    def in_week(self, moment: Column) -> Column:
        return (moment >= F.lit(self.monday)) & self._until_end(moment)

    def in_year_to_date(self, moment: Column) -> Column:
        return (moment >= F.lit(self.ytd_start)) & self._until_end(moment)


def week_span(first: str, last: str) -> list[dt.date]:
    """First and last Monday of a range of weeks, both included."""
    bounds = [WeekWindow(first).monday, WeekWindow(last).monday]
    if bounds[0] > bounds[1]:
        raise WeekError(f"empty range of weeks: {first} is after {last}")
    return bounds


# --------------------------------------------------------------- column side
def week_id(day: Column) -> Column:
    """ISO week id of a date or timestamp."""
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    number = F.weekofyear(day).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("-W"), F.lpad(number, 2, "0"))


def monday_of(day: Column) -> Column:
    return F.trunc(day.cast("date"), "week")


def monday_of_week(week: Column) -> Column:
    """Monday of a week id; NULL for a malformed id or a week that does not exist."""
    well_formed = F.when(week.rlike(WEEK_ID), week)
    year = F.substring(well_formed, 1, 4).cast("int")
    number = F.substring(well_formed, 7, 2).cast("int")
    # 4 January is always in week 1. Week 53 of a short year or week 99 lands
    # in another ISO year, so only a result that maps back to its id is kept.
    fourth = F.make_date(F.when(year >= 1, year), F.lit(1), F.lit(4))
    monday = F.date_add(F.trunc(fourth, "week"), (number - 1) * 7)
    return F.when(week_id(monday) == week, monday)


def sunday_of(monday: Column) -> Column:
    return F.date_add(monday, 6)


def year_start_of(monday: Column) -> Column:
    return F.make_date(F.year(monday), F.lit(1), F.lit(1))


def week_label(monday: Column) -> Column:
    """``S37 - du 07/09 au 13/09/2026``."""
    return F.concat(
        F.format_string("S%02d - du ", F.weekofyear(monday)),
        F.date_format(monday, "dd/MM"),
        F.lit(" au "),
        F.date_format(sunday_of(monday), "dd/MM/yyyy"),
    )
