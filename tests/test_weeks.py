import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyboard import WeekError, WeekWindow, current_week, week_of
from tallyboard.functions import weeks


#: A day, its week, the Monday and the start of the cumulation.
CASES = [
    ("2020-02-29", "2020-W09", "2020-02-24", "2020-01-01"),
    ("2021-01-03", "2020-W53", "2020-12-28", "2020-01-01"),  # January days of the old year
    ("2021-01-04", "2021-W01", "2021-01-04", "2021-01-01"),
    ("2024-12-31", "2025-W01", "2024-12-30", "2024-01-01"),  # the Monday decides
    ("2028-07-16", "2028-W28", "2028-07-10", "2028-01-01"),
]


@pytest.mark.parametrize("day, week, monday, start", CASES)
def test_weeks_by_hand(day, week, monday, start):
    date = dt.date.fromisoformat
    assert week_of(date(day)) == current_week(date(day)) == week
    window = WeekWindow(week)
    assert window.monday == date(monday) and window.sunday == date(monday) + dt.timedelta(6)
    assert window.ytd_start == date(start)


def test_today_is_the_default():
    assert current_week() == week_of(dt.date.today())


@pytest.mark.parametrize("week", ["2021W05", "W05", " ", None, "2021-W54", "2021-W00", "2021-W53", "21-W05", "2021-W0²"])
def test_what_is_no_week_is_refused(week):
    with pytest.raises(WeekError):
        WeekWindow(week)


def test_unknown_cutoff_is_refused():
    with pytest.raises(WeekError, match="cutoff"):
        WeekWindow("2023-W19", "noon")


def test_label_format():
    assert WeekWindow("2020-W53").label == "S53 - du 28/12 au 03/01/2021"
    assert WeekWindow("2028-W28").label == "S28 - du 10/07 au 16/07/2028"


def test_columns_agree_with_the_calendar(spark):
    """Every day of 30 years, through every column function."""
    first = dt.date(1995, 1, 1)
    days = spark.range(0, 30 * 366, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    named = days.withColumn("week", weeks.week_id(F.col("day")))
    rows = named.withColumn("monday", weeks.monday_of_week(F.col("week"))).select(
        "*",
        weeks.monday_of(F.col("day")).alias("start"),
        weeks.sunday_of(F.col("monday")).alias("sunday"),
        weeks.year_start_of(F.col("monday")).alias("ytd_start"),
        weeks.week_label(F.col("monday")).alias("label"),
    )
    for row in rows.collect():
        window = WeekWindow(week_of(row.day))
        assert row.week == window.week
        assert row.monday == row.start == window.monday
        assert row.sunday == window.sunday
        assert row.ytd_start == window.ytd_start
        assert row.label == window.label


def test_column_parsing_rejects_what_the_driver_rejects(spark):
    ids = [f"{y}-W{w:02d}" for y in (0, 1, 1999, 2020, 2025, 2026) for w in range(100)]
    ids = [i.zfill(8) for i in ids] + ["2026-37", "W37", "", "2026-W7", "x2026-W07", "2026-W07x", None]
    frame = spark.createDataFrame([(i,) for i in ids], "week string").coalesce(1)
    for row in frame.withColumn("monday", weeks.monday_of_week(F.col("week"))).collect():
        try:
            expected = WeekWindow(row.week).monday
        except WeekError:
            expected = None
        assert row.monday == expected, row.week


def test_range_of_weeks_must_run_forward():
    with pytest.raises(WeekError, match="empty range"):
        weeks.week_span("2026-W02", "2026-W01")
