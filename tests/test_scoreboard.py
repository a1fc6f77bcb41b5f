import datetime as dt
import random

import brute
import pytest
from conftest import AFTER, EARLIER, IN_WEEK, LAST_YEAR, WEEK

from tallyboard import WeekWindow, scoreboard
from tallyboard.operators import board as boards
from tallyboard.operators.filters import retained_detail, segment_filter
from tallyboard.plans.scoreboard import aligned_units
from tallyboard.sources.extract import clean_extract
from tallyboard.sources.targets import clean_targets

T10 = {"U01": (10.0, 100.0)}


def spread(**counts):
    """Cases of units: (earlier this year, in the week) each, in alternation with rows that never count."""
    rows = []
    for unit, (before, inside) in counts.items():
        rows += [(EARLIER, unit)] * before + [(IN_WEEK, unit)] * inside
        rows += [(LAST_YEAR, unit), (AFTER, unit), (EARLIER, unit, "Corporate"), (IN_WEEK, unit, None)]
    return rows


def test_one_board_by_hand(make_board):
    targets = {"U01": (16.0, 64.0), "U02": (0.0, 25.0), "U99": (7.0, None), "U40": (4.0, 8.0)}
    rows = make_board(spread(U01=(17, 3), U02=(0, 5), U99=(2, 0), U55=(1, 1)), targets)
    shown = {name: (r.actual_week, r.actual_ytd, r.target_start, r.attainment, r.gap, r.annual_share) for name, r in rows.items()}
    assert shown == {
        "U01": (3, 20, 16.0, 1.25, 4.0, 0.3125),
        "U02": (5, 5, 0.0, None, 5.0, 0.2),  # nothing to divide by
        "U40": (0, 0, 4.0, 0.0, -4.0, 0.0),  # a target alone
        "U55": (1, 2, None, None, None, None),  # activity alone
        "U99": (0, 2, 7.0, 2 / 7, -5.0, None),
        "All units": (9, 29, 27.0, 29 / 27, 2.0, 29 / 97),
        "All units except U99": (9, 27, 20.0, 27 / 20, 7.0, 27 / 97),
    }
    assert [r.row_type for r in rows.values()][-2:] == ["total", "total_excl"]


def test_without_a_segment_list_every_row_is_kept(make_board):
    assert make_board(spread(U03=(2, 2)), T10, segments=())["U03"].actual_ytd == 6


def test_no_second_total_without_the_excluded_unit(make_board):
    assert list(make_board(spread(U01=(0, 1)), T10)) == ["U01", "All units"]


def test_excluded_unit_may_exist_in_targets_only(make_board):
    rows = make_board([(IN_WEEK,)], {**T10, "U99": (5.0, 50.0)})
    assert rows["All units except U99"].target_start == 10.0
    assert rows["All units"].target_start == 15.0


def test_only_the_excluded_unit(make_board):
    rest = make_board([(IN_WEEK, "U99")], {"U99": (5.0, 50.0)})["All units except U99"]
    assert (rest.actual_week, rest.actual_ytd) == (0, 0)
    assert rest.target_start is None and rest.gap is None and rest.attainment is None


def test_unit_with_rows_outside_the_period_only_is_not_shown(make_board):
    assert "U05" not in make_board([(IN_WEEK,), (LAST_YEAR, "U05"), (AFTER, "U05")], T10)


def test_null_units_and_dates_count_nowhere_and_blank_is_a_unit(make_board):
    rows = make_board([(IN_WEEK, None), (None, "U01"), (IN_WEEK, "  "), (IN_WEEK, " U01 ")], T10)
    assert list(rows) == ["", "U01", "All units"]
    assert rows["U01"].actual_ytd == 1 and rows["All units"].actual_ytd == 2


def test_null_targets_in_totals(make_board):
    rows = make_board([(IN_WEEK, "U01")], {"U01": (None, 8.0), "U02": (4.0, None)})
    assert (rows["All units"].target_start, rows["All units"].target_annual) == (4.0, 8.0)
    rows = make_board([(IN_WEEK, "U01")], {"U01": (None, None)})
    assert rows["All units"].target_start is None and rows["All units"].actual_ytd == 1


def test_empty_inputs_still_have_a_total(make_board, spark):
    rows = make_board([], {})
    assert list(rows) == ["All units"]
    assert tuple(rows["All units"])[1:3] == (0, 0)
    assert rows["All units"].target_start is None


def test_sunday_afternoon(make_board):
    cases = [(dt.datetime(2023, 5, 14),), (dt.datetime(2023, 5, 14, 15),), (dt.datetime(2023, 5, 15),)]
    row = make_board(cases, T10)["U01"]
    assert (row.actual_week, row.actual_ytd) == (2, 2)
    row = make_board(cases, T10, cutoff="midnight")["U01"]
    assert (row.actual_week, row.actual_ytd) == (1, 1)


@pytest.mark.parametrize("cutoff", ["day", "midnight"])
@pytest.mark.parametrize("week", ["2026-W01", "2025-W01", "2024-W52", "2025-W52", "2020-W53"])
def test_boundaries_against_brute_force(make_board, week, cutoff):
    rng = random.Random(f"{week}{cutoff}")
    monday = dt.datetime.combine(WeekWindow(week).monday, dt.time())
    rows, targets = brute.random_case(
        rng, monday - dt.timedelta(days=380), monday + dt.timedelta(days=15)
    )
    found = make_board(rows, targets, week, cutoff=cutoff, excluded_unit="U2", segments=("Retail",))
    expected = brute.board(rows, targets, week, ("Retail",), "U2", cutoff)
    assert [tuple(r) for r in found.values()] == expected


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_any_kind_of_date_column(spark, make_spec, make_extract, make_targets, kind):
    moments = [IN_WEEK, EARLIER, AFTER]
    if kind == "date":
        moments = [m.date() for m in moments]
    if kind == "string":
        moments = ["2023-05-10", "03/02/2023", "2023-05-21 00:00:00"]
    spec = make_spec()
    extract = clean_extract(spec, make_extract([(m,) for m in moments], kind))
    rows = scoreboard(spec, extract, clean_targets(spec, make_targets(T10)), WEEK)
    assert (rows.first().actual_week, rows.first().actual_ytd) == (1, 2)


def test_sum_of_a_column(spark, make_spec, make_targets):
    rows = [(IN_WEEK, "U01", "Retail", 10.25), (EARLIER, "U01", "Retail", 0.1), (IN_WEEK, "U01", "Retail", None)]
    rows += [(IN_WEEK, "U02", "Retail", None), (IN_WEEK, "U03", "Corporate", 7.0)]
    raw = spark.createDataFrame(
        rows, "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Amount double"
    )
    spec = make_spec(measure="Amount", measure_type="decimal(18,2)")
    extract = clean_extract(spec, raw)
    found = scoreboard(spec, extract, clean_targets(spec, make_targets(T10)), WEEK).collect()
    figures = {r.unit_code: (float(r.actual_week), float(r.actual_ytd)) for r in found}
    assert figures == {"U01": (10.25, 10.35), "U02": (0.0, 0.0), "All units": (10.25, 10.35)}


def test_extra_filters_combine(spark, make_spec, make_targets):
    rows = [(IN_WEEK, "U01", "Retail", k) for k in ("new", " new ", "renewal", None)]
    rows += [(IN_WEEK, "U01", "Corporate", "new")]
    raw = spark.createDataFrame(
        rows, "`Opened on` timestamp_ntz, `Unit code` string, Segment string, `Kind.of case` string"
    )

    def ytd(**filters):
        spec = make_spec(filters={"Kind.of case": filters["kinds"]})
        found = scoreboard(
            spec, clean_extract(spec, raw), clean_targets(spec, make_targets(T10)), WEEK
        )
        return found.first().actual_ytd

    assert ytd(kinds=("new",)) == 2
    assert ytd(kinds=()) == 4


def test_retained_detail_and_segment_filter(make_spec, make_extract, window):
    cases = [(IN_WEEK,), (EARLIER, None), (AFTER,), (LAST_YEAR,), (None,), (IN_WEEK, "U01", "Other")]
    spec = make_spec()
    extract = clean_extract(spec, make_extract(cases))
    assert segment_filter(spec, extract).count() == 5
    detail = retained_detail(spec, extract, window)
    assert detail.columns == ["activity_date", "segment", "unit_code"]
    assert {(r.activity_date, r.unit_code) for r in detail.collect()} == {
        (IN_WEEK, "U01"),
        (EARLIER, None),
    }


def test_accessors(spark, make_spec, make_extract, make_targets):
    spec = make_spec()
    extract = clean_extract(spec, make_extract([(IN_WEEK, "U01"), (IN_WEEK, "U07")]))
    targets = clean_targets(spec, make_targets({**T10, "U02": (1.0, 1.0)}))
    rows = scoreboard(spec, extract, targets, WEEK)
    assert [r.unit_code for r in boards.unit_rows(rows).collect()] == ["U01", "U02", "U07"]
    assert [r.unit_code for r in boards.total_row(rows).collect()] == ["All units"]
    aligned = aligned_units(spec, extract, targets, WEEK)
    assert [r.unit_code for r in boards.units_without_target(aligned).collect()] == ["U07"]
    assert [r.unit_code for r in boards.units_without_activity(aligned).collect()] == ["U02"]
    assert rows.schema == boards.sort_board(rows).schema
    assert tuple(rows.columns) == boards.BOARD_COLUMNS
