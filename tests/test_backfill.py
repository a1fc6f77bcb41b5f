import datetime as dt
import random

import brute
import pytest

from tallyboard import ReportBook, WeekError, WeekWindow, backfill, run, week_of
from tallyboard.operators.board import sort_board
from tallyboard.plans.backfill import backfill_reports
from tallyboard.sinks.weekly import write_partitions
from tallyboard.sources.extract import clean_extract
from tallyboard.sources.targets import clean_targets


def weeks_of(first, last):
    day, names = WeekWindow(first).monday, []
    while day <= WeekWindow(last).monday:
        names.append(week_of(day))
        day += dt.timedelta(days=7)
    return names


def replay(make_spec, make_extract, make_targets, rows, targets, first, last, kind="timestamp_ntz", **changes):
    spec = make_spec(**changes)
    extract = clean_extract(spec, make_extract(rows, kind))
    planned = clean_targets(spec, make_targets(targets))
    return spec, sort_board(backfill(spec, extract, planned, first, last), ["week"]).collect()


@pytest.mark.parametrize("cutoff", ["day", "midnight"])
@pytest.mark.parametrize("seed", range(3))
def test_every_week_equals_its_own_run(make_spec, make_extract, make_targets, seed, cutoff):
    rng = random.Random(seed)
    # 2017: 1 January and 31 December are Sundays; 2020 has 53 weeks.
    start = dt.datetime(rng.choice([2016, 2019, 2022]), rng.choice([1, 11, 12]), rng.randrange(1, 28))
    rows, targets = brute.random_case(rng, start, start + dt.timedelta(days=500), 300)
    rows += [(dt.datetime(start.year + 1, 12, 31, h), "U3", "Retail") for h in (0, 9)]
    rows += [(dt.datetime(start.year + 1, 1, 1, h), "U3", "Retail") for h in (0, 9)]
    first = week_of(start.date() + dt.timedelta(days=rng.choice([-30, 0, 40])))
    last = week_of(start.date() + dt.timedelta(days=rng.choice([460, 520])))
    spec, found = replay(
        make_spec, make_extract, make_targets, rows, targets, first, last,
        cutoff=cutoff, excluded_unit="U2",
    )
    expected = [
        (week, *line)
        for week in weeks_of(first, last)
        for line in brute.board(rows, targets, week, spec.segments, "U2", cutoff)
    ]
    assert [tuple(r) for r in found] == expected


def test_dates_without_time(make_spec, make_extract, make_targets):
    rows = [(dt.date(2025, 12, 30), "U1"), (dt.date(2026, 1, 2), "U1"), (dt.date(2026, 1, 5), "U1")]
    for cutoff in ("day", "midnight"):
        _, found = replay(
            make_spec, make_extract, make_targets, rows, {}, "2026-W01", "2026-W03", "date",
            cutoff=cutoff,
        )
        units = [(r.week, r.actual_week, r.actual_ytd) for r in found if r.row_type == "unit"]
        assert units == [("2026-W01", 2, 2), ("2026-W02", 1, 2), ("2026-W03", 0, 2)]


def test_weeks_without_anything_have_a_total(make_spec, make_extract, make_targets):
    _, found = replay(make_spec, make_extract, make_targets, [], {}, "2026-W01", "2026-W02")
    assert [(r.week, r.unit_code, r.actual_ytd) for r in found] == [
        ("2026-W01", "All units", 0), ("2026-W02", "All units", 0),
    ]


def test_sum_of_a_column(spark, make_spec, make_targets):
    raw = spark.createDataFrame(
        [(dt.datetime(2026, 1, 2), "U1", "Retail", 1.5), (dt.datetime(2026, 1, 8), "U1", "Retail", 2.25)],
        "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Amount double",
    )
    spec = make_spec(measure="Amount", measure_type="decimal(18,2)", excluded_unit=None)
    rows = backfill(
        spec, clean_extract(spec, raw), clean_targets(spec, make_targets({})), "2026-W01", "2026-W02"
    ).collect()
    figures = [(r.week, float(r.actual_week), float(r.actual_ytd)) for r in rows if r.row_type == "unit"]
    assert figures == [("2026-W01", 1.5, 1.5), ("2026-W02", 2.25, 3.75)]


def test_range_must_run_forward(make_spec, make_extract, make_targets):
    with pytest.raises(WeekError):
        replay(make_spec, make_extract, make_targets, [], {}, "2026-W02", "2026-W01")


def test_written_backfill_equals_weekly_runs(spark, make_spec, make_inputs, tmp_path):
    rng = random.Random(11)
    start = dt.datetime(2025, 12, 20)
    cases = [brute.random_case(rng, start, start + dt.timedelta(days=30), 80) for _ in range(2)]
    specs = [
        make_spec(excluded_unit="U1"),
        make_spec(name="b", segments=(), cutoff="midnight"),
        make_spec(name="c", segments=("Retail", "Other"), excluded_unit="U77"),
        make_spec(name="d", segments=("Nothing",), excluded_unit="U8"),
    ]
    shared, alone = (make_inputs(*case) for case in cases)
    inputs = {"activity": shared, "b": alone, "c": shared, "d": shared}
    weeks = weeks_of("2025-W52", "2026-W02")
    for week in weeks:
        run(spark, ReportBook(specs), str(tmp_path / "runs"), week=week, inputs=inputs)
    write_partitions(
        backfill_reports(specs, inputs, weeks[0], weeks[-1]), str(tmp_path / "backfill")
    )

    def lines(path):
        frame = spark.read.parquet(str(path))
        return sorted(map(str, frame.select(sorted(frame.columns)).collect()))

    assert lines(tmp_path / "backfill") == lines(tmp_path / "runs" / "scoreboard")


def test_reports_that_keep_the_same_rows(make_spec, make_inputs):
    rows = [(dt.datetime(2026, 1, 7), "U1"), (dt.datetime(2026, 1, 8), "U2", "Other")]
    inputs = make_inputs(rows, {"U1": (1.0, 1.0)})
    specs = [make_spec(excluded_unit=None), make_spec(name="b", excluded_unit="U1")]
    found = backfill_reports(specs, {s.name: inputs for s in specs}, "2026-W02", "2026-W02")
    assert {(r.report, r.unit_code, r.actual_ytd) for r in found.collect()} == {
        ("activity", "U1", 1), ("activity", "All units", 1),
        ("b", "U1", 1), ("b", "All units", 1), ("b", "All units except U1", 0),
    }
