import dataclasses
import datetime as dt
import random

import brute
import pytest
from conftest import AFTER, EARLIER, IN_WEEK, LAST_YEAR, WEEK

from tallyboard import Feed, RawInputs, scoreboards
from tallyboard.plans import many
from tallyboard.operators.quality import segment_check
from tallyboard.operators.tally import activity_lines
from tallyboard.sources.extract import clean_extract

T10 = {"U01": (10.0, 100.0)}


def findings(spec, inputs, week=WEEK):
    rows = many.report_warnings([spec], {spec.name: inputs}, week).collect()
    assert all((r.report, r.week) == (spec.name, week) for r in rows)
    return {(r.code, r.subject): r.n for r in rows}


def test_nothing_to_warn_about(make_spec, make_inputs):
    rows = [(IN_WEEK, "U01", "Retail"), (IN_WEEK, "U99", "Business"), (LAST_YEAR, "U05", "Retail")]
    assert findings(make_spec(), make_inputs(rows, {**T10, "U99": (1.0, 1.0)})) == {}


def test_unknown_segment_is_judged_on_the_whole_extract(make_spec, make_inputs):
    spec = make_spec(excluded_unit=None)
    assert findings(spec, make_inputs([(IN_WEEK,)], T10)) == {("unknown_segment", "Business"): 0}
    rows = [(IN_WEEK,), (LAST_YEAR, None, " Business ")]
    assert findings(spec, make_inputs(rows, T10)) == {}


def test_nothing_kept(make_spec, make_inputs):
    spec = make_spec(excluded_unit=None, segments=("Retail",))
    rows = [(IN_WEEK, "U01", "Other")]
    assert findings(spec, make_inputs(rows, T10)) == {
        ("unknown_segment", "Retail"): 0, ("nothing_kept", ""): 0,
    }
    everything = make_spec(excluded_unit=None, segments=())
    assert findings(everything, make_inputs([], T10)) == {("nothing_kept", ""): 0}
    assert findings(everything, make_inputs([(None, None, None)], T10)) == {}


def test_later_rows_are_counted_after_the_segment_filter(make_spec, make_inputs):
    rows = [(IN_WEEK,), (AFTER,), (AFTER, None), (AFTER, "U01", "Other"), (None,), (IN_WEEK, "U01", "Business")]
    assert findings(make_spec(excluded_unit=None), make_inputs(rows, T10)) == {
        ("later_rows", "2023-05-14"): 2
    }


def test_unit_without_target(make_spec, make_inputs):
    rows = [(IN_WEEK, "U07"), (EARLIER, "U07", "Business"), (LAST_YEAR, "U08"), (IN_WEEK, None)]
    spec = make_spec(excluded_unit=None)
    assert findings(spec, make_inputs(rows, T10)) == {("unit_without_target", "U07"): 2}
    known = make_inputs(rows, {"U07": (None, None)})
    assert findings(spec, known) == {}


def test_excluded_unit_missing(make_spec, make_inputs):
    spec = make_spec(segments=())
    expected = {("excluded_unit_missing", "U99"): 0}
    assert findings(spec, make_inputs([(IN_WEEK,), (LAST_YEAR, "U99")], T10)) == expected
    assert findings(spec, make_inputs([(IN_WEEK,)], {**T10, "U99": (None, None)})) == {}
    seen = make_inputs([(IN_WEEK, "U99")], T10)
    assert findings(spec, seen) == {("unit_without_target", "U99"): 1}


def test_unknown_filter_value(spark, make_spec, make_targets):
    raw = spark.createDataFrame(
        [(IN_WEEK, "U01", "Retail", "new")],
        "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Kind string",
    )
    spec = make_spec(segments=(), excluded_unit=None, filters={"Kind": ("new", "renewal")})
    inputs = RawInputs(raw, make_targets(T10))
    assert findings(spec, inputs) == {("unknown_filter_value", "Kind=renewal"): 0}


def test_metrics(make_spec, make_inputs):
    rows = [(IN_WEEK,), (EARLIER, "U02"), (AFTER,), (None,), (IN_WEEK, None), (IN_WEEK, "U01", "Other")]
    spec = make_spec()
    inputs = make_inputs(rows, {**T10, "U03": (5.0, 5.0)})
    row = many.report_metrics([spec], {"activity": inputs}, WEEK).first()
    assert row.asDict() == dict(
        report="activity", week=WEEK, rows_read=6, rows_kept=5, rows_later=1, dates_unreadable=0,
        amounts_unreadable=0, unit_count=3, actual_ytd=2, target_start=15.0, attainment=2 / 15,
    )
    empty = many.report_metrics([spec], {"activity": make_inputs([], {})}, WEEK).first()
    assert tuple(empty)[2:] == (0, 0, 0, 0, 0, 0, 0, None, None)


def test_segment_check(make_spec, make_extract):
    rows = [(IN_WEEK, "U01", s) for s in ("Retail", "Retail", "Other", None)]
    spec = make_spec()
    found = segment_check(spec, clean_extract(spec, make_extract(rows)))
    assert {tuple(r) for r in found.collect()} == {
        ("Retail", "kept"), ("Other", "ignored"), ("Business", "unknown"),
    }
    bare = make_spec(segments=())
    assert segment_check(bare, clean_extract(bare, make_extract(rows))).count() == 2


@pytest.fixture
def portfolio(make_spec, make_inputs):
    """Three reports over one extract, one over another, one over nothing."""
    rng = random.Random(5)
    first, last = dt.datetime(2022, 12, 1), dt.datetime(2026, 1, 26)
    rows, targets = brute.random_case(rng, first, last, 600)
    others, other_targets = brute.random_case(rng, first, last, 300)
    shared, other, nothing = make_inputs(rows, targets), make_inputs(others, other_targets), make_inputs([], {})
    specs = [
        make_spec(name="kept", excluded_unit="U2"),
        make_spec(name="all", segments=(), excluded_unit=None),
        make_spec(name="one", segments=("Retail",), excluded_unit="U77"),
        make_spec(name="other", source=Feed(pattern="other"), excluded_unit="nobody"),
        make_spec(name="empty", source=Feed(pattern="empty")),
    ]
    inputs = dict(kept=shared, all=shared, one=shared, other=other, empty=nothing)
    raw = dict(kept=(rows, targets), all=(rows, targets), one=(rows, targets), other=(others, other_targets), empty=([], {}))
    return specs, inputs, raw


@pytest.mark.parametrize("week", ["2023-W19", "2026-W01", "2026-W02"])
def test_all_reports_at_once_equal_each_alone(portfolio, week):
    specs, inputs, raw = portfolio
    rows = scoreboards(specs, inputs, week).collect()
    assert [r.report for r in rows] == sorted(r.report for r in rows)
    for spec in specs:
        expected = brute.board(*raw[spec.name], week, spec.segments, spec.excluded_unit)
        assert [tuple(r)[1:] for r in rows if r.report == spec.name] == expected


@pytest.mark.parametrize("week", ["2023-W19", "2026-W01"])
def test_metrics_of_all_reports_at_once_equal_each_alone(portfolio, week):
    specs, inputs, raw = portfolio
    rows = {r.report: tuple(r) for r in many.report_metrics(specs, inputs, week).collect()}
    assert rows["one"][2] == rows["all"][2] == len(raw["all"][0])
    for spec in specs:
        assert tuple(many.report_metrics([spec], inputs, week).first()) == rows[spec.name]


def test_only_what_a_report_keeps_is_grouped(portfolio):
    specs, inputs, _ = portfolio
    group = many.tally_groups(specs[:3], inputs, WEEK)[0]
    lines = activity_lines(group.specs, group.counted, counters=False)
    assert lines.filter("rows_kept IS NULL OR rows_kept = 0").count() == 0
    counters = activity_lines(group.specs, group.counted).filter("rows_read IS NOT NULL")
    assert {(r.report, r.unit_code) for r in counters.collect()} == {("kept", None)}


def test_one_tally_per_extract(portfolio):
    specs, inputs, _ = portfolio
    groups = many.tally_groups(specs, inputs, WEEK)
    assert [[s.name for s in g.specs] for g in groups] == [["kept", "all", "one"], ["other"], ["empty"]]


def test_cutoffs_of_reports_are_respected(make_spec, make_inputs):
    rows = [(dt.datetime(2023, 5, 14, 15),), (IN_WEEK,)]
    day = make_spec(name="day", excluded_unit=None)
    midnight = dataclasses.replace(day, name="midnight", cutoff="midnight")
    inputs = make_inputs(rows, T10)
    found = scoreboards([day, midnight], {"day": inputs, "midnight": inputs}, WEEK).collect()
    assert {(r.report, r.actual_ytd) for r in found} == {("day", 2), ("midnight", 1)}


def test_listing(spark, make_spec):
    specs = [make_spec(label="Activity"), make_spec(name="b", segments=(), source=Feed(database="d", dataset="t"))]
    assert [tuple(r) for r in many.listing(spark, specs).collect()] == [
        ("activity", "Activity", "*activity*.parquet", "*targets*.parquet", "Retail, Business"),
        ("b", "b", "d.t", "*targets*.parquet", "all"),
    ]
