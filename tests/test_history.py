import contextlib
import datetime as dt
import io
import random
import time

import brute
import pytest

from tallyboard import Feed, RawInputs
from tallyboard.plans.backfill import backfill_reports
from tallyboard.plans.history import History, backfill_kept, daily_totals, delivery_of
from tallyboard.sources.extract import clean_extract

SPAN = ("2025-W50", "2026-W04")


def lines(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def plan_of(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


@pytest.fixture
def delivered(spark, make_spec, make_targets, tmp_path):
    """Four reports over one delivered file, with both cut-offs, and a way to
    deliver it anew."""
    path = str(tmp_path / "activity.parquet")

    def deliver(seed, size=300):
        rng = random.Random(seed)
        rows, targets = brute.random_case(rng, dt.datetime(2025, 11, 1), dt.datetime(2026, 2, 10), size)
        raw = spark.createDataFrame(rows, "`Opened on` timestamp_ntz, `Unit code` string, Segment string")
        raw.coalesce(1).write.mode("overwrite").parquet(path)
        return RawInputs(spark.read.parquet(path), make_targets(targets))

    specs = [
        make_spec(excluded_unit="U1"),
        make_spec(name="b", segments=(), cutoff="midnight"),
        make_spec(name="c", segments=("Retail", "Other"), excluded_unit="U77"),
        make_spec(name="d", segments=("Nothing",), excluded_unit="U8", cutoff="midnight"),
    ]
    return specs, deliver, History(spark, str(tmp_path / "history"))


def test_kept_totals_serve_weeks_and_backfills(delivered, tmp_path):
    specs, deliver, history = delivered
    inputs = dict.fromkeys([s.name for s in specs], deliver(1))
    expected = lines(backfill_reports(specs, inputs, *SPAN))
    assert lines(backfill_kept(specs, inputs, *SPAN, history)) == expected
    again = backfill_kept(specs, inputs, *SPAN, history)
    assert "activity.parquet" not in plan_of(again)  # the extract is not read
    assert lines(again) == expected
    one = backfill_kept(specs, inputs, SPAN[1], SPAN[1], history)
    assert lines(one) == lines(backfill_reports(specs, inputs, SPAN[1], SPAN[1]))


def test_a_newer_delivery_replaces_the_totals(delivered, tmp_path):
    specs, deliver, history = delivered
    inputs = dict.fromkeys([s.name for s in specs], deliver(1))
    backfill_kept(specs, inputs, *SPAN, history).collect()
    before = delivery_of(inputs["b"].extract)
    time.sleep(0.01)
    newer = dict.fromkeys([s.name for s in specs], deliver(2, 200))
    assert delivery_of(newer["b"].extract) != before
    assert lines(backfill_kept(specs, newer, *SPAN, history)) == lines(backfill_reports(specs, newer, *SPAN))
    kept = [p for p in (tmp_path / "history").glob("*/*") if p.is_dir()]
    assert len(kept) == 1


def test_other_lists_and_extracts_are_counted_apart(spark, delivered, make_spec, tmp_path):
    specs, deliver, history = delivered
    inputs = deliver(3)
    for own in ([specs[0]], [specs[2]], [make_spec(name="x", segments=(), source=Feed(pattern="other"))]):
        read = {s.name: inputs for s in own}
        assert lines(backfill_kept(own, read, *SPAN, history)) == lines(backfill_reports(own, read, *SPAN))
    assert len([p for p in (tmp_path / "history").glob("*/*") if p.is_dir()]) == 3


def test_extracts_that_are_no_files_need_a_name(delivered, make_inputs):
    specs, _, history = delivered
    first = {specs[0].name: make_inputs([(dt.datetime(2026, 1, 7), "U1")], {})}
    second = {specs[0].name: make_inputs([(dt.datetime(2026, 1, 7), "U1")] * 2, {})}
    own = [specs[0]]

    def ytd(inputs, name):
        found = backfill_kept(own, inputs, "2026-W02", "2026-W02", history, {own[0].name: name})
        return found.filter("unit_code = 'U1'").first().actual_ytd

    assert [ytd(first, "a"), ytd(second, "a"), ytd(second, "b")] == [1, 1, 2]  # known by its name alone


def test_totals_add_up(spark, make_spec):
    raw = spark.createDataFrame(
        [(dt.datetime(2026, 1, 4, h), "U1", "Retail", a) for h, a in ((0, 1.5), (9, 2.0), (10, None))] + [(None, "U1", "Retail", 1.0), (dt.datetime(2026, 1, 4), None, None, 1.0)],
        "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Amount double",
    )
    spec = make_spec(measure="Amount", measure_type="decimal(18,2)")
    found = daily_totals([spec], clean_extract(spec, raw)).collect()
    assert sorted((r.after_midnight, float(r.measured), r.row_count) for r in found) == [(False, 1.5, 1), (True, 2.0, 2)]
