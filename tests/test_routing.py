"""Reports as data: routing of rows, and plans that do not grow with the reports."""

import contextlib
import dataclasses
import datetime as dt
import io
import random
import re

import brute
import pytest
from conftest import IN_WEEK, WEEK

from tallyboard import RawInputs, scoreboards
from tallyboard.operators.filters import wanted_by_any, wanted_values
from tallyboard.operators.routing import by_report, with_keepers
from tallyboard.plans import many
from tallyboard.plans.backfill import backfill_reports

SEGMENTS = ["Retail", "Business", "Other", 'quo"te', "a,b", ""]


def keeps(spec, row):
    return all(row[column] in values for column, values in wanted_values(spec).items())


@pytest.fixture
def clean(spark):
    rng = random.Random(3)
    values = [*SEGMENTS, "unseen", None]
    rows = [(k, rng.choice(values), rng.choice(["A", "B", "C", None]), rng.choice(["x", None])) for k in range(300)]
    return spark.createDataFrame(rows, "id int, segment string, `filter_on_Kind` string, `filter_on_My.col` string").coalesce(2)


def some_specs(make_spec, count, seed=1):
    rng = random.Random(seed)
    return [
        make_spec(
            name=f"r{k}'\"{k}", segments=rng.sample(SEGMENTS, rng.choice([0, 1, 3])),
            filters={n: rng.sample(v, rng.choice([0, 1, len(v)])) for n, v in (("Kind", ["A", "B", "Z"]), ("My.col", ["x", "y"]))},
            excluded_unit=rng.choice([None, f"U{k % 9}"]), cutoff=rng.choice(["day", "midnight"]),
        )
        for k in range(count)
    ]


@pytest.mark.parametrize("count", [1, 2, 40])
def test_rows_go_to_the_reports_that_keep_them(make_spec, clean, count):
    specs = some_specs(make_spec, count)
    rows = clean.collect()
    expected = sorted((s.name, r.id) for s in specs for r in rows if keeps(s, r))
    assert sorted((r.report, r.id) for r in by_report(specs, clean).collect()) == expected
    sets = {r.id: sorted(r.keepers) for r in with_keepers(specs, clean).collect()}
    assert len(sets) == len(rows)  # no row is lost, kept by none or not
    assert sum(map(len, sets.values())) == len(expected)
    possible = {r.id for r in wanted_by_any(specs, clean).collect()}
    assert {key for _, key in expected} <= possible
    if count == 1:
        assert {key for _, key in expected} == possible


def test_reports_without_lists_keep_everything(make_spec, clean):
    specs = [make_spec(name=n, segments=()) for n in "ab"]
    assert by_report(specs, clean).count() == 600


def shape(frame):
    """Lines of the physical plan and length of its operators, literals aside."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return [re.sub(r"#\d+L?|plan_id=\d+|\[[^\]]*\]", "", line).split("(")[0].rstrip() for line in text.getvalue().splitlines()]


@pytest.fixture
def portfolio(spark, make_spec, make_targets):
    rng = random.Random(9)
    first, last = dt.datetime(2023, 1, 1), dt.datetime(2023, 6, 1)
    rows, targets = brute.random_case(rng, first, last, 300)
    kinds = [rng.choice(["A", "B", "C"]) for _ in rows]
    raw = spark.createDataFrame(
        [(m, u, s, k, "x") for (m, u, s), k in zip(rows, kinds)],
        "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Kind string, `My.col` string",
    )
    inputs = RawInputs(raw, make_targets(targets))

    def build(count):
        specs = some_specs(make_spec, count)
        return specs, {s.name: inputs for s in specs}

    return build, rows, kinds, targets


PLANS = {
    "boards": lambda specs, inputs: scoreboards(specs, inputs, WEEK),
    "warnings": lambda specs, inputs: many.report_warnings(specs, inputs, WEEK),
    "metrics": lambda specs, inputs: many.report_metrics(specs, inputs, WEEK),
    "backfill": lambda specs, inputs: backfill_reports(specs, inputs, "2023-W17", WEEK),
}


@pytest.mark.parametrize("name", list(PLANS))
def test_plans_do_not_grow_with_the_reports(spark, portfolio, name):
    build, *_ = portfolio
    few, several = (PLANS[name](*build(count)) for count in (60, 500))
    assert shape(few) == shape(several)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        found = several.collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    if name != "warnings":
        assert len({r.report for r in found}) == 500


def test_many_reports_equal_each_alone(portfolio):
    build, rows, kinds, targets = portfolio
    specs, inputs = build(30)
    found = {}
    for row in scoreboards(specs, inputs, WEEK).collect():
        found.setdefault(row.report, []).append(tuple(row)[1:])
    for spec in specs:
        wanted = spec.filters
        own = [
            r for r, kind in zip(rows, kinds)
            if (not wanted["Kind"] or kind in wanted["Kind"]) and (not wanted["My.col"] or "x" in wanted["My.col"])
        ]
        assert found[spec.name] == brute.board(own, targets, WEEK, spec.segments, spec.excluded_unit, spec.cutoff)


def test_shared_targets_are_read_once(spark, tmp_path, make_spec, make_extract):
    path = str(tmp_path / "goals")
    spark.createDataFrame([("U01", 1.0, 2.0)], "`Unit code` string, `Start target` double, `Annual target` double").write.parquet(path)
    inputs = RawInputs(make_extract([(IN_WEEK,)]), spark.read.parquet(path))
    specs = [make_spec(name=f"r{k}", excluded_unit="U01") for k in range(5)]
    assert len(many.targets_by_report(specs, {s.name: inputs for s in specs}).collect()) == 5
    frame = many.report_warnings(specs, {s.name: inputs for s in specs}, WEEK)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    assert text.getvalue().count("/goals]") == 1


def test_both_cutoffs_share_the_scan(make_spec, make_inputs):
    specs = [make_spec(name="day"), make_spec(name="midnight", cutoff="midnight")]
    inputs = make_inputs([(IN_WEEK,), (dt.datetime(2023, 5, 14, 9),), (dt.datetime(2023, 5, 15),)], {"U01": (1.0, 1.0)})
    groups = many.tally_groups(specs, {s.name: inputs for s in specs}, WEEK)
    assert [len(g.specs) for g in groups] == [2]
    found = {(r.report, r.subject): r.n for r in many.report_warnings(specs, {s.name: inputs for s in specs}, WEEK).filter("code = 'later_rows'").collect()}
    assert found == {("day", "2023-05-14"): 1, ("midnight", "2023-05-14"): 2}
    assert dataclasses.replace(specs[0], cutoff="midnight").extract_key == specs[0].extract_key
