"""The shape of the physical plans, which decides how a job scales."""

import contextlib
import io
import re

import pytest

from conftest import IN_WEEK, WEEK

from showcase import datasets as d
from showcase.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def executed(frame):
    """The plan that really ran, after adaptive execution."""
    frame.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    plan = text.getvalue().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    return plan


def scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


def test_scoreboard_reads_its_extract_once(spark):
    plan = executed(QUERIES["scoreboard"](spark, FOLDER))
    assert scans(plan, "orders") == 1
    assert "ReusedExchange" in plan


def test_period_and_columns_reach_the_scan(spark):
    plan = executed(QUERIES["volumes"](spark, FOLDER))
    scan = re.search(r"FileScan parquet [^\n]*/orders\.parquet[^\n]*", plan).group()
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in scan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in scan
    segments = re.search(r"FileScan parquet [^\n]*/customer\.parquet[^\n]*", plan).group()
    assert "In(c_mktsegment, [BUILDING,MACHINERY])" in segments


def test_counting_starts_before_the_shuffle(spark):
    plan = executed(QUERIES["volumes"](spark, FOLDER))
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_boards_reduced_to_units_compute_no_totals(spark):
    plan = executed(QUERIES["unit_rows"](spark, FOLDER))
    assert "SinglePartition" not in plan
    assert scans(plan, "orders") == 1


def test_ranks_are_counted_in_parts(spark):
    """The extract is read when the bars are written; a rank is a position in a
    part and the rows of the parts before."""
    plan = executed(QUERIES["chart_series"](spark, "/root/testdata/sf0.01"))
    assert scans(plan, "orders") == 0
    positions = re.findall(r"\bWindow \[row_number\(\)[^\n]*", plan)
    assert positions and all("[part#" in p for p in positions)


def test_boards_need_no_join(spark, make_spec, make_extract, make_targets):
    """Activity and targets meet in one aggregation; totals add up its rows."""
    from tallyboard import scoreboard
    from tallyboard.sources.extract import clean_extract
    from tallyboard.sources.targets import clean_targets

    spec = make_spec()
    extract = clean_extract(spec, make_extract([(IN_WEEK, f"U{k}") for k in range(50)]))
    plan = executed(scoreboard(spec, extract, clean_targets(spec, make_targets({"U1": (1.0, 1.0)})), WEEK))
    assert "Join" not in plan and "SortAggregate" not in plan
    assert len(re.findall(r"\bSort \[", plan)) <= 1
    assert len(re.findall(r"(?<!, )Exchange hashpartitioning", plan)) == 1 and "ReusedExchange" in plan


def test_both_cutoffs_read_the_extract_once(spark):
    plan = executed(QUERIES["events_cutoff"](spark, FOLDER))
    assert scans(plan, "events") == 2  # once as the extract, once to derive the targets of its units


def test_targets_are_read_once(spark):
    # As part of both extracts of orders that need it, and as targets.
    assert scans(executed(QUERIES["warnings"](spark, FOLDER)), "nation") <= 3


def test_many_reports_share_one_scan(spark):
    plan = executed(QUERIES["multi_report"](spark, FOLDER))
    assert scans(plan, "orders") == 1 and scans(plan, "events") == 1


def test_warnings_read_each_extract_once(spark):
    # The tidy and the dirty orders are two different extracts; events also
    # serve to derive the targets of their units.
    plan = executed(QUERIES["warnings"](spark, FOLDER))
    assert scans(plan, "orders") == 2 and scans(plan, "events") == 2


@pytest.mark.parametrize("name", ["backfill_weeks", "backfill_reports"])
def test_backfill_reads_its_extract_once(spark, name):
    plan = executed(QUERIES[name](spark, FOLDER))
    assert scans(plan, "orders") == 1


@pytest.mark.parametrize("name", ["backfill_weeks", "backfill_events", "backfill_sum", "backfill_reports"])
def test_backfill_totals_come_from_entries(spark, name):
    """Units and totals take their running sums and spell out their weeks together."""
    plan = executed(QUERIES[name](spark, FOLDER))
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    assert len(re.findall(r"Generate explode\(sequence", plan)) == 1
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan


def test_backfill_pushes_period_and_segments(spark):
    plan = executed(QUERIES["backfill_weeks"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1994-01-01" in plan
    assert "In(c_mktsegment, [BUILDING,MACHINERY])" in plan


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_window_over_everything(spark, name):
    plan = executed(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # A single partition may only receive partial sums.
    for block in plan.split("Exchange SinglePartition")[1:]:
        assert re.match(r"[^\n]*\n[^\n]*(Aggregate|ShuffleQueryStage|AQEShuffleRead)", block), name
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["extract_clean", "retained_detail", "date_quality"])
def test_text_dates_are_read_once(spark, name):
    plan = executed(QUERIES[name](spark, FOLDER))
    assert len(re.findall(r"try_cast\(concat\(", plan)) == 1
    assert plan.count("translate(") == 1  # one look at the layout of a text
    generator = re.search(r"Generate inline\(array\(struct\([^\n]*", plan).group()
    assert "concat" not in generator


@pytest.mark.parametrize("name", list(QUERIES))
def test_code_is_generated_for_whole_stages(spark, name):
    """No stage is interpreted because its code grows too large to compile."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        QUERIES[name](spark, FOLDER).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_opening_a_table_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("opening", "opening")
    for name in d.SCHEMAS:
        d.table(spark, FOLDER, name)
    assert len(tracker.getJobIdsForGroup("opening")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_declared_schemas_match_the_files(spark):
    for name in d.SCHEMAS:
        declared = d.table(spark, FOLDER, name).dtypes
        assert declared == spark.read.parquet(f"{FOLDER}/{name}.parquet").dtypes
