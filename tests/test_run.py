import datetime as dt
import uuid
from pathlib import Path

import pytest
from conftest import AFTER, EARLIER, IN_WEEK, WEEK

from tallyboard import (
    ContractError,
    Feed,
    LandingError,
    PublishError,
    PublishRule,
    RawInputs,
    ReportBook,
    SpecError,
    WeekError,
    run,
)
from tallyboard.sinks.scratch import Scratch

ROWS = [(EARLIER, "U01")] * 3 + [(IN_WEEK, "U99", "Business"), (AFTER, "U01")]
TARGETS = {"U01": (2.0, 8.0), "U99": (1.0, 4.0)}


@pytest.fixture
def inputs(make_inputs):
    return {"activity": make_inputs(ROWS, TARGETS), "churn": make_inputs(ROWS[:2], TARGETS)}


@pytest.fixture
def book(make_spec):
    return ReportBook([make_spec(), make_spec(name="churn", segments=(), source=Feed(pattern="churn"))])


def stored(spark, out, name):
    return spark.read.parquet(f"{out}/{name}")


def test_outputs_of_a_run(spark, book, inputs, tmp_path):
    out = str(tmp_path)
    outcome = run(spark, book, out, week=WEEK, inputs=inputs, keep_detail=True)
    assert outcome.reports == ("activity", "churn") and outcome.week == WEEK
    shown = [(r.report, r.unit_code, r.actual_ytd) for r in outcome.scoreboard.collect()]
    assert shown == [
        ("activity", "U01", 3), ("activity", "U99", 1), ("activity", "All units", 4),
        ("activity", "All units except U99", 3),
        ("churn", "U01", 2), ("churn", "U99", 0), ("churn", "All units", 2),
        ("churn", "All units except U99", 2),
    ]
    kept = stored(spark, out, "scoreboard")
    assert {(r.week, r.report, r.unit_code, r.actual_ytd) for r in kept.collect()} == {
        (WEEK, *line) for line in shown
    }
    assert {(r.report, r.code, r.n) for r in stored(spark, out, "warnings").collect()} == {
        ("activity", "later_rows", 1)
    }
    assert {(r.report, r.rows_read) for r in stored(spark, out, "run_metrics").collect()} == {
        ("activity", 5), ("churn", 2),
    }
    assert stored(spark, out, "detail").groupBy("report").count().collect()
    assert outcome.metrics.count() == 2 and outcome.published is None


def test_running_again_changes_nothing(spark, book, inputs, make_inputs, tmp_path):
    out = str(tmp_path)
    run(spark, book, out, week=WEEK, inputs=inputs)
    first = sorted(map(tuple, stored(spark, out, "scoreboard").collect()), key=str)
    run(spark, book, out, week=WEEK, inputs=inputs)
    assert sorted(map(tuple, stored(spark, out, "scoreboard").collect()), key=str) == first
    # One report alone, on a corrected delivery without later rows.
    fixed = {"activity": make_inputs(ROWS[:-1], TARGETS)}
    outcome = run(spark, book, out, week=WEEK, names=["activity"], inputs=fixed)
    assert outcome.reports == ("activity",)
    assert stored(spark, out, "warnings").count() == 0
    assert sorted(map(tuple, stored(spark, out, "scoreboard").collect()), key=str) == first


def test_current_week_by_default(spark, book, inputs, tmp_path):
    outcome = run(spark, book, str(tmp_path), inputs=inputs, today=dt.date(2026, 3, 13))
    assert outcome.week == "2026-W11"


def test_names_and_week_are_checked_before_anything_runs(spark, book, tmp_path):
    with pytest.raises(SpecError, match="unknown report 'sales'"):
        run(spark, book, str(tmp_path), week=WEEK, names=["activity", "sales"], inputs={})
    with pytest.raises(WeekError):
        run(spark, book, str(tmp_path), week="2026-W99", inputs={})
    assert list(tmp_path.iterdir()) == []


def test_bad_deliveries_write_nothing(spark, book, inputs, make_extract, make_targets, tmp_path):
    twice = make_targets(TARGETS).unionAll(make_targets(TARGETS))
    bad = {**inputs, "churn": RawInputs(inputs["churn"].extract, twice)}
    with pytest.raises(ContractError, match="several rows"):
        run(spark, book, str(tmp_path), week=WEEK, inputs=bad)
    unreadable = make_extract([("soon",), ("later",)], "string")
    bad = {**inputs, "churn": RawInputs(unreadable, inputs["churn"].targets)}
    with pytest.raises(ContractError, match="is a date, first values"):
        run(spark, book, str(tmp_path), week=WEEK, inputs=bad)
    assert not (tmp_path / "scoreboard").exists()


def test_offending_targets_and_rejected_values_are_written(spark, book, inputs, make_extract, make_targets, tmp_path):
    out = str(tmp_path)
    twice = make_targets(TARGETS).unionAll(make_targets(TARGETS))
    with pytest.raises(ContractError, match="'churn' hold several rows"):
        run(spark, book, out, week=WEEK, inputs={**inputs, "churn": RawInputs(inputs["churn"].extract, twice)})
    offenders = stored(spark, out, "duplicate_targets").collect()
    assert {(r.report, r.unit_code, r.target_rows) for r in offenders} == {("churn", unit, 2) for unit in TARGETS}

    mixed = make_extract([("2023-05-10",), ("soon", "U02")], "string")
    read = {**inputs, "churn": RawInputs(mixed, inputs["churn"].targets)}
    run(spark, book, out, week=WEEK, inputs=read, keep_rejected=True)
    rejected = stored(spark, out, "rejected").collect()
    assert [(r.report, r.unit_code, r.value, r.reason) for r in rejected] == [("churn", "U02", "soon", "unreadable_date")]
    run(spark, book, out, week=WEEK, inputs=inputs, keep_rejected=True)
    assert stored(spark, out, "rejected").count() == 0


def test_from_landing_folder_to_published_tables(spark, make_spec, make_extract, make_targets, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    make_extract(ROWS).toPandas().to_parquet(
        landing / "Activity_2026.parquet", coerce_timestamps="us"
    )
    make_targets(TARGETS).toPandas().to_csv(landing / "targets_2026.csv", index=False)
    spec = make_spec(targets=Feed(pattern="*targets*.csv"))
    book = ReportBook(
        [spec], [PublishRule("goals", "targets", "activity"), PublishRule("gone", "detail", "activity")]
    )
    spark.sql("DROP DATABASE IF EXISTS weekly CASCADE")
    spark.sql("CREATE DATABASE weekly")
    spark.sql("CREATE TABLE weekly.goals (unit string, start double, annual double) USING parquet")
    outcome = run(spark, book, out, week=WEEK, landing=str(landing), destination="weekly")
    assert outcome.published.rows == 2 and len(outcome.published.warnings) == 1
    assert spark.table("weekly.goals").count() == 2
    with pytest.raises(LandingError, match="no source file matches"):
        run(spark, ReportBook([make_spec(source=Feed(pattern="x*"))]), out, WEEK, landing=str(landing))


def test_destination_may_not_be_an_input(spark, make_spec, inputs, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS incoming")
    spec = make_spec(source=Feed(database="incoming", dataset="t"))
    with pytest.raises(PublishError, match="read from"):
        run(spark, ReportBook([spec]), str(tmp_path), WEEK, inputs=inputs, destination="incoming")


def test_what_readers_see_is_written_too(spark, book, inputs, make_inputs, tmp_path):
    out = str(tmp_path)
    run(spark, book, out, week=WEEK, inputs=inputs)
    display = {(r.report, r.unit_code): r.actual_ytd for r in stored(spark, out, "display").collect()}
    assert display["activity", "U01"] == "3" and display["churn", "All units"] == "2"
    cards = stored(spark, out, "cards").groupBy("report").count().collect()
    assert {tuple(r) for r in cards} == {("activity", 4), ("churn", 4)}
    bars = [(r.report, r.unit_code) for r in stored(spark, out, "chart").collect()]
    assert sorted(bars) == [("activity", "U01"), ("activity", "U99"), ("churn", "U01"), ("churn", "U99")]
    assert stored(spark, out, "segments").count() == 0
    # A later delivery without one of the requested segments, and without targets.
    bare = {"activity": make_inputs([(EARLIER, "U01"), (EARLIER, "U01", "Odd")], {})}
    run(spark, book, out, week=WEEK, names=["activity"], inputs=bare)
    segments = stored(spark, out, "segments").collect()
    assert {(r.report, r.segment, r.status) for r in segments} == {
        ("activity", "Retail", "kept"), ("activity", "Odd", "ignored"), ("activity", "Business", "unknown"),
    }
    assert {r.report for r in stored(spark, out, "chart").collect()} == {"churn"}


def test_nothing_of_a_run_is_left_but_its_results(spark, book, inputs, make_targets, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    run(spark, book, str(tmp_path), week=WEEK, inputs=inputs, keep_detail=True)
    assert {p.name for p in tmp_path.iterdir()} == {
        "scoreboard", "run_metrics", "warnings", "segments", "display", "cards", "chart", "detail",
    }
    assert spark.sparkContext.getCheckpointDir() == before
    unreadable = {**inputs, "churn": RawInputs(
        spark.createDataFrame([("soon", "U01", "Retail")], "`Opened on` string, `Unit code` string, Segment string"),
        make_targets(TARGETS),
    )}
    with pytest.raises(ContractError, match="is a date, first values"):
        run(spark, book, str(tmp_path / "failed"), week=WEEK, inputs=unreadable)
    assert not list((tmp_path / "failed").glob("*"))
    shared = Path(Scratch(spark, str(tmp_path)).path).parent
    assert not list(shared.glob("_run-*"))


def test_details_of_all_reports_take_one_scan(spark, make_spec, make_extract, make_targets, tmp_path):
    log = tmp_path / "scans"
    log.mkdir()

    def watched(batches):
        (log / uuid.uuid4().hex).touch()
        yield from batches

    rows = [*ROWS, (EARLIER, "U07", "Odd"), (IN_WEEK, None)]
    raw = make_extract(rows).coalesce(1)
    raw = raw.mapInPandas(watched, raw.schema)
    specs = [
        make_spec(name="001"),
        make_spec(name="all", segments=(), excluded_unit=None),
        make_spec(name="none", segments=("Nowhere",), excluded_unit=None),
    ]
    inputs = {s.name: RawInputs(raw, make_targets(TARGETS)) for s in specs}
    spark.sql("DROP DATABASE IF EXISTS details CASCADE")
    spark.sql("CREATE DATABASE details")
    spark.sql("CREATE TABLE details.rows (d timestamp_ntz, s string, u string) USING parquet")
    out = str(tmp_path / "out")
    rules = [PublishRule("rows", "detail", "all")]
    outcome = run(
        spark, ReportBook(specs, rules), out, week=WEEK, inputs=inputs, destination="details", keep_detail=True
    )
    # The tally, the details, and the segments present next to the one that is not there.
    assert len(list(log.iterdir())) == 3
    kept = spark.read.schema("report string, week string, unit_code string").parquet(f"{out}/detail")
    assert {tuple(r) for r in kept.groupBy("report").count().collect()} == {("001", 5), ("all", 6)}
    assert outcome.published.rows == 6 and spark.table("details.rows").count() == 6
    assert {r.report for r in outcome.scoreboard.collect()} == {"001", "all", "none"}
    # Nothing is left of a report that has no row any more.
    run(spark, ReportBook(specs), out, week=WEEK, names=["001"], keep_detail=True,
        inputs={"001": RawInputs(make_extract([(AFTER,)]), make_targets(TARGETS))})
    kept = spark.read.schema("report string, week string, unit_code string").parquet(f"{out}/detail")
    assert {tuple(r) for r in kept.groupBy("report").count().collect()} == {("all", 6)}
