"""What must never be lost or counted twice between a delivery and a board."""

import datetime as dt

import pytest
from conftest import IN_WEEK, WEEK

from tallyboard import Feed, RawInputs, ReportBook
from tallyboard.errors import ContractError, SpecError
from tallyboard.plans.many import scoreboards
from tallyboard.sources.datasets import read_file
from tallyboard.sources.extract import clean_extract
from tallyboard.sources.landing import newest_file


def test_equal_declarations_of_different_data_stay_apart(make_spec, make_extract, make_targets):
    one, two = make_spec(name="one"), make_spec(name="two")
    assert one.extract_key == two.extract_key
    goals = make_targets({"U01": (1.0, 2.0)})
    inputs = {
        "one": RawInputs(make_extract([(IN_WEEK, "U01", "Retail")] * 3), goals),
        "two": RawInputs(make_extract([(IN_WEEK, "U01", "Retail")] * 8), goals),
    }
    rows = scoreboards([one, two], inputs, WEEK).where("unit_code = 'U01'").collect()
    assert {r.report: r.actual_week for r in rows} == {"one": 3, "two": 8}


def test_a_report_named_twice_counts_once(make_spec, make_extract, make_targets):
    spec = make_spec(name="one")
    assert ReportBook([spec]).select(["one", "one"]) == [spec]
    inputs = {"one": RawInputs(make_extract([]), make_targets({}))}
    with pytest.raises(SpecError, match="more than once"):
        scoreboards([spec, spec], inputs, WEEK)


def test_dates_with_any_white_space_and_iso_times(spark, make_spec):
    texts = ["\t2023-05-10", "\u00a02023-05-10 ", "2023-05-10T07:08:09", "2023-05-10 07:08:09.123", "2023-05-10T07:08:09.123456"]
    spec = make_spec()
    names = [spec.source_columns[r] for r in ("date", "segment", "unit")]
    raw = spark.createDataFrame([(t, "Retail", "U01") for t in texts], names)
    got = clean_extract(spec, raw).collect()
    assert [r.activity_date.date() for r in got] == [dt.date(2023, 5, 10)] * 5 and not any(r.date_unreadable for r in got)


@pytest.mark.parametrize("bad", ["12.345", "abc", "1,50", "100000000000000000.00"])
def test_an_amount_is_never_dropped_or_rounded(spark, make_spec, bad):
    spec = make_spec(measure="Amount", measure_type="decimal(18,2)")
    names = [*(spec.source_columns[r] for r in ("date", "segment", "unit")), "Amount"]
    good = spark.createDataFrame([(IN_WEEK, "Retail", "U01", x) for x in (" 5 ", "2.25", None, "")], names)
    assert [None if r.amount is None else float(r.amount) for r in clean_extract(spec, good).collect()] == [5.0, 2.25, None, None]
    with pytest.raises(Exception, match="no decimal"):
        clean_extract(spec, good.union(spark.createDataFrame([(IN_WEEK, "Retail", "U01", bad)], good.schema))).collect()


def test_text_amounts_need_a_type_and_numbers_keep_theirs(spark, make_spec):
    spec = make_spec(measure="Amount")
    names = [*(spec.source_columns[r] for r in ("date", "segment", "unit")), "Amount"]
    with pytest.raises(ContractError, match="measure_type"):
        clean_extract(spec, spark.createDataFrame([(IN_WEEK, "Retail", "U01", "1")], names))
    assert clean_extract(spec, spark.createDataFrame([(IN_WEEK, "Retail", "U01", 12.345)], names)).first().amount == 12.345


def test_the_chosen_file_is_the_one_that_is_read(spark, tmp_path):
    (tmp_path / "cases [1].csv").write_text("a;b\n1;\"x\ny\"\n")
    (tmp_path / "cases 1.csv").write_text("a;b\n9;z\n")
    (tmp_path / "{c}.csv").write_text("a;b\n5;w\n")
    for name, row in (("cases [[]1].csv", ("1", "x\ny")), ("cases 1.csv", ("9", "z")), ("{c}.csv", ("5", "w"))):
        path = newest_file(spark, str(tmp_path), name)
        # Spark's reader of records over several lines expands braces of its own accord.
        feed = Feed(pattern="*.csv", delimiter=";", multiline="{" not in name)
        assert [tuple(r) for r in read_file(spark, path, feed).collect()] == [row]
