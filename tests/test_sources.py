import datetime as dt

import pytest
from conftest import IN_WEEK

from tallyboard import ContractError, Feed, LandingError
from tallyboard.sources.datasets import choose, open_feed, read_file, strip_headers
from tallyboard.sources.extract import clean_extract, date_quality, refuse_unreadable_dates, rejected_values
from tallyboard.sources.targets import (
    clean_targets,
    duplicate_targets,
    refuse_duplicates,
    require_unique_targets,
)


def test_all_missing_columns_are_named(spark, make_spec):
    raw = spark.createDataFrame([(1, "x")], "`Opened on` int, `Regional unit` string")
    with pytest.raises(ContractError) as error:
        clean_extract(make_spec(), raw)
    message = str(error.value)
    assert "role 'unit': no column 'Unit code'" in message
    assert "role 'segment': no column 'Segment'" in message
    assert "['Opened on', 'Regional unit']" in message


def test_missing_target_column(spark, make_spec):
    raw = spark.createDataFrame([("U01", 1.0)], "`Unit code` string, `Start target` double")
    with pytest.raises(ContractError, match="role 'annual'"):
        clean_targets(make_spec(), raw)


def test_missing_measure_and_filter_columns(make_spec, make_extract):
    with pytest.raises(ContractError, match="role 'measure': no column 'Amount'"):
        clean_extract(make_spec(measure="Amount", measure_type="decimal(18,2)"), make_extract([]))
    with pytest.raises(ContractError, match="no column 'Kind'"):
        clean_extract(make_spec(filters={"Kind": ("A",)}), make_extract([]))


def test_headers_are_stripped_and_extra_columns_dropped(spark, make_spec):
    raw = spark.createDataFrame(
        [(IN_WEEK, " U01 ", "\tRetail", "note", 7)],
        "` Opened on` timestamp_ntz, `Unit code ` string, Segment string, Comment string, Reference int",
    )
    row = clean_extract(make_spec(), raw).first()
    assert row.asDict() == {
        "activity_date": IN_WEEK, "segment": "Retail", "unit_code": "U01", "date_unreadable": False,
    }


def test_colliding_headers_are_refused(spark):
    raw = spark.createDataFrame([(1, 2)], "`Unit` int, `Unit ` int")
    with pytest.raises(ContractError, match="Unit"):
        strip_headers(raw)


def test_unreadable_dates_become_null_and_are_counted(make_spec, make_extract):
    raw = make_extract([("2023-05-10",), ("10/05/2023",), ("2026-09-31",), ("soon",), (None,)], "string")
    extract = clean_extract(make_spec(), raw)
    assert [r.activity_date for r in extract.collect()] == [
        dt.datetime(2023, 5, 10), dt.datetime(2023, 5, 10), None, None, None,
    ]
    assert tuple(date_quality(extract).first()) == (4, 2, False)


def test_declared_formats_only(make_spec, make_extract):
    raw = make_extract([("10-2023-05",), ("2023-05-10",)], "string")
    extract = clean_extract(make_spec(date_formats=["dd-yyyy-MM"]), raw)
    assert [r.activity_date for r in extract.collect()] == [dt.datetime(2023, 5, 10), None]


def test_no_readable_date_at_all(make_spec, make_extract):
    spec, raw = make_spec(), make_extract([("abc",), ("def",), (None,)], "string")
    assert date_quality(clean_extract(spec, raw)).first().all_unreadable
    with pytest.raises(ContractError, match=r"\['abc', 'def'\]"):
        refuse_unreadable_dates(spec, raw)
    assert not date_quality(clean_extract(spec, make_extract([(None,)], "string"))).first().all_unreadable


def test_text_declared_trimmed_is_left_alone(make_spec, make_extract):
    extract = clean_extract(make_spec(text_is_trimmed=True), make_extract([(IN_WEEK, " U01")]))
    assert extract.first().unit_code == " U01"


def test_targets_are_cleaned(spark, make_spec):
    raw = spark.createDataFrame(
        [(" U01 ", "12", 3), ("U02", "n/a", None), (None, "5", 1), ("", "1", 1)],
        "`Unit code` string, `Start target` string, `Annual target` int",
    )
    rows = clean_targets(make_spec(), raw).collect()
    assert [tuple(r) for r in rows] == [("U01", 12.0, 3.0), ("U02", None, None), ("", 1.0, 1.0)]


def test_duplicate_targets_are_refused_after_trimming(spark, make_spec):
    raw = spark.createDataFrame(
        [("U02", 1.0, 1.0), (" U02", 1.0, 1.0), ("U01", 1.0, 1.0), ("U01", 1.0, 1.0), ("U03", 1.0, 1.0)],
        "`Unit code` string, `Start target` double, `Annual target` double",
    )
    targets = clean_targets(make_spec(), raw)
    assert [tuple(r) for r in duplicate_targets(targets).collect()] == [("U01", 2), ("U02", 2)]
    with pytest.raises(ContractError, match=r"\['U01', 'U02'\]"):
        require_unique_targets(make_spec(), targets)


def test_null_target_units_are_no_duplicates(spark, make_spec):
    raw = spark.createDataFrame(
        [(None, 1.0, 1.0), (None, 1.0, 1.0)],
        "`Unit code` string, `Start target` double, `Annual target` double",
    )
    require_unique_targets(make_spec(), clean_targets(make_spec(), raw))


def test_dataset_by_name_or_position():
    assert choose(["a", "b"], 1, "here") == "b"
    assert choose(["a", "b"], "a", "here") == "a"
    for wanted in (2, -1, "c"):
        with pytest.raises(ContractError, match=r"available: \['a', 'b'\]"):
            choose(["a", "b"], wanted, "here")


def test_catalog_feed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS deliveries")
    for name in ("north", "south"):
        spark.sql(f"CREATE OR REPLACE TEMP VIEW scratch AS SELECT '{name}' AS place")
        spark.table("scratch").write.mode("overwrite").saveAsTable(f"deliveries.{name}")
    assert open_feed(spark, Feed(database="deliveries"), None, "source").first().place == "north"
    by_name = Feed(database="deliveries", dataset="south")
    assert open_feed(spark, by_name, None, "source").first().place == "south"
    with pytest.raises(ContractError, match=r"no dataset 'west' in database deliveries"):
        open_feed(spark, Feed(database="deliveries", dataset="west"), None, "source")


def test_files_by_suffix(spark, tmp_path):
    (tmp_path / "a.CSV").write_text("Code,Value\n007, 1\n")
    frame = read_file(spark, str(tmp_path / "a.CSV"))
    assert dict(frame.dtypes) == {"Code": "string", "Value": "string"}
    assert frame.first().Code == "007"
    spark.range(3).write.orc(str(tmp_path / "b.orc"))
    assert read_file(spark, str(tmp_path / "b.orc")).count() == 3
    with pytest.raises(LandingError, match="expected a parquet"):
        read_file(spark, str(tmp_path / "c.xyz"))


def test_landing_feed_needs_a_folder(spark):
    with pytest.raises(LandingError, match="no landing folder"):
        open_feed(spark, Feed(pattern="*.csv"), None, "source")


AMOUNTS = [
    ("12.50", 12.5, None), (" 3 ", 3.0, None), ("1.234", None, "x"), ("n/a", None, "x"), ("", None, None),
    (" ", None, None), (None, None, None), ("1e400", None, "x"), ("99999999999999999999", None, "x"), ("-0", 0.0, None),
]


def amounts(spark, make_spec, policy):
    rows = [(IN_WEEK, "U01", "Retail", text) for text, *_ in AMOUNTS]
    raw = spark.createDataFrame(rows, "`Opened on` timestamp_ntz, `Unit code` string, Segment string, Amount string")
    return make_spec(measure="Amount", measure_type="decimal(18,2)", unreadable_amounts=policy), raw


def test_excluded_amounts_are_counted_and_named(spark, make_spec):
    spec, raw = amounts(spark, make_spec, "exclude")
    found = clean_extract(spec, raw).select("amount", "amount_unreadable").collect()
    assert [(None if r.amount is None else float(r.amount), r.amount_unreadable) for r in found] == [
        (value, bad == "x") for _, value, bad in AMOUNTS
    ]
    rejected = rejected_values(spec, raw).collect()
    assert sorted((r.unit_code, r.column, r.value, r.reason) for r in rejected) == sorted(
        ("U01", "Amount", text, "unreadable_amount") for text, _, bad in AMOUNTS if bad
    )


def test_refused_amounts_stop_the_job(spark, make_spec):
    spec, raw = amounts(spark, make_spec, "refuse")
    with pytest.raises(Exception, match="no decimal.18,2. in 'Amount'"):
        clean_extract(spec, raw).collect()
    assert rejected_values(spec, raw).count() == 4  # which ones, whatever the policy


def test_rejected_dates_and_amounts(spark, make_spec):
    raw = spark.createDataFrame(
        [("soon", "U1", "Retail", "n/a"), ("2023-05-10", "U2", " x ", "1"), (None, None, None, None)],
        "`Opened on` string, `Unit code` string, Segment string, Amount string",
    )
    spec = make_spec(measure="Amount", measure_type="double")
    assert {tuple(r) for r in rejected_values(spec, raw).collect()} == {
        ("Retail", "U1", "Amount", "n/a", "unreadable_amount"), ("Retail", "U1", "Opened on", "soon", "unreadable_date"),
    }
    typed = raw.withColumns({"Opened on": raw["Opened on"].try_cast("date"), "Amount": raw["Amount"].try_cast("int")})
    assert rejected_values(make_spec(measure="Amount"), typed).collect() == []


def test_duplicates_of_all_reports_in_one_table(spark, make_spec):
    rows = [("a", "U1"), ("a", "U1"), ("a", "U2"), ("b", "U1"), ("b", "U3"), ("b", "U3"), ("b", "U3")]
    targets = spark.createDataFrame(rows, "report string, unit_code string")
    found = duplicate_targets(targets, ["report"])
    assert [tuple(r) for r in found.collect()] == [("a", "U1", 2), ("b", "U3", 3)]
    with pytest.raises(ContractError, match="'a' hold several rows for: .'U1'.; .*'b' hold several rows for: .'U3'."):
        refuse_duplicates(found)
    refuse_duplicates(found.limit(0))
