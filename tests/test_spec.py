import pytest

from tallyboard import Feed, PublishRule, ReportBook, SpecError


def test_defaults(make_spec):
    spec = make_spec(segments=[], excluded_unit="  ")
    assert spec.label == "activity"
    assert spec.segments == ()
    assert spec.excluded_unit is None
    assert spec.measure is None and spec.cutoff == "day"


def test_configured_values_are_not_stripped(make_spec):
    assert make_spec(segments=[" Retail"]).segments == (" Retail",)


def test_all_missing_roles_are_named(make_spec):
    with pytest.raises(SpecError, match=r"missing \['segment', 'unit'\]"):
        make_spec(source_columns={"date": "Opened on", "segment": ""})
    with pytest.raises(SpecError, match="target_columns"):
        make_spec(target_columns={"unit": "Unit code"})


@pytest.mark.parametrize("change", [{"name": ""}, {"source": None}, {"targets": None}, {"cutoff": "noon"}])
def test_mandatory_fields(make_spec, change):
    with pytest.raises(SpecError):
        make_spec(**change)


def test_lists_given_as_text_are_refused(make_spec):
    with pytest.raises(SpecError, match="lists"):
        make_spec(segments="Retail")
    with pytest.raises(SpecError, match="lists"):
        make_spec(filters={"Kind": "A"})


def test_a_feed_has_one_origin():
    with pytest.raises(SpecError):
        Feed()
    with pytest.raises(SpecError):
        Feed(pattern="*.csv", database="sales")


def test_book_selects_by_name(make_spec):
    book = ReportBook([make_spec(), make_spec(name="churn")])
    assert book.names == ["activity", "churn"]
    assert [s.name for s in book.select()] == ["activity", "churn"]
    assert [s.name for s in book.select(["churn"])] == ["churn"]
    with pytest.raises(SpecError, match="unknown report 'sales', declared reports: activity, churn"):
        book.select(["churn", "sales"])


def test_book_rules(make_spec):
    with pytest.raises(SpecError, match="no report"):
        ReportBook([])
    with pytest.raises(SpecError, match="activity"):
        ReportBook([make_spec(), make_spec()])


def test_publish_rules(make_spec):
    with pytest.raises(SpecError, match="unknown block 'summary'"):
        PublishRule("board", "summary", "activity")
    with pytest.raises(SpecError, match="target"):
        PublishRule("", "detail", "activity")
    with pytest.raises(SpecError, match="unknown report 'sales'"):
        ReportBook([make_spec()], [PublishRule("board", "detail", "sales")])
    with pytest.raises(SpecError, match="same target"):
        ReportBook(
            [make_spec()],
            [PublishRule("Board", "detail", "activity"), PublishRule("board", "targets", "activity")],
        )


def test_reports_that_differ_by_what_they_keep_share_an_extract(make_spec):
    base = make_spec()
    assert base.extract_key == make_spec(name="b", segments=(), excluded_unit=None).extract_key
    assert base.extract_key == make_spec(name="b", filters={"Kind": ("A",)}).extract_key
    assert base.extract_key == make_spec(name="b", cutoff="midnight").extract_key
    assert base.extract_key != make_spec(name="b", measure="Amount", measure_type="decimal(18,2)").extract_key


def test_every_violation_of_a_declaration_is_named(make_spec):
    with pytest.raises(SpecError) as failure:
        make_spec(name="", targets=None, source_columns={"unit": "U"}, segments="Retail", cutoff="noon")
    for part in ("name", "targets", r"['date', 'segment']", "lists", "noon"):
        assert part in str(failure.value)
    with pytest.raises(SpecError) as failure:
        PublishRule("", "summary", "")
    for part in ("target", "summary", "report"):
        assert part in str(failure.value)


def test_every_violation_of_a_book_is_named(make_spec):
    rules = [PublishRule("board", "detail", "sales"), PublishRule("Board", "targets", "stock")]
    with pytest.raises(SpecError) as failure:
        ReportBook([make_spec(), make_spec()], rules)
    for part in ("['activity']", "'sales'", "'stock'", "['board']"):
        assert part in str(failure.value)
    with pytest.raises(SpecError, match="'x'.*'y'"):
        ReportBook([make_spec()]).select(["x", "activity", "y"])


def test_amount_policies(make_spec):
    assert make_spec().unreadable_amounts == "refuse"
    with pytest.raises(SpecError, match="unreadable_amounts"):
        make_spec(unreadable_amounts="ignore")
