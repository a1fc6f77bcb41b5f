import hashlib
import logging
import os

import pytest

from tallyboard import Feed, LandingError
from tallyboard.sources import integrity, landing


@pytest.fixture
def folder(tmp_path):
    def put(name, age=0, content="x"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
        stamp = 1_700_000_000 - age
        os.utime(path, (stamp, stamp))
        return path

    put.path = str(tmp_path)
    return put


def found(spark, folder, pattern="*activity*.csv"):
    return landing.newest_file(spark, folder.path, pattern, "source").rsplit("/", 1)[-1]


def test_newest_match_wins_with_a_warning(spark, folder, caplog):
    folder("activity_1.csv", age=50)
    folder("activity_2.csv", age=10)
    folder("activity_3.csv", age=90)
    folder("targets.csv")
    with caplog.at_level(logging.WARNING):
        assert found(spark, folder) == "activity_2.csv"
    assert "3 source files match" in caplog.text
    names = [r.name for r in landing.matching_files(spark, folder.path, "*activity*").collect()]
    assert names == ["activity_2.csv", "activity_1.csv", "activity_3.csv"]


def test_case_does_not_matter(spark, folder):
    folder("ACTIVITY March.Csv")
    assert found(spark, folder, "*Activity*.csv") == "ACTIVITY March.Csv"


def test_lock_files_and_folders_are_ignored(spark, folder):
    folder("activity.csv", age=60)
    folder("~$activity.csv")
    folder("activity_old.csv/part.csv")
    assert found(spark, folder) == "activity.csv"


@pytest.mark.parametrize(
    "pattern,name", [("report[12].csv", "report2.csv"), ("report?.csv", "report2.csv"), ("*.csv", "report2.csv")]
)
def test_glob_characters(spark, folder, pattern, name):
    folder(name)
    folder("reportx.csvx", age=-10)
    assert found(spark, folder, pattern) == name


def test_a_dot_is_a_dot(spark, folder):
    folder("activityxcsv")
    with pytest.raises(LandingError):
        found(spark, folder, "activity.csv")


def test_missing_file_names_what_is_there(spark, folder):
    folder("other.csv")
    folder("~$activity.csv")
    with pytest.raises(LandingError) as error:
        found(spark, folder)
    assert "'*activity*.csv'" in str(error.value) and "other.csv" in str(error.value)


def test_missing_folder(spark, folder):
    with pytest.raises(LandingError, match="no such landing folder"):
        landing.newest_file(spark, folder.path + "/nowhere", "*")


def test_availability(spark, folder, make_spec):
    folder("activity.parquet", content="x" * 1_260_000)
    folder("activity_old.parquet", age=99)
    specs = [make_spec(), make_spec(name="churn", source=Feed(pattern="*churn*"))]
    rows = landing.availability(spark, folder.path, specs).collect()
    assert [(r.report, r.role, r.status, r.file, r.size_mb) for r in rows] == [
        ("activity", "source", "ok", "activity.parquet", 1.3),
        ("activity", "targets", "missing", None, None),
        ("churn", "source", "missing", None, None),
        ("churn", "targets", "missing", None, None),
    ]
    with pytest.raises(LandingError):
        landing.availability(
            spark, folder.path, [make_spec(source=Feed(database="a"), targets=Feed(database="a"))]
        )


def test_manifest_audit(spark, folder, tmp_path):
    good, hidden = folder("a b.txt", content="whole"), folder("pkg/_init.txt", content="")
    folder("short.txt", content="par")
    folder("changed.txt", content="swapped")
    folder("same_size.txt", content="abcd")
    folder("not_listed.txt")
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    lines = [
        f"{digest('whole').upper()}  5  a b.txt",
        f"{digest('')} 0 pkg/_init.txt",
        f"{digest('partial')} 7 short.txt",
        f"{digest('change')} 6 changed.txt",
        f"  {digest('abce')} 4 same_size.txt",
        "",
        f"{digest('gone')} 4 gone.txt",
    ]
    manifest = tmp_path / "manifest.lst"
    manifest.write_text("\n".join(lines) + "\n")
    audited = integrity.audit_manifest(
        integrity.read_manifest(spark, str(manifest)), folder.path + "/", tasks=3
    )
    assert {r.path: (r.size, r.found_size, r.status) for r in audited.collect()} == {
        "a b.txt": (5, 5, "conforming"),
        "pkg/_init.txt": (0, 0, "conforming"),
        "short.txt": (7, 3, "truncated"),
        "changed.txt": (6, 7, "modified"),
        "same_size.txt": (4, 4, "modified"),
        "gone.txt": (4, None, "missing"),
    }
    by_uri = integrity.audit_manifest(
        integrity.read_manifest(spark, str(manifest)), "file://" + folder.path
    )
    assert by_uri.filter("status = 'conforming'").count() == 2
    assert good.exists() and hidden.exists()


def test_audit_roots_are_checked_before_any_task(spark):
    assert integrity.reachable("file:/drop/in/") == integrity.reachable("file:///drop/in") == "/drop/in"
    assert integrity.reachable("/drop/week:1") == "/drop/week:1"
    with pytest.raises(LandingError, match="cannot be opened"):
        integrity.reachable("viewfs://cluster/drop")
