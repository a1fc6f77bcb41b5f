"""Weekly results as parquet partitions ``week=.../report=...``.

Writing a week again replaces exactly the partitions of the reports written, so
a run can be repeated, and reports can be run one at a time, without duplicates
or losses.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyboard.sources.landing import literal_path

KEYS = ("week", "report")

# The characters Spark escapes in the names of partition folders.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))
_ESCAPES = str.maketrans({character: f"%{ord(character):02X}" for character in ESCAPED})


def write_partitions(rows: DataFrame, path: str, rebalance: bool = True) -> None:
    """All weeks and reports found in ``rows``, in one job. For results that
    never lack rows: a partition without rows would keep its old content.

    Rebalancing gathers the few rows of a small board into one file and splits
    a large one, whatever the parallelism of the job before. Rows straight from
    a large scan need no such shuffle.
    """
    (
        (rows.hint("rebalance", *KEYS) if rebalance else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEYS)
        .parquet(path)
    )


def partition_path(path: str, week: str, report: str) -> str:
    return f"{path}/week={week.translate(_ESCAPES)}/report={report.translate(_ESCAPES)}"


def write_report(rows: DataFrame, path: str, week: str, report: str) -> None:
    """The partition of one report and week, replaced even by zero rows."""
    rows.drop(*KEYS).write.mode("overwrite").parquet(partition_path(path, week, report))


def write_findings(rows: DataFrame, path: str, week: str, reports: Iterable[str]) -> None:
    """One week of results in which a report may have no row: its partition is
    then emptied, so that findings of an earlier run do not survive."""
    write_partitions(rows, path)
    found = {row.report for row in rows.select("report").distinct().collect()}
    for report in reports:
        if report not in found:
            write_report(rows.limit(0), path, week, report)


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, week: str, reports: Iterable[str]
) -> DataFrame:
    """What was written for these reports; each of them has a partition."""
    folders = [literal_path(partition_path(path, week, report)) for report in reports]
    stored = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return stored.select(*schema.names)
