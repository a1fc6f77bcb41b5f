"""Files delivered to the landing folder.

The folder is listed by Spark's ``binaryFile`` source. Only path, size and
modification time are selected, so file contents are never read here. As in
every Spark file source, names starting with ``_`` or ``.`` are not listed, and
neither are sub-directories.
"""

from __future__ import annotations

import fnmatch
import logging
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.errors import LandingError
from tallyboard.spec import ReportSpec

LOG = logging.getLogger(__name__)

# Fixed value: prefix of the lock file an office program leaves beside an open file.
LOCK_PREFIX = "~$"


def literal_path(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``name, path, modified, size`` of the files lying directly in ``folder``."""
    try:
        files = spark.read.format("binaryFile").load(literal_path(folder))
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in (problem.getCondition() or ""):
            raise
        raise LandingError(f"no such landing folder: {folder}") from None
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def name_matches(name: Column, pattern: str) -> Column:
    """Case-insensitive glob that never matches a lock file."""
    expression = fnmatch.translate(pattern.lower()).removesuffix(r"\Z") + r"\z"
    return F.lower(name).rlike("^" + expression) & ~F.startswith(name, F.lit(LOCK_PREFIX))


def _newest(pattern: str) -> Column:
    """The newest match as a struct; the path settles equal times."""
    candidate = F.struct("modified", "path", "name", "size")
    return F.max(F.when(name_matches(F.col("name"), pattern), candidate))


def newest_file(spark: SparkSession, folder: str, pattern: str, what: str = "input") -> str:
    """Path of the newest matching file."""
    files = list_files(spark, folder)
    matches = F.count_if(name_matches(F.col("name"), pattern))
    found, count = files.agg(_newest(pattern).alias("newest"), matches.alias("n")).first()
    if found is None:
        # Only the error message needs names; a long listing is shortened there.
        sample = [row.name for row in files.select("name").orderBy("name").limit(50).collect()]
        more = files.count() - len(sample)
        raise LandingError(
            f"no {what} file matches {pattern!r} in {folder}, "
            f"files present: {sample or '(empty folder)'}" + (f" and {more} more" if more > 0 else "")
        )
    if count > 1:
        LOG.warning("%d %s files match %r, the newest is %s", count, what, pattern, found.name)
    return found.path


def matching_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Every match, newest first: more than one means that an older delivery is
    still lying in the folder."""
    files = list_files(spark, folder).filter(name_matches(F.col("name"), pattern))
    return files.orderBy(F.col("modified").desc(), F.col("path").desc())


def availability(spark: SparkSession, folder: str, reports: Iterable[ReportSpec]) -> DataFrame:
    """One row per report and role: is its file there, which one, how large.

    All patterns are answered by one pass over the listing: one aggregate per
    declared pattern, turned into rows afterwards.
    """
    wanted = [
        (report.name, role, feed.pattern)
        for report in reports
        for role, feed in (("source", report.source), ("targets", report.targets))
        if feed.pattern
    ]
    if not wanted:
        raise LandingError("no report reads from the landing folder")
    files = list_files(spark, folder)
    answers = files.agg(*(_newest(p).alias(f"match_{i}") for i, (_, _, p) in enumerate(wanted)))
    rows = F.array(
        *(
            F.struct(
                F.lit(report).alias("report"),
                F.lit(role).alias("role"),
                F.lit(pattern).alias("pattern"),
                F.col(f"match_{i}").alias("found"),
            )
            for i, (report, role, pattern) in enumerate(wanted)
        )
    )
    return answers.select(F.inline(rows)).select(
        "report",
        "role",
        "pattern",
        F.when(F.col("found").isNull(), "missing").otherwise("ok").alias("status"),
        F.col("found.name").alias("file"),
        F.round(F.col("found.size") / 1e6, 1).alias("size_mb"),
        F.col("found.modified").alias("modified"),
    )
