"""Daily totals kept from an extract, from which weeks and backfills are served.

An extract is a full snapshot, so looking at other weeks, or at the same weeks
with other targets, needs no second pass over it. Its rows are added up once per
unit, day and requested values; the totals are kept under what was counted (the
extract's declaration and the requested values) and of what delivery. A newer
delivery replaces the totals of the one before.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyboard.operators.routing import requested_values
from tallyboard.operators.tally import value_keys
from tallyboard.operators.volumes import measured
from tallyboard.plans.backfill import boards_of_entries, entries_of
from tallyboard.plans.many import RawInputs, shared_extracts, targets_by_report
from tallyboard.sinks.scratch import child_folders, delete, is_complete
from tallyboard.spec import ReportSpec


def daily_totals(specs: Sequence[ReportSpec], extract: DataFrame) -> DataFrame:
    """``unit_code, activity_date, after_midnight``, the requested values,
    ``measured, row_count``: one row per unit, day and combination of values.

    ``specs`` share the extract. Totals of several extracts without common rows
    add up. Counting starts before the shuffle.
    """
    moment, day = F.col("activity_date"), F.col("activity_date").cast("date")
    dated = extract.filter(F.col("unit_code").isNotNull() & moment.isNotNull())
    return dated.groupBy(
        "unit_code",
        day.alias("activity_date"),
        (moment > day.cast("timestamp_ntz")).alias("after_midnight"),
        *value_keys(specs),
    ).agg(measured(specs[0]).alias("measured"), F.count("*").alias("row_count"))


def delivery_of(raw: DataFrame) -> str:
    """The identity of delivered files: their paths, sizes and times of change.
    The files are listed, not read."""
    files = raw.sparkSession.read.format("binaryFile").load(sorted(raw.inputFiles()))
    listed = files.select(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")).alias("f"))
    return listed.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("f")), "\n"), 256).alias("id")).first().id


@dataclass(frozen=True)
class History:
    """Where daily totals are kept: a folder that the cluster shares."""

    spark: SparkSession
    path: str

    def days(self, specs: Sequence[ReportSpec], extract: DataFrame, delivery: str) -> DataFrame:
        """The daily totals of an extract, counted only if they are not there."""
        counted = daily_totals(specs, extract)
        # By position: filter columns may differ in case alone, which files cannot.
        schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(counted.schema)])
        place = f"{self.path}/{_counted_what(specs)}"
        folder = f"{place}/{hashlib.sha256(delivery.encode()).hexdigest()[:32]}"
        if not is_complete(self.spark, folder):
            counted.toDF(*schema.names).write.mode("overwrite").parquet(folder)
            for other in child_folders(self.spark, place):
                if other != folder.rsplit("/", 1)[1]:
                    delete(self.spark, f"{place}/{other}")
        return self.spark.read.schema(schema).parquet(folder).toDF(*counted.columns)


def _counted_what(specs: Sequence[ReportSpec]) -> str:
    spec = specs[0]
    what = (spec.extract_key, sorted(requested_values(specs).items()))
    return hashlib.sha256(repr(what).encode()).hexdigest()[:32]


def backfill_kept(
    specs: Sequence[ReportSpec],
    inputs: Mapping[str, RawInputs],
    first: str,
    last: str,
    history: History,
    deliveries: Mapping[str, str] | None = None,
) -> DataFrame:
    """`backfill_reports` from kept daily totals: no extract is read whose
    totals are there. ``deliveries`` names the delivery of a report's extract
    where it does not come from files."""

    def entries(members: list[ReportSpec], extract: DataFrame, start: dt.date, past: dt.date) -> list[DataFrame]:
        name = members[0].name
        delivery = (deliveries or {}).get(name) or delivery_of(inputs[name].extract)
        return entries_of(members, history.days(members, extract, delivery), start, past, kept=True)

    return boards_of_entries(shared_extracts(specs, inputs), targets_by_report(specs, inputs), first, last, entries)
