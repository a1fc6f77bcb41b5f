"""The targets: one row per unit, two numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyboard.errors import ContractError
from tallyboard.functions.cleaning import as_number, stripped
from tallyboard.sources.datasets import header, require_columns, strip_headers
from tallyboard.spec import TARGET_ROLES, ReportSpec

TARGET_COLUMNS = ("unit_code", "target_start", "target_annual")

# Offenders named in an error message; the full list is `duplicate_targets`.
_NAMED = 100


def clean_targets(spec: ReportSpec, raw: DataFrame) -> DataFrame:
    data = strip_headers(raw)
    binding = {role: spec.target_columns[role] for role in TARGET_ROLES}
    require_columns(data, binding, f"targets of report {spec.name!r}")

    def number(role: str):
        name = binding[role]
        return as_number(header(name), data.schema[name].dataType)

    return data.select(
        stripped(header(binding["unit"])).alias("unit_code"),
        number("start").alias("target_start"),
        number("annual").alias("target_annual"),
    ).filter(F.col("unit_code").isNotNull())


def duplicate_targets(targets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units that have several target rows; ``keys`` tell the targets of several
    reports apart."""
    rows = targets.groupBy(*keys, "unit_code").agg(F.count("*").alias("target_rows"))
    return rows.filter("target_rows > 1").orderBy(*keys, "unit_code")


def require_unique_targets(spec: ReportSpec, targets: DataFrame) -> None:
    """Runs one small job; every later step relies on unique units."""
    refuse_duplicates(duplicate_targets(targets.withColumn("report", F.lit(spec.name)), ["report"]))


def refuse_duplicates(found: DataFrame) -> None:
    """The error raised for duplicate targets, by ``report``, of any number of
    reports; it names the first offenders of each."""
    rows = found.select("report", "unit_code").limit(_NAMED + 1).collect()
    if not rows:
        return
    named: dict[str, list[str]] = {}
    for row in rows[:_NAMED]:
        named.setdefault(row.report, []).append(row.unit_code)
    lines = [f"the targets of report {report!r} hold several rows for: {units}" for report, units in named.items()]
    if len(rows) > _NAMED:
        lines.append("and more: duplicate_targets has them all")
    raise ContractError("; ".join(lines))
