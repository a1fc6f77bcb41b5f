"""Which reports keep a row, as data.

The declared lists of all reports are small relations: for each restricted
column, a value and the set of reports that keep it. A row's set is the
intersection over the columns, so neither the plan nor the generated code grows
with the number of reports.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.operators.filters import wanted_values
from tallyboard.sources.datasets import header, literal_rows
from tallyboard.spec import ReportSpec


def requested_values(specs: Iterable[ReportSpec]) -> dict[str, list[str]]:
    """Extract column -> all values that any of the reports asks for."""
    requested: dict[str, set[str]] = {}
    for spec in specs:
        for column, values in wanted_values(spec).items():
            requested.setdefault(column, set()).update(values)
    return {column: sorted(values) for column, values in sorted(requested.items())}


def known_value(column: str, values: Sequence[str]) -> Column:
    """The value if some report asks for it, NULL for all others."""
    return F.when(header(column).isin(*values), header(column))


def name_list(names: Sequence[str]) -> Column:
    """Names as one literal, however many there are."""
    return F.from_json(F.lit(json.dumps(list(names))), "array<string>")


def report_facts(spark: SparkSession, specs: Sequence[ReportSpec]) -> DataFrame:
    """``report, excluded, cutoff`` as declared."""
    facts = [(s.name, s.excluded_unit, s.cutoff) for s in specs]
    return literal_rows(spark, "report string, excluded string, cutoff string", facts)


def _keepers(spark: SparkSession, specs: Sequence[ReportSpec], column: str, values: Sequence[str]) -> DataFrame:
    """``value, keepers``: the reports that keep a value; NULL stands for every
    value that none asks for."""
    lists = {s.name: wanted_values(s).get(column) for s in specs}
    free = {name for name, wanted in lists.items() if wanted is None}
    holders: dict[str, set[str]] = {value: set(free) for value in values}
    for name, wanted in lists.items():
        for value in wanted or ():
            holders[value].add(name)
    rows = [(value, sorted(names)) for value, names in (*holders.items(), (None, free))]
    return literal_rows(spark, "value string, keepers array<string>", rows)


def with_keepers(specs: Sequence[ReportSpec], rows: DataFrame) -> DataFrame:
    """Every row once, with the set of reports that keep it in ``keepers``."""
    sets = []
    for number, (column, values) in enumerate(requested_values(specs).items()):
        known = _keepers(rows.sparkSession, specs, column, values)
        known = known.toDF(f"value_{number}", f"keepers_{number}")
        rows = rows.join(known, known_value(column, values).eqNullSafe(F.col(f"value_{number}")))
        sets.append(number)
    if not sets:
        return rows.withColumn("keepers", name_list([s.name for s in specs]))
    keepers = reduce(F.array_intersect, (F.col(f"keepers_{n}") for n in sets))
    helpers = [f"{kind}_{n}" for n in sets for kind in ("value", "keepers")]
    return rows.withColumn("keepers", keepers).drop(*helpers)


def by_report(specs: Sequence[ReportSpec], rows: DataFrame) -> DataFrame:
    """Every row once per ``report`` that keeps it."""
    return with_keepers(specs, rows).withColumn("report", F.explode("keepers")).drop("keepers")
