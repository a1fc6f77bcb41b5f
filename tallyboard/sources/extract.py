"""The activity extract: one row per case, bound to roles and cleaned.

Columns of a clean extract: ``activity_date``, ``segment``, ``unit_code``,
``date_unreadable``, ``amount`` and ``amount_unreadable`` when the report sums a
column, and one column per extra filter. With typed dates it is a plain projection: unused columns are
pruned from the scan and predicates on the date are pushed into it. Text dates
are read once, below whatever looks at them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyboard.errors import ContractError
from tallyboard.functions.cleaning import is_moment, stripped, with_moment
from tallyboard.sources.datasets import header, require_columns, strip_headers
from tallyboard.spec import SOURCE_ROLES, ReportSpec

ROLE_COLUMNS = ("activity_date", "segment", "unit_code")


def filter_column(name: str) -> str:
    """Where the values of an extra filter header live in a clean extract."""
    return f"filter_on_{name}"


def clean_extract(spec: ReportSpec, raw: DataFrame, filters: Iterable[str] = ()) -> DataFrame:
    """``filters`` names further filter headers, when reports share an extract."""
    data = strip_headers(raw)
    extra = sorted({*spec.filters, *filters})
    binding = {role: spec.source_columns[role] for role in SOURCE_ROLES}
    if spec.measure:
        binding["measure"] = spec.measure
    binding.update({f"filter {name}": name for name in extra})
    require_columns(data, binding, f"source of report {spec.name!r}")

    raw_date, moment = header(binding["date"]), header(binding["date"])
    if not is_moment(data.schema[binding["date"]].dataType):
        name = "read " + binding["date"]
        while name in data.columns:
            name += " "
        data, moment = with_moment(data, raw_date, spec.date_formats, name), header(name)

    def text(name: str) -> Column:
        return header(name).cast("string") if spec.text_is_trimmed else stripped(header(name))

    columns = [
        moment.alias("activity_date"),
        text(binding["segment"]).alias("segment"),
        text(binding["unit"]).alias("unit_code"),
        (raw_date.isNotNull() & moment.isNull()).alias("date_unreadable"),
    ]
    if spec.measure:
        value, unreadable = amount(spec, data)
        columns += [value.alias("amount"), unreadable.alias("amount_unreadable")]
    columns += [text(name).alias(filter_column(name)) for name in extra]
    return data.select(*columns)


def segments_of(spec: ReportSpec, raw: DataFrame) -> DataFrame:
    """The ``segment`` column alone, for what looks at no other."""
    data = strip_headers(raw)
    binding = {"segment": spec.source_columns["segment"]}
    require_columns(data, binding, f"source of report {spec.name!r}")
    value = header(binding["segment"])
    return data.select((value.cast("string") if spec.text_is_trimmed else stripped(value)).alias("segment"))


def _unreadable_amount(spec: ReportSpec, data: DataFrame) -> Column | None:
    """Whether the summed column holds a text that cannot be read whole in the
    declared type; None where it holds numbers."""
    value, kind = header(spec.measure), data.schema[spec.measure].dataType
    if isinstance(kind, T.NumericType):
        return None
    if spec.measure_type is None:
        raise ContractError(
            f"report {spec.name!r} sums {spec.measure!r}, which is {kind.simpleString()}: declare measure_type"
        )
    text = stripped(value)
    number = text.try_cast(spec.measure_type)
    exact = number.cast("decimal(38,10)") == text.try_cast("decimal(38,10)")
    return F.coalesce((text != "") & ~F.coalesce(exact, F.lit(False)), F.lit(False))


def amount(spec: ReportSpec, data: DataFrame) -> tuple[Column, Column]:
    """The summed column, and whether it cannot be read. Dropped or rounded
    silently, such an amount would change a total: it is an error, or, where the
    report declares so, left out of the sum and counted."""
    value, unreadable = header(spec.measure), _unreadable_amount(spec, data)
    if unreadable is None:
        return value.cast(spec.measure_type) if spec.measure_type else value, F.lit(False)
    text = stripped(value)
    number = text.try_cast(spec.measure_type)
    if spec.unreadable_amounts == "exclude":
        return F.when(~unreadable, number), unreadable
    message = F.concat(F.lit(f"no {spec.measure_type} in {spec.measure!r}: "), text)
    refused = F.raise_error(message).cast(spec.measure_type)
    return F.when(unreadable, refused).otherwise(number), F.lit(False)


def rejected_values(spec: ReportSpec, raw: DataFrame) -> DataFrame:
    """``segment, unit_code, column, value, reason``: every date and amount that
    cannot be read, as delivered, whatever the report does about it. One pass,
    no shuffle; a row with both is there twice."""
    data = strip_headers(raw)
    binding = {role: spec.source_columns[role] for role in SOURCE_ROLES}
    if spec.measure:
        binding["measure"] = spec.measure
    require_columns(data, binding, f"source of report {spec.name!r}")
    found = []

    def rejection(when: Column, name: str, reason: str) -> Column:
        row = F.struct(F.lit(name).alias("column"), header(name).cast("string").alias("value"), F.lit(reason).alias("reason"))
        return F.when(when, row)

    unreadable = _unreadable_amount(spec, data) if spec.measure else None
    if unreadable is not None:
        found.append(rejection(unreadable, spec.measure, "unreadable_amount"))
    date = binding["date"]
    if not is_moment(data.schema[date].dataType):
        name = "read " + date
        while name in data.columns:
            name += " "
        data = with_moment(data, header(date), spec.date_formats, name)
        found.append(rejection(header(date).isNotNull() & header(name).isNull(), date, "unreadable_date"))
    if not found:
        kinds = "`column` string, value string, reason string"
        found.append(F.lit(None).cast(T.StructType.fromDDL(kinds)))
    roles = [stripped(header(binding[role])).alias(column) for role, column in (("segment", "segment"), ("unit", "unit_code"))]
    return data.select(*roles, F.inline(F.array_compact(F.array(*found))))


def date_quality(extract: DataFrame) -> DataFrame:
    """One row: how many dates are given and how many cannot be read."""
    given = F.count_if(F.col("activity_date").isNotNull() | F.col("date_unreadable"))
    unreadable = F.count_if("date_unreadable")
    return extract.agg(
        given.alias("dates_given"),
        unreadable.alias("dates_unreadable"),
        ((given > 0) & (given == unreadable)).alias("all_unreadable"),
    )


def refuse_unreadable_dates(spec: ReportSpec, raw: DataFrame) -> None:
    """The error raised when not one given date could be read."""
    name = spec.source_columns["date"]
    values = strip_headers(raw).select(header(name).alias("v")).filter("v IS NOT NULL").limit(3)
    samples = [row.v for row in values.collect()]
    raise ContractError(
        f"no value of {name!r} in the source of report {spec.name!r} is a date, "
        f"first values: {samples}"
    )
