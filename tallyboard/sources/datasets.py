"""Opening tabular datasets and binding their headers to roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyboard.errors import ContractError, LandingError
from tallyboard.sources.landing import literal_path, newest_file
from tallyboard.spec import Feed


def header(name: str) -> Column:
    """A column by its literal header, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A few declared values as a relation whose size the optimizer knows."""
    kind = T.StructType.fromDDL(schema)
    values = zip(*rows) if rows else ([] for _ in kind)
    columns = {field.name: pa.array(list(v)) for field, v in zip(kind, values)}
    return spark.createDataFrame(pa.table(columns), kind)


def choose(names: Sequence[str], wanted: int | str, where: str) -> str:
    """One dataset by name or position."""
    if isinstance(wanted, int) and 0 <= wanted < len(names):
        return names[wanted]
    if wanted in names:
        return str(wanted)
    raise ContractError(f"no dataset {wanted!r} in {where}, available: {list(names)}")


def read_file(spark: SparkSession, path: str, feed: Feed | None = None) -> DataFrame:
    """A landed file. Text files are read as text: types are declared by the
    role binding, never guessed."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix in ("parquet", "orc"):
        return spark.read.format(suffix).load(literal_path(path))
    if suffix == "csv":
        feed = feed or Feed(pattern="*.csv")
        return spark.read.csv(
            literal_path(path),
            header=True,
            enforceSchema=False,
            sep=feed.delimiter,
            encoding=feed.encoding,
            multiLine=feed.multiline,
            escape='"',
        )
    raise LandingError(f"cannot read {path}: expected a parquet, orc or csv file")


def read_database(spark: SparkSession, database: str, wanted: int | str) -> DataFrame:
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    return spark.table(f"`{database}`.`{choose(names, wanted, f'database {database}')}`")


def open_feed(spark: SparkSession, feed: Feed, landing: str | None, what: str) -> DataFrame:
    if feed.database:
        return read_database(spark, feed.database, feed.dataset)
    if landing is None:
        raise LandingError(f"no landing folder given for {what} ({feed.pattern})")
    return read_file(spark, newest_file(spark, landing, feed.pattern, what), feed)


def strip_headers(data: DataFrame) -> DataFrame:
    """Headers without surrounding white space; refuses headers that collide."""
    names = [name.strip() for name in data.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ContractError(f"headers that differ only by white space: {twice}")
    return data if names == data.columns else data.toDF(*names)


def require_columns(data: DataFrame, binding: Mapping[str, str], what: str) -> None:
    """All missing headers at once, before any job runs."""
    missing = {role: name for role, name in binding.items() if name not in data.columns}
    if missing:
        lines = [f"  role {role!r}: no column {name!r}" for role, name in missing.items()]
        raise ContractError(
            "\n".join([f"missing columns in the {what}:", *lines])
            + f"\n  columns present: {sorted(data.columns)}"
        )
