"""Publishing blocks into tables that somebody else designed.

A target table plays the part of a prepared sheet: its header stays as it is
and its rows are replaced as a whole. Columns are matched by position. A target
or a report that is not there is reported and skipped; the other rules go on.

Blocks are published together or not at all. All are first computed and written
beside the tables; a manifest that names them is the decision to publish, and
only then are tables replaced. A failure before the manifest leaves every table
as it was. After it, the next run (or ``finish_publishing``) replaces the tables
from what was staged, those already replaced included. One run at a time may
publish to a destination.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from tallyboard.errors import PublishError
from tallyboard.sinks.scratch import delete, is_complete
from tallyboard.sources.datasets import literal_rows
from tallyboard.spec import PublishRule

# One line per block of a run: where it is staged and which table it replaces.
MANIFEST = (
    "number int, path string, table string, model string, target string, block string, report string"
)

# Block name -> DataFrame, asked only for the blocks some rule publishes.
Blocks = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Published:
    target: str
    block: str
    report: str
    rows: int


@dataclass(frozen=True)
class PublishOutcome:
    done: tuple[Published, ...]
    warnings: tuple[str, ...]

    @property
    def rows(self) -> int:
        return sum(entry.rows for entry in self.done)


def _quoted(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def check_destination(
    spark: SparkSession, destination: str, template: str | None, sources: Iterable[str] = ()
) -> None:
    """Refuses, before anything is written, a destination that is also an input."""
    catalog = spark.catalog
    wanted = destination.lower()
    if template is not None and template.lower() == wanted:
        raise PublishError(f"template and destination are the same database: {template}")
    if wanted in {name.lower() for name in sources}:
        raise PublishError(f"destination {destination} is a database the reports read from")
    for role, name in (("template", template), ("destination", destination)):
        if name is not None and not catalog.databaseExists(name):
            raise PublishError(f"no such {role} database: {name}")


def publish(
    spark: SparkSession,
    rules: Iterable[PublishRule],
    reports: Mapping[str, Blocks],
    destination: str,
    template: str | None = None,
    staging: str | None = None,
) -> PublishOutcome:
    """Writes the blocks of all ``rules`` into the tables of ``destination``.

    ``template`` is a database whose tables define the targets. Targets missing
    from the destination are created empty in its image; the template itself is
    only ever read. ``staging`` is a folder that the cluster shares, by default
    one in the destination's own.
    """
    check_destination(spark, destination, template)
    staging = staging or staging_of(spark, destination)
    finish_publishing(spark, destination, staging)
    planned, warnings = plan(spark, rules, reports, destination, template)
    entries = []
    for number, (rule, table, model, rows) in enumerate(planned):
        path = f"{staging}/blocks/{number}"
        rows.toDF(*(f"c{i}" for i in range(len(rows.columns)))).write.mode("overwrite").parquet(path)
        entries.append((number, path, table, model, rule.target, rule.block, rule.report))
    if entries:
        manifest = literal_rows(spark, MANIFEST, entries).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{staging}/manifest")
    return PublishOutcome(finish_publishing(spark, destination, staging), tuple(warnings))


def staging_of(spark: SparkSession, destination: str) -> str:
    return spark.catalog.getDatabase(destination).locationUri.rstrip("/") + "/_staged"


def finish_publishing(
    spark: SparkSession, destination: str, staging: str | None = None
) -> tuple[Published, ...]:
    """Replaces the tables that a manifest names and clears it away. Without a
    manifest nothing was decided and nothing happens."""
    staging = staging or staging_of(spark, destination)
    done = []
    if is_complete(spark, f"{staging}/manifest"):
        entries = spark.read.schema(MANIFEST).parquet(f"{staging}/manifest").orderBy("number").collect()
        for entry in entries:
            done.append(Published(entry.target, entry.block, entry.report, _replace(spark, entry)))
    delete(spark, f"{staging}/manifest")
    delete(spark, staging)
    return tuple(done)


def _replace(spark: SparkSession, entry: Row) -> int:
    if entry.model != entry.table:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {entry.table} LIKE {entry.model}")
    spark.read.parquet(entry.path).write.insertInto(entry.table, overwrite=True)
    return spark.table(entry.table).count()


def plan(
    spark: SparkSession,
    rules: Iterable[PublishRule],
    reports: Mapping[str, Blocks],
    destination: str,
    template: str | None = None,
) -> tuple[list[tuple[PublishRule, str, str, DataFrame]], list[str]]:
    """Every rule that can be carried out, with its table, the table it is
    modelled on and its rows, checked before anything is written; and what is
    reported and skipped."""
    check_destination(spark, destination, template)
    planned, warnings = [], []
    for rule in rules:
        if rule.report not in reports:
            warnings.append(f"{rule.target}: report {rule.report!r} was not produced")
            continue
        table = model = _quoted(destination, rule.target)
        if template is not None and not spark.catalog.tableExists(table):
            model = _quoted(template, rule.target)
        if not spark.catalog.tableExists(model):
            present = sorted(t.name for t in spark.catalog.listTables(destination))
            warnings.append(f"{rule.target}: no such table in {destination}, present: {present}")
            continue
        rows = reports[rule.report](rule.block)
        expected = spark.table(model).columns
        if len(expected) != len(rows.columns):
            raise PublishError(
                f"block {rule.block!r} has columns {rows.columns}, "
                f"target {rule.target!r} has {expected}"
            )
        planned.append((rule, table, model, rows))
    return planned, warnings
