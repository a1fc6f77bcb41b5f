"""Report declarations.

A report binds fixed roles to the headers of its datasets, so adding a report
never needs code. What a declaration must satisfy stands beside its fields as
data: a constraint maps a value to its complaint, or to nothing. A declaration
is judged as a whole when it is built, and every complaint is in the error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from tallyboard.errors import SpecError
from tallyboard.functions.weeks import CUTOFFS

SOURCE_ROLES = ("date", "segment", "unit")
TARGET_ROLES = ("unit", "start", "annual")
BLOCKS = ("detail", "targets", "scoreboard")
AMOUNT_POLICIES = ("refuse", "exclude")

# Text dates are read with these patterns unless the report declares its own.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
)


Constraint = Callable[[object], str | None]


def _given(value: object) -> str | None:
    return None if value else "is not given"


def _one_of(choices: Sequence[str], noun: str = "value") -> Constraint:
    def judge(value: object) -> str | None:
        return None if value in choices else f"unknown {noun} {value!r}, one of {list(choices)} is expected"

    return judge


def _binds(roles: Sequence[str]) -> Constraint:
    def judge(binding: object) -> str | None:
        unbound = sorted(set(roles) - {role for role, name in dict(binding or {}).items() if name}, key=roles.index)
        return f"binds roles to headers, missing {unbound}" if unbound else None

    return judge


def _listed(values: object) -> str | None:
    return "lists of values are expected, not a text" if isinstance(values, str) else None


def _all_listed(lists: object) -> str | None:
    return next(filter(None, map(_listed, dict(lists).values())), None)


def _refuse(what: str, complaints: Iterable[str]) -> None:
    found = list(complaints)
    if found:
        raise SpecError(f"{what}: " + "; ".join(found))


def _judged(declared: object, constraints: Mapping[str, Constraint]) -> list[str]:
    verdicts = {name: judge(getattr(declared, name)) for name, judge in constraints.items()}
    return [f"{name}: {complaint}" for name, complaint in verdicts.items() if complaint]


@dataclass(frozen=True)
class Feed:
    """Where a dataset comes from.

    Either the newest file of the landing folder whose name matches
    ``pattern`` (case-insensitive glob), or one dataset of a catalog
    ``database``, chosen by name or by position in name order. The last three
    fields describe a CSV file; one with line breaks inside its records cannot
    be split among tasks.
    """

    pattern: str = ""
    database: str = ""
    dataset: int | str = 0
    delimiter: str = ","
    encoding: str = "UTF-8"
    multiline: bool = False

    def __post_init__(self) -> None:
        if bool(self.pattern) == bool(self.database):
            raise SpecError("a feed needs either a landing pattern or a database")


REPORT_CONSTRAINTS: dict[str, Constraint] = {
    "name": _given,
    "source": _given,
    "targets": _given,
    "source_columns": _binds(SOURCE_ROLES),
    "target_columns": _binds(TARGET_ROLES),
    "segments": _listed,
    "filters": _all_listed,
    "cutoff": _one_of(CUTOFFS),
    "unreadable_amounts": _one_of(AMOUNT_POLICIES),
}


@dataclass(frozen=True)
class ReportSpec:
    name: str
    source: Feed | None
    targets: Feed | None
    source_columns: Mapping[str, str]
    target_columns: Mapping[str, str]
    label: str = ""
    measure_label: str = "rows"
    segments: tuple[str, ...] = ()  # empty keeps every row
    excluded_unit: str | None = None
    measure: str | None = None  # header to sum; None counts rows
    measure_type: str | None = None  # numbers keep their own type; text needs one
    # What an amount that cannot be read whole does: ``refuse`` the run, or
    # ``exclude`` the row from the sum. Either way it is counted and named.
    unreadable_amounts: str = "refuse"
    filters: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    cutoff: str = "day"
    date_formats: tuple[str, ...] = DATE_FORMATS
    # The text columns of the extract carry no surrounding white space (a
    # curated table). Nothing is trimmed then, and the value lists become
    # predicates of the file scan.
    text_is_trimmed: bool = False

    def __post_init__(self) -> None:
        _refuse(f"report {self.name!r}", _judged(self, REPORT_CONSTRAINTS))
        settle = object.__setattr__  # the record is frozen from here on
        settle(self, "segments", tuple(self.segments))
        settle(self, "filters", {name: tuple(values) for name, values in self.filters.items()})
        settle(self, "date_formats", tuple(self.date_formats))
        settle(self, "label", self.label or self.name)
        if self.excluded_unit is not None:
            settle(self, "excluded_unit", self.excluded_unit.strip() or None)

    @property
    def extract_key(self) -> tuple:
        """Reports with equal keys read and clean their extract the same way,
        so one scan can serve all of them."""
        return (
            self.source,
            tuple(self.source_columns[role] for role in SOURCE_ROLES),
            self.measure,
            self.measure_type if self.measure else None,
            self.unreadable_amounts if self.measure else None,
            self.date_formats,
            self.text_is_trimmed,
        )

    @property
    def target_key(self) -> tuple:
        """Reports with equal keys read and clean their targets the same way."""
        return (self.targets, tuple(self.target_columns[role] for role in TARGET_ROLES))


RULE_CONSTRAINTS: dict[str, Constraint] = {
    "target": _given,
    "report": _given,
    "block": _one_of(BLOCKS, "block"),
}


@dataclass(frozen=True)
class PublishRule:
    """Copy one block of one report to one existing target table."""

    target: str
    block: str
    report: str

    def __post_init__(self) -> None:
        _refuse(f"publish rule for {self.target!r}", _judged(self, RULE_CONSTRAINTS))


def _more_than_once(names: Iterable[str]) -> list[str]:
    return sorted(name for name, times in Counter(names).items() if times > 1)


@dataclass(frozen=True)
class ReportBook:
    """All reports of a project and where their blocks are published."""

    reports: tuple[ReportSpec, ...]
    publish: tuple[PublishRule, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "reports", tuple(self.reports))
        object.__setattr__(self, "publish", tuple(self.publish))
        _refuse("book of reports", self._complaints())

    def _complaints(self) -> Iterable[str]:
        if not self.reports:
            yield "no report is declared"
        if repeated := _more_than_once(self.names):
            yield f"several reports are named {repeated}"
        for name in sorted({rule.report for rule in self.publish} - set(self.names)):
            yield self._unknown(name)
        # Table names are case-insensitive in the catalog.
        if repeated := _more_than_once(rule.target.lower() for rule in self.publish):
            yield f"several blocks are published to the same target {repeated}"

    def _unknown(self, name: str) -> str:
        return f"unknown report {name!r}, declared reports: {', '.join(self.names)}"

    @property
    def names(self) -> list[str]:
        return [report.name for report in self.reports]

    def report(self, name: str) -> ReportSpec:
        return self.select([name])[0]

    def select(self, names: Sequence[str] | None = None) -> list[ReportSpec]:
        """The named reports, all of them by default, each once. Every name is checked."""
        declared = {report.name: report for report in self.reports}
        wanted = list(dict.fromkeys(names or self.names))
        _refuse("selection of reports", (self._unknown(name) for name in wanted if name not in declared))
        return [declared[name] for name in wanted]
