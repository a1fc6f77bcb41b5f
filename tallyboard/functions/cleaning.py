"""Lenient coercions: a bad value becomes NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a number in a text column. The JVM alone would also take
# "12d", "3f" and hexadecimal floats.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def stripped(value: Column) -> Column:
    """Text without surrounding white space; an all-blank text becomes ''.

    A general trim walks every text. Most texts begin and end with a visible
    ASCII character, which two comparisons of bytes tell; those pass as is.
    """
    text = value.cast("string")
    visible = [(c >= "!") & (c < "\x80") for c in (text, F.right(text, F.lit(1)))]
    return F.when(visible[0] & visible[1], text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def as_number(value: Column, data_type: T.DataType) -> Column:
    """DOUBLE, with unreadable text and NaN turned into NULL."""
    if isinstance(data_type, T.StringType):
        text = stripped(value)
        number = F.when(text.rlike(NUMBER), text).try_cast("double")
    else:
        number = value.cast("double")
    return F.when(~F.isnan(number), number)


# Letters of numeric date patterns: their widths, and what pads a field to its
# full width or stands for one that is not there. A single letter takes one or
# two digits.
_WIDTHS = {"y": (2, 4), "M": (1, 2), "d": (1, 2), "H": (1, 2), "m": (1, 2), "s": (1, 2), "S": tuple(range(1, 10))}
_PADS = {"y": "20", "M": "01", "d": "01", "H": "00", "m": "00", "s": "00", "S": "0"}


def _layouts(pattern: str) -> dict[str, list[int]] | None:
    """Layouts, texts of the pattern with a 9 for every digit, with place and
    width of each field in them. None for patterns with names, optional parts,
    digits of their own, no year, or a field given twice."""
    pieces = re.findall(r"'([^']+)'|(([A-Za-z])\3*)|([^A-Za-z']+|')", pattern)
    letters = [letter for _, _, letter, _ in pieces if letter]
    if "y" not in letters or len(set(letters)) < len(letters):
        return None
    found: dict[str, dict[str, tuple[int, int]]] = {"": {}}
    for quoted, run, letter, other in pieces:
        if letter and len(run) not in _WIDTHS.get(letter, ()) or re.search(r"['\[\]{}#]", other) or re.search(r"\d", quoted + other):
            return None
        runs = ["9", "99"] if run and len(run) == 1 and letter != "S" else ["9" * len(run) if letter else quoted + other]
        found = {
            layout + text: {**fields, letter: (len(layout) + 1, len(text))} if letter else fields
            for layout, fields in found.items()
            for text in runs
        }
    return {
        layout: [number for letter in _WIDTHS for number in fields.get(letter, (1, 0))]
        for layout, fields in found.items()
    }


def _tries(formats: Sequence[str]) -> list[dict[str, list[int]] | str]:
    """What to read a text by, in the declared order: tables of the layouts of
    numeric patterns, or a pattern of another kind. Patterns share a table
    unless they read one layout in two ways (day or month first)."""
    tries: list[dict[str, list[int]] | str] = []
    first = 0  # tables before a pattern of another kind take no later ones
    for pattern in formats:
        layouts = _layouts(pattern)
        if layouts is None:
            tries.append(pattern)
            first = len(tries)
            continue
        for layout, places in layouts.items():
            for table in tries[first:]:
                if table.setdefault(layout, places) == places:
                    break
            else:
                tries.append({layout: places})
    return tries


def _places(text: Column, table: dict[str, list[int]]) -> Column:
    """Places and widths of the fields of a text; NULL if its layout is unknown."""
    pairs = (x for layout, places in table.items() for x in (F.lit(layout), F.array(*map(F.lit, places))))
    return F.create_map(*pairs)[F.translate(text, "012345678", "9" * 9)]


def _parsed(text: Column, places: Column) -> Column:
    """The fields, cut out, put in one canonical order and parsed once."""

    def field(at: int, letter: str) -> Column:
        cut = F.substring(text, places[2 * at], places[2 * at + 1])
        if letter == "S":
            return F.rpad(cut, 6, _PADS[letter])
        return F.lpad(cut, 4 if letter == "y" else 2, _PADS[letter])

    fields = (field(at, letter) for at, letter in enumerate(_WIDTHS))
    marks = map(F.lit, ("-", "-", " ", ":", ":", "."))
    first, *rest = fields
    return F.concat(first, *(x for pair in zip(marks, rest) for x in pair)).try_cast("timestamp_ntz")


def _other(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def is_moment(data_type: T.DataType) -> bool:
    """Dates that need no reading; predicates on them reach the scan."""
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def as_moment(value: Column, data_type: T.DataType, formats: Sequence[str]) -> Column:
    """The date role as one expression: typed columns pass untouched, text is
    read with the declared formats, the first that reads it wins."""
    if is_moment(data_type):
        return value
    text = stripped(value)
    readings = (_other(text, t) if isinstance(t, str) else _parsed(text, _places(text, t)) for t in _tries(formats))
    return F.coalesce(*readings)


def with_moment(data: DataFrame, value: Column, formats: Sequence[str], name: str) -> DataFrame:
    """``data`` with the moment that a text column gives.

    The text and the places of its fields are found in projections of their own
    and used by later ones, and the moment leaves a generator of one row: the
    optimizer merges none of them and copies nothing into predicates, so each
    date is read once, whatever looks at it.
    """

    def unused(wish: str) -> str:
        while wish in (*data.columns, name):
            wish += "_"
        return wish

    tries = _tries(formats)
    text, moment = unused("stripped"), unused("moment")
    places = {at: unused(f"places{at}") for at, t in enumerate(tries) if isinstance(t, dict)}
    held = data.select("*", stripped(value).alias(text))
    found = held.select("*", *(_places(F.col(text), tries[at]).alias(column) for at, column in places.items()))
    readings = (
        _parsed(F.col(text), F.col(places[at])) if at in places else _other(F.col(text), t)
        for at, t in enumerate(tries)
    )
    read = found.select("*", F.coalesce(*readings).alias(moment))
    once = F.inline(F.array(F.struct(F.col(moment).alias(name))))
    return read.select("*", once).drop(text, moment, *places.values())
