"""Numbers as readers see them: half-even rounding, spaces between thousands,
a decimal comma and a dash where there is no value.

Rounding is done on the exact binary value of the double. ``bround`` and
``format_string`` start from the shortest decimal text instead, which moves
values such as 0.35 (really 0.34999...) to the wrong side.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
NO_VALUE = "—"
THOUSANDS = " "
DECIMAL_MARK = ","
PERCENT = " %"
UP = "▲"
DOWN = "▼"

_EXACT_LIMIT = float(2**53)  # from here on a double has no fraction
_SCALE = 2**60


def _grouped(value: Column, pattern: str) -> Column:
    number = value.cast("double")
    whole = F.rint(number).try_cast("bigint")
    text = F.translate(F.format_string(pattern, whole), ",", THOUSANDS)
    # Numbers this large may not be exact, or not fit, as doubles or longs.
    digits = F.regexp_replace(value.try_cast("decimal(38,0)").cast("string"), r"(?<=\d)(?=(?:\d{3})+$)", THOUSANDS)
    sign = F.when((number > 0) & F.lit("+" in pattern), "+").otherwise("")
    large = F.concat(sign, F.coalesce(digits, value.cast("string")))
    binary = F.typeof(value).isin("double", "float")  # their longs are exact
    return (
        F.when(number.isNull() | F.isnan(number), NO_VALUE)
        .when((F.abs(number) < _EXACT_LIMIT) | (binary & whole.isNotNull()), text)
        .otherwise(large)
    )


def integer_text(value: Column) -> Column:
    return _grouped(value, "%,d")


def gap_text(value: Column) -> Column:
    return _grouped(value, "%+,d")


def fixed_text(value: Column, decimals: int) -> Column:
    """``value`` with up to two decimals, rounded half-even on its exact value."""
    if decimals not in (0, 1, 2):
        raise ValueError("decimals must be 0, 1 or 2")
    unit = 10**decimals
    size = F.abs(value)
    floor = F.floor(F.when(size < _EXACT_LIMIT, size))
    # The fraction as a whole number of 2**-60: exact for every fraction that
    # could decide a rounding, the smallest tie being 0.005.
    fraction = ((size - floor) * float(_SCALE)).cast("bigint").cast("decimal(19,0)")
    scaled = fraction * F.lit(unit).cast("decimal(3,0)")
    scale = F.lit(_SCALE).cast("decimal(19,0)")
    below = F.floor(scaled / scale).cast("bigint")
    rest = (scaled - below.cast("decimal(3,0)") * scale).cast("decimal(22,0)")
    half = F.lit(_SCALE // 2).cast("decimal(22,0)")
    last_digit = below if decimals else floor
    up = (rest > half) | ((rest == half) & (F.pmod(last_digit, F.lit(2)) == 1))
    digits = below + F.when(up, 1).otherwise(0)
    text = (floor + F.when(digits == unit, 1).otherwise(0)).cast("string")
    if decimals:
        shown = F.lpad(F.pmod(digits, F.lit(unit)).cast("string"), decimals, "0")
        text = F.concat(text, F.lit("."), shown)
    sign = F.when(F.startswith(value.cast("string"), F.lit("-")), "-").otherwise("")
    return F.when(size < _EXACT_LIMIT, F.concat(sign, text)).otherwise(
        F.format_string(f"%.{decimals}f", value)
    )


def percent_text(ratio: Column, decimals: int = 1) -> Column:
    number = F.replace(
        fixed_text(ratio.cast("double") * 100, decimals), F.lit("."), F.lit(DECIMAL_MARK)
    )
    return F.when(ratio.isNull(), NO_VALUE).otherwise(F.concat(number, F.lit(PERCENT)))


def gap_class(value: Column) -> Column:
    """``up`` at or above target, ``down`` below, ``neutral`` when unknown."""
    return F.when(value.isNull(), "neutral").when(value >= 0, "up").otherwise("down")


def gap_arrow(value: Column) -> Column:
    return F.when(value.isNull(), "").when(value >= 0, UP).otherwise(DOWN)
