"""Numbering rows of a whole table in order, without one task that sees them all.

Sampled splitters cut the order into parts of like size; equal values are cut by
the tie breaker, so no value is too frequent to be split. A row's rank is its
position in its part plus the rows of all parts before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows drawn by their hash to place the splitters, rows wanted of a part's
# sample, and the most parts. They decide how even the parts are, nothing else.
SAMPLE, SHARE, PARTS = 4096, 64, 64
# A splitter keeps so much of the tie breaker; any text is a valid place to cut.
_TIE_LENGTH = 64


def with_rank(rows: DataFrame, value: str, tie: str, keys: Sequence[str] = (), parts: int = PARTS) -> DataFrame:
    """``rows`` with ``rank``: 1 for the largest ``value`` of each combination of
    ``keys``, ties by ``tie`` ascending. ``rows`` are read three times, so give a
    written table; no value may be NULL.
    """
    part = _part(F.col(value), F.col(tie), _splitters(rows, value, tie, parts))
    dealt = rows.withColumn("part", part)
    own = Window.partitionBy(*keys, "part").orderBy(F.col(value).desc(), tie)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "part").agg(F.count("*").alias("size"))
    offsets = sizes.select(*keys, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    placed = dealt.withColumn("position", F.row_number().over(own)).join(offsets, [*keys, "part"])
    return placed.withColumn("rank", F.col("position") + F.col("offset")).select(*rows.columns, "rank")


def _splitters(rows: DataFrame, value: str, tie: str, parts: int) -> list[tuple[float, str]]:
    drawn = rows.select(F.col(value).alias("v"), F.left(tie, F.lit(_TIE_LENGTH)).alias("t"), F.xxhash64(value, tie).alias("h"))
    sample = sorted(((r.v, r.t) for r in drawn.orderBy("h").limit(SAMPLE).collect()), key=lambda s: (-s[0], s[1]))
    parts = max(1, min(parts, len(sample) // SHARE))
    chosen = [sample[len(sample) * k // parts] for k in range(1, parts)]
    return list(dict.fromkeys(chosen))


def _part(value: Column, tie: Column, splitters: Sequence[tuple[float, str]], first: int = 0) -> Column:
    """How many splitters are not behind a row, by binary search."""
    if not splitters:
        return F.lit(first)
    middle = len(splitters) // 2
    at, code = splitters[middle]
    ahead = (value > at) | ((value == at) & (tie < code))
    return F.when(ahead, _part(value, tie, splitters[:middle], first)).otherwise(
        _part(value, tie, splitters[middle + 1 :], first + middle + 1)
    )
