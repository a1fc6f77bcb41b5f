"""Mixing of sources to target weights by temperature.

Weights are the sources' token shares to the power alpha, normalised. Alpha is
bisected: the largest in [0, 1] whose weights reach a target entropy, raised as
far as a limit on the repetition of any source asks. A source's budget is then
filled by passes over its documents, each in an own random order; the last pass
ends where the budget does. Orders are by a keyed digest: its leading digits
are the blocks of the permutation, whose token sums place every block, so only
the block in which a budget ends is ordered row by row.

A document has its words and one more token. A null source is the source "".
Rows with the same source and id go in or out of a pass together; null ids are
one id. No documents give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, dropped, packed_row, stored, unpacked

#: Weights are rounded to so many parts.
PARTS = 1_000_000_000
#: Sections of [low, high] that one pass over the sources looks at, and the passes.
SECTIONS, PASSES = 32, 10
#: Documents of the largest source that a block holds on average; it changes no result.
BLOCK_ROWS = 10_000


def token_count(text: Column) -> Column:
    return (F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)) + 1).cast("long")


def source_key() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def exponent(
    sources: DataFrame, total: int, budget: int, min_entropy: float | None, max_repeats: float | None
) -> float:
    """Alpha for a table of (source, tokens); entropies are in nats."""

    def section(low: float, high: float, holds) -> tuple[float, float]:
        """The first two neighbouring points between which `holds` turns false."""
        points = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        share = F.col("tokens") / F.lit(float(total))
        grid = sources.select("tokens", F.explode(F.array([F.lit(p) for p in points])).alias("alpha"))
        power = F.pow(share, F.col("alpha"))
        rows = (
            grid.groupBy("alpha")
            .agg(F.sum(power).alias("z"), F.sum(power * F.log(share)).alias("s"), F.min("tokens").alias("least"))
            .collect()
        )
        found = {r["alpha"]: holds(r) for r in rows}
        for a, b in zip(points, points[1:]):
            if not found[b]:
                return a, b
        return high, high

    def entropy_met(r) -> bool:
        return math.log(r["z"]) - r["alpha"] * r["s"] / r["z"] >= min_entropy

    def repeats_exceeded(r) -> bool:
        return (r["least"] / total) ** r["alpha"] / r["z"] * budget > max_repeats * r["least"]

    alpha = 1.0
    if min_entropy is not None:
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            low, high = section(low, high, entropy_met)
        alpha = low
    if max_repeats is not None:
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            low, high = section(low, high, repeats_exceeded)
        alpha = max(alpha, high)
    return alpha


def mixed_sources(
    docs: DataFrame,
    budget: int | None = None,
    min_entropy_share: float | None = None,
    max_repeats: float | None = None,
    cover: bool = False,
    seed: str = "mix",
) -> DataFrame:
    """The rows of `docs`, as often as the mixture takes them, with mix_tokens, mix_epoch and mix_order.

    `min_entropy_share` is the target entropy as a share of the largest possible,
    the logarithm of the number of sources. `budget` is in tokens, by default
    all tokens there are. `max_repeats` bounds budget * weight / tokens of any
    source. With `cover` every source gets at least one whole pass: the budget is
    raised until the largest source fits, and `max_repeats` then bounds the passes
    of any source relative to it. Sort by mix_epoch and mix_order for a mixture
    in random order.
    """
    own = ["mix_tokens", "mix_epoch", "mix_order"]
    names = docs.drop(*own).columns
    rows = docs.select(
        packed_row(docs), F.col("doc_id").cast("string").alias("doc_id"), token_count(F.col("text")).alias("mix_tokens"), source_key().alias("mix_source")
    )
    slim = stored(rows.select("doc_id", "mix_source", "mix_tokens"), "tokens")
    sources = stored(slim.groupBy("mix_source").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
    size = sources.agg(F.sum("tokens"), F.count("*"), F.max("rows"), F.max("tokens")).first()
    total, count, most_rows, most_tokens = (x or 0 for x in size)
    if not total:
        empty = rows.select(*unpacked(names), "mix_tokens", F.lit(0).cast("long").alias("mix_epoch"), F.lit("").alias("mix_order"))
        return empty.limit(0)
    entropy = None if min_entropy_share is None else min_entropy_share * math.log(count)
    if cover:
        alpha = exponent(sources, total, total, entropy, None)
        if max_repeats is not None and (least := sources.agg(F.min("tokens")).first()[0]) < most_tokens:
            alpha = max(alpha, 1 - math.log(max_repeats) / math.log(most_tokens / least))
    else:
        alpha = exponent(sources, total, budget or total, entropy, max_repeats)
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha))
    z = sources.agg(F.sum(power)).first()[0]
    weighted = sources.withColumn("weight", F.greatest(F.round(F.lit(PARTS) * power / F.lit(z)).cast("long"), F.lit(1)))
    if cover:
        top = weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
        quota = F.greatest(F.col("tokens"), F.floor(F.col("weight") * F.lit(float(top))).cast("long"))
    else:
        quota = F.expr(f"cast(cast(weight as decimal(19,0)) * cast({budget or total} as decimal(19,0)) div {PARTS} as bigint)")
    plan = stored(
        weighted.withColumn("quota", quota)
        .withColumn("passes", F.expr("quota div tokens"))
        .withColumn("rest", F.col("quota") % F.col("tokens"))
        .select("mix_source", "tokens", "passes", "rest"),
        "mixture",
    )
    digits = max(1, math.ceil(math.log(max(1, most_rows / BLOCK_ROWS), 16)))

    def order(epoch: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))

    # The last, partial pass: where the blocks begin, and which of them the budget reaches.
    def laid(table: DataFrame) -> DataFrame:
        return table.join(plan, "mix_source").withColumn("last_order", order(F.col("passes"))).withColumn("block", F.substring("last_order", 1, digits))

    placed = laid(slim)
    blocks = (
        placed.where("rest > 0")
        .groupBy("mix_source", "block", "rest")
        .agg(F.sum("mix_tokens").alias("held"))
        .withColumn("begin", F.sum("held").over(Window.partitionBy("mix_source").orderBy("block")) - F.col("held"))
        .where("begin < rest")
        .select("mix_source", "block", "begin", (F.col("begin") + F.col("held") > F.col("rest")).alias("partly"))
    )
    blocks = stored(blocks, "blocks")
    partly = blocks.where("partly").select(F.col("mix_source").alias("s"), F.col("block").alias("b"), F.col("begin").alias("b0"))
    edge = placed.where("rest > 0").select("mix_source", "block", "last_order", "mix_tokens", "rest")
    edge = edge.join(partly, (F.col("mix_source") == F.col("s")) & (F.col("block") == F.col("b")))
    same = edge.groupBy("mix_source", "block", "last_order", "rest", "b0").agg(F.sum("mix_tokens").alias("held"))
    before = F.sum("held").over(Window.partitionBy("mix_source", "block").orderBy("last_order")) - F.col("held") + F.col("b0")
    inside = stored(same.withColumn("before", before).where("before < rest").groupBy("mix_source", "block").agg(F.max("last_order").alias("until")), "edges")
    reach = blocks.join(inside, ["mix_source", "block"], "left").select(
        "mix_source", "block", F.coalesce("until", F.lit("g")).alias("until")  # "g" follows every digit
    )
    decided = laid(rows).join(reach, ["mix_source", "block"], "left")
    extra = F.when(F.col("last_order") <= F.col("until"), 1).otherwise(0)
    copies = decided.withColumn("copies", F.col("passes") + extra).where("copies > 0")
    copies = copies.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return copies.withColumn("mix_order", order(F.col("mix_epoch"))).select(*unpacked(names), *own)
