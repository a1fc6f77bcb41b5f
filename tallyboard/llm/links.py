"""Links between nodes that share a posting key, and their connected components.

A group of m near copies shares keys m times m; its pairs are never all made.
Every member of a key is first paired with the key's smallest members only.
What these links have not joined, pairs of two other members in different
components, is paired in a second step, so no link between components is lost.
Members of a key are streamed in their order: each meets at most LEADERS others.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored

#: Members of a key that all others are paired with first; it changes the work, not the components.
LEADERS = 8
#: Members of a key up to which those behind the leaders are compared where they lie; it changes the work, not the components.
WHOLE = 256


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of (a, b): label is the smallest node that links lead to.

    Alternates large and small stars; each round is a written table.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _digest(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.union(now.join(least, F.col("a") == F.col("u")).select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "large")
        root = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(root, F.col("a") == F.col("u")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        following = stored(small.where("a <> b").distinct(), "edges")
        dropped(now, large)
        now, before = following, state
        state = _digest(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def meeting(iterator, own: list[str], near: Callable[[dict, dict], np.ndarray], most: int, bound: int):
    """Of postings that come by key and node: each with a leader it may link with, and those that others behind the leaders may link with.

    The last key of a batch waits for the next one; of a key with more than
    `bound` members, whose others all stay, only the leaders are remembered.
    """
    names = ["key", "node", *own]
    rows, given, large = {x: np.zeros(0, np.int64) for x in names}, 0, None
    for batch in itertools.chain(iterator, [None]):
        if batch is not None:
            rows = {x: np.concatenate([rows[x], batch.column(x).to_numpy(zero_copy_only=False)]) for x in names}
        key = rows["key"]
        if not len(key):
            continue
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        whole = sizes <= bound
        whole[0] &= large is None or int(key[0]) != large
        waits = batch is not None and bool(whole[-1])
        end = int(starts[-1]) if waits else len(key)
        first = np.repeat(starts, sizes)[:end]
        rank, of_whole = np.arange(end) - first, np.repeat(whole, sizes)[:end]

        def fit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return near({x: rows[x][i] for x in own}, {x: rows[x][j] for x in own})

        leaders, members = [], []
        later = np.arange(given, end)
        for k in range(most):
            later = later[rank[later] > k]
            met = later[fit(first[later] + k, later)]
            leaders.append(rows["node"][first[met] + k])
            members.append(met)
        behind = (rank >= most) & ~of_whole
        behind[:given] = False
        later, apart = np.flatnonzero((rank >= most) & of_whole), 1
        while len(later := later[rank[later] >= most + apart]):
            met = later[fit(later - apart, later)]
            behind[met] = behind[met - apart] = True
            apart += 1
        behind = np.flatnonzero(behind)
        taken, leader = np.concatenate([*members, behind]), np.concatenate([*leaders, np.zeros(len(behind), np.int64)])
        without = np.arange(len(taken)) >= len(taken) - len(behind)
        yield pa.RecordBatch.from_arrays([*(pa.array(rows[x][taken]) for x in names), pa.array(leader, mask=without)], names=[*names, "leader"])
        if waits:
            rows, given, large = {x: v[end:] for x, v in rows.items()}, 0, None
        elif batch is not None:
            start, large = int(starts[-1]), int(key[-1])
            rows, given = {x: v[start : start + most] for x, v in rows.items()}, most


def paired(postings: DataFrame, near: Callable[[dict, dict], np.ndarray]) -> DataFrame:
    """A stored table of (key, node, ..., leader): postings with a leader of their key, and with null those that stand behind the leaders.

    `postings` has (key, node, ...), longs, one row per key and node; it is dealt
    out and sorted once. `near` is a cheap necessary condition of links on the
    columns of postings as arrays. Behind the leaders are left out, in keys of up
    to WHOLE members, those that may link with no other one there.
    """
    names = postings.columns
    own, most, whole = [x for x in names if x not in ("key", "node")], LEADERS, WHOLE
    postings = postings.select(*(F.col(x).cast("long").alias(x) for x in ["key", "node", *own]))

    def meet(iterator):
        yield from meeting(iterator, own, near, most, whole)

    dealt = postings.repartition("key").sortWithinPartitions("key", "node")
    return stored(dealt.mapInArrow(meet, ", ".join(f"{x} long" for x in ["key", "node", *own, "leader"])), "paired")


def linked(
    met: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    may_link: Callable[[str, str], Column] | None = None,
    able: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Components of verified links between nodes with a common key: (node, label), without lone nodes.

    `met` comes from `paired` and is deleted. `may_link` is the condition given
    there, on the columns of two postings, given by prefix.
    `verified` stores the pairs (a, b), a < b, that are links. `able` leaves out
    of (key, node, ..., label) what can prove to have no link to another label.
    """
    own = [x for x in met.columns if x not in ("key", "node", "leader")]
    pairs = met.where("leader is not null").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    first = verified(pairs)
    labels = stored(components(first), "labels")
    rest = met.where("leader is null").select("key", "node", *own)
    rest = rest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = stored(rest, "rest")
    dropped(first, met)

    def split(members: DataFrame) -> DataFrame:
        of_several = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
        return stored(members.join(of_several, "key", "left_semi"), "split")

    rest_split = split(rest)
    dropped(rest)
    if able is not None and not rest_split.isEmpty():
        left = split(able(rest_split))
        dropped(rest_split)
        rest_split = left
    if rest_split.isEmpty():
        dropped(rest_split)
        return labels
    a, b = (rest_split.select(*(F.col(x).alias(f"{side}_{x}") for x in rest_split.columns)) for side in "ab")
    on = (F.col("a_key") == F.col("b_key")) & (F.col("a_node") < F.col("b_node")) & (F.col("a_label") != F.col("b_label"))
    if may_link is not None:
        on = on & may_link("a_", "b_")
    second = verified(a.join(b, on).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct())
    every = stored(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(second.select("a", "b")), "links")
    result = stored(components(every), "labels")
    dropped(labels, rest_split, every, second)
    return result
