"""Near-duplicate documents by an inverted join of MinHash coordinates.

Documents with the same set of word shingles are one class. A class is posted
under each (coordinate, value) pair of its signature. Two classes are
candidates if enough coordinates agree. Values are put in one order, rare ones
first, and a class is posted under its prefix alone: a pair that agrees often
enough shares a key of both prefixes. Values held once are skipped, as is a
class with too few shared values. Candidates are confirmed on their whole sets.

The least number of agreeing coordinates is far below its mean at the linking
similarity (28 of 64 where 48 are expected), so about one link in 10^8 is missed.

Null and empty texts have an empty set and link with nothing. Rows with equal
id and text are one document. Null ids are documents; a group of them alone has
a null component_id. No documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, dropped, gram_hashes, packed_row, sequence_hash, ship, stored, text_bytes, unpacked, word_hashes
from .links import linked, paired

COORDINATES, AGREEING = 64, 28
PREFIX = COORDINATES - AGREEING + 1
_random = np.random.default_rng(20240229)
MASKS = _random.integers(0, 2**32, COORDINATES, dtype=np.uint32)
FACTORS = _random.integers(0, 2**31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; one for a shorter text, none without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(gram_hashes(word_hashes(words, len(words)), size))


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The least value of each coordinate."""
    low = np.full(COORDINATES, 2**32 - 1, np.uint32)
    x = (shingle_set >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 16384):
        part = (x[None, start : start + 16384] ^ MASKS[:, None]) * FACTORS[:, None]
        low = np.minimum(low, (part ^ (part >> np.uint32(15))).min(1))
    return low


def text_key():
    """Tells texts apart beside the id."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def features(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, n_shingles, the hash of the set and the signature of every row."""

    def measure(iterator):
        for batch in batches(iterator, 4 << 20):
            rows = []
            for text in batch.column(0).to_pylist():
                own = shingles(text, size)
                high, low = sequence_hash(own.tobytes())
                rows.append((len(own), high, low, signature(own).view(np.int32) if len(own) else None))
            n, high, low, values = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(values, pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "n_shingles", "high", "low", "signature"],
            )

    return docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")).mapInArrow(
        measure, "doc_id long, text_key long, n_shingles long, high long, low long, signature array<int>"
    )


def prefix_postings(classes: DataFrame) -> DataFrame:
    """(key, node, n) of the classes' prefixes, rarest values first."""
    every = classes.select("node", F.col("n_shingles").alias("n"), F.posexplode("signature").alias("at", "value")).select(
        "node", "n", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long")).alias("key")
    )
    shared = every.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    held = every.join(shared, "key").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("keys"))
    kept = held.where(F.size("keys") >= AGREEING)
    taken = F.slice("keys", F.lit(1), F.greatest(F.size("keys") - (COORDINATES - PREFIX), F.lit(0)))
    return kept.select("node", "n", F.explode(taken).alias("k")).select(F.col("k.key").alias("key"), "node", "n")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def compare(iterator):
        for batch in iterator:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            rows = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(rows.columns[:2], names=["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept and group_key; one row per row of `docs`.

    Documents link if 100 * intersection >= percent * union of their sets of
    `size`-word shingles; component_id is the smallest id that links lead to.
    group_key tells the groups apart; it is null for empty sets, which are alone.
    """
    ship(docs.sparkSession)
    known = stored(features(docs, size).withColumn("row", F.monotonically_increasing_id()), "features")
    filled = known.where("n_shingles > 0")
    classes = stored(
        filled.groupBy("high", "low").agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("row", "doc_id", "text_key")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )

    def agree(pairs: DataFrame) -> DataFrame:
        one = classes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
        two = classes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
        matches = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
        return pairs.join(one, "a").join(two, "b").where(matches >= AGREEING).select("a", "b")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node", "left_semi").select("node", F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("t"))
        return whole_sets(docs, wanted, size)

    def verified(pairs: DataFrame) -> DataFrame:
        candidates = stored(agree(pairs), "candidates")
        sets = stored(sets_of(candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
        links = stored(confirmed(candidates, sets, percent), "links")
        dropped(candidates, sets)
        return links

    def sizes(a: str, b: str):
        n, m = F.col(f"{a}n"), F.col(f"{b}n")
        return (100 * n >= percent * m) & (100 * m >= percent * n)

    def able(members: DataFrame) -> DataFrame:
        labels = members.select("node", "label").distinct()
        return reaching(members, foreign_shingles(sets_of(labels).join(labels, "node")), percent)

    labels = linked(paired(prefix_postings(classes), lambda a, b: (100 * a["n"] >= percent * b["n"]) & (100 * b["n"] >= percent * a["n"])), verified, sizes, able)
    grouped = classes.select("high", "low", "node", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    placed = grouped.join(least, "label").select("high", "low", "component_id", F.col("label").alias("group_key"))
    result = known.join(placed, ["high", "low"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.withColumn("component_id", component).select(
        "doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group_key"
    )


def foreign_shingles(sets: DataFrame) -> DataFrame:
    """(node, foreign): of the shingles of each node, how many a node with another label has too; nodes without one are left out.

    `sets` has (node, shingles, label).
    """

    def spread(iterator):
        for batch in batches(iterator, 4 << 20):
            own = [np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
            values = pa.array(np.concatenate(own).view(np.int64))
            yield pa.RecordBatch.from_arrays([values, batch.column(1).take(row), batch.column(2).take(row)], names=["shingle", "node", "label"])

    held = sets.select("shingles", "node", "label").mapInArrow(spread, "shingle long, node long, label long")
    holders = Window.partitionBy("shingle")
    several = F.min("label").over(holders) < F.max("label").over(holders)
    return held.select("node", several.alias("several")).where("several").groupBy("node").agg(F.count("*").alias("foreign"))


def reaching(members: DataFrame, foreign: DataFrame, percent: int) -> DataFrame:
    """The members (key, node, n, ...) of a key that have shingles enough in common with other labels to link with the smallest member of the key.

    Sets of n and m shingles with s in common link if (100 + percent) * s >=
    percent * (n + m); s is at most what a node shares with all other labels.
    """
    least = members.groupBy("key").agg(F.min("n").alias("m"))
    known = members.join(least, "key").join(foreign, "node")
    enough = ((100 + percent) * F.col("foreign") >= percent * (F.col("n") + F.col("m"))) & (100 * F.col("foreign") >= percent * F.col("n"))
    return known.where(enough).select(*members.columns)


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the wanted documents (node, d, t)."""
    texts = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))

    def build(iterator):
        for batch in batches(iterator, 4 << 20):
            sets = [shingles(text, size).tobytes() for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sets, pa.binary())], names=["node", "shingles"])

    built = found.select(text_bytes().alias("text"), "node").mapInArrow(build, "node long, shingles binary")
    return built.groupBy("node").agg(F.first("shingles").alias("shingles"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row of `docs` for each group, with all its columns, whatever they are called; rows with equal id and text are one document."""
    decided = near_duplicates(docs, size, percent)
    keep = stored(
        decided.where("kept")
        .groupBy("group_key", F.when(F.col("group_key").isNull(), F.struct("doc_id", "text_key")).alias("alone"))
        .agg(F.min("text_key").alias("keep_text"), F.min_by("doc_id", "text_key").alias("keep_id"), F.count("*").alias("keep_rows"))
        .select("keep_id", "keep_text", (F.col("keep_rows") > 1).alias("keep_one")),
        "keep",
    )
    held = docs.select(packed_row(docs), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    chosen = held.join(keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_text")))
    names = unpacked(docs.columns)
    if keep.where("keep_one").isEmpty():
        return chosen.select(*names)
    once = chosen.where("keep_one").groupBy("keep_id", "keep_text").agg(F.first("row").alias("row")).select(*names)
    return chosen.where(~F.col("keep_one")).select(*names).unionByName(once)
