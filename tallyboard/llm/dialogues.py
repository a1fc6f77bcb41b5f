"""A trie of conversations by a splitter skeleton.

A conversation is the sequence of its turns; a node of the trie is a distinct
sequence of first turns. Each turn becomes a 16-byte digest of its role and
text, so a conversation is one byte string, its path, and conversations that
share first turns lie together in the order of paths.

Sampled paths split that order into shards, equal paths by conversation id. A
node with members on both sides of a splitter is a prefix of the splitter's
path: the trie of splitter paths, the skeleton, is broadcast, every other node
lies in one shard and is finished there by one scan of sorted rows. Shards give
partial figures of the skeleton's nodes, which are summed by a reduction and
carried up the skeleton. A splitter holds at most SPLITTER_TURNS turns, so the
skeleton has at most so many nodes for each shard.

Memory: a task holds the open path and the figures of nodes whose parent is
still open in its shard; texts leave with the first projection. The digest of
all members that end at a node goes through them in order; for a skeleton node
the pieces of all shards are streamed through one task in ids of a few bytes.
One conversation is one row: 20 bytes for each turn.

Rows without a conversation id belong to none. A null turn comes first; equal
turn numbers are ordered by the digests of role and text; repeated rows are
turns of their own. Null roles and texts are empty. The conversation that a
rebuilt one borrows from is found by remainders that round towards zero. No
conversations give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, ship, stored

#: Turns that are borrowed at most, and conversations that share the one they borrow from.
BORROWED, SHARING = 9, 5
STEP = 16
SPLITTER_TURNS, SAMPLES = 64, 32
#: Conversations of a shard, ids of one piece, rows of one batch.
SHARD_ROWS, PIECE_IDS, OUT_ROWS = 50_000, 1024, 20_000
NODE, PART, PIECE = 0, 1, 2

FIGURES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
FOUND = ", ".join(["kind int", *(f"{x} long" for x in FIGURES), "ends_sha256 string", "skeleton int", "last_bytes long", "ids binary"])
KINDS = [pa.int32(), *[pa.int64()] * len(FIGURES), pa.string(), pa.int32(), pa.int64(), pa.binary()]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame, borrowed: int = BORROWED, sharing: int = SHARING) -> DataFrame:
    """conv_id, path and the bytes of each turn's text, after the first turns were borrowed."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(2 * STEP))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"),
        (conv - conv % sharing).alias("lender"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("said"),
    )
    own = turns.repartition("lender").groupBy("lender", "conv_id").agg(F.sort_array(F.collect_list("said")).alias("own"))
    lent = F.first(F.when(F.col("conv_id") == F.col("lender"), F.col("own")), ignorenulls=True).over(Window.partitionBy("lender"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed).cast("int")
    first = F.coalesce(F.slice("lent", F.lit(1), taken), F.slice("own", 1, 0))
    whole = own.withColumn("lent", lent).select("conv_id", F.concat(first, F.slice("own", taken + 1, F.size("own"))).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return whole.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))


def splitters(paths: DataFrame, shards: int, rows: int) -> list[tuple[bytes, int]]:
    """At most shards - 1 points of the order of paths and ids, from a sample that is bounded in rows and bytes."""
    every = max(1, rows // (SAMPLES * shards))
    drawn = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0)
    cut = drawn.select(F.expr(f"substring(path, 1, {STEP * SPLITTER_TURNS})").alias("path"), "conv_id")
    sample = sorted((bytes(r.path), r.conv_id) for r in cut.collect())
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)}) if sample else []


def skeleton_of(points: list[tuple[bytes, int]]) -> list[tuple[int, bytes]]:
    """(parent, digest) of the nodes on splitter paths, parents first; node 0 is the root."""
    nodes, known = [(-1, b"")], {}
    for path, _ in points:
        at = 0
        for k in range(0, len(path), STEP):
            step = (at, path[k : k + STEP])
            if step not in known:
                known[step] = len(nodes)
                nodes.append(step)
            at = known[step]
    return nodes


class Open:
    """A node on the path of the row at hand."""

    __slots__ = ("digest", "skeleton", "bytes", "least", "n", "children", "leaves", "saved", "ended", "ids", "waiting")

    def __init__(self, digest: bytes, skeleton: int, size: int):
        self.digest, self.skeleton, self.bytes = digest, skeleton, size
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ended, self.ids, self.waiting = None, [], []

    def end(self, conv: int) -> list[tuple]:
        """A member that ends here; pieces that are full."""
        self.least = conv if self.least is None else min(self.least, conv)
        self.n += 1
        if self.skeleton >= 0:
            self.ids.append(conv)
            return self.piece() if len(self.ids) == PIECE_IDS else []
        if self.ended is None:
            self.ended = hashlib.sha256(b"%d" % conv)
        else:
            self.ended.update(b",%d" % conv)
        return []

    def piece(self) -> list[tuple]:
        if not self.ids:
            return []
        found = (PIECE, self.ids[0], *[None] * 7, self.skeleton, None, ",".join(map(str, self.ids)).encode())
        self.ids = []
        return [found]

    def close(self, parent: Open | None, depth: int) -> list[tuple]:
        """What can be told now that no further member comes; the parent takes its share."""
        if self.skeleton >= 0:
            part = (PART, self.least, depth, None, self.n, self.children, self.leaves, self.saved, None, self.skeleton, self.bytes, None)
            found = [*self.piece(), part]
            leaves, saved = 0, 0  # the skeleton carries them up
        else:
            found = [(NODE, *row[:2], self.least, *row[2:], None, None, None) for row in self.waiting]
            leaves, saved = self.leaves or 1, self.saved + (self.n - 1) * self.bytes
            row = (self.least, depth, self.n, self.children, leaves, saved, self.ended.hexdigest() if self.ended else NO_ENDS)
            if parent.skeleton >= 0:
                found.append((NODE, *row[:2], None, *row[2:], parent.skeleton, None, None))
            else:
                parent.waiting.append(row)
            parent.children += 1
        if parent is not None:
            parent.least = self.least if parent.least is None else min(parent.least, self.least)
            parent.n += self.n
            parent.leaves += leaves
            parent.saved += saved
        return found


def scanned(rows, skeleton: dict[tuple[int, bytes], int]):
    """Finished nodes, partial figures and pieces of the sorted rows (path, conv_id, bytes) of a shard."""
    stack: list[Open] = []
    for path, conv, sizes in rows:
        if not stack:
            stack.append(Open(b"", 0, 0))
        same = 1
        while same < len(stack) and same <= len(sizes) and path[STEP * (same - 1) : STEP * same] == stack[same].digest:
            same += 1
        while len(stack) > same:
            node = stack.pop()
            yield from node.close(stack[-1], len(stack))
        for k in range(same - 1, len(sizes)):
            digest = path[STEP * k : STEP * (k + 1)]
            above = stack[-1].skeleton
            stack.append(Open(digest, skeleton.get((above, digest), -1) if above >= 0 else -1, sizes[k]))
        yield from stack[-1].end(conv)
    while stack:
        node = stack.pop()
        yield from node.close(stack[-1] if stack else None, len(stack))


def record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=[field.split()[0] for field in FOUND.split(", ")])


def digests(iterator):
    """(skeleton, ends) from the pieces of each skeleton node, in the order of their first ids."""

    def told(skeleton, state):
        return pa.RecordBatch.from_arrays([pa.array([skeleton], pa.int32()), pa.array([state.hexdigest()])], names=["skeleton", "ends"])

    current, state = None, None
    for batch in iterator:
        for skeleton, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids").to_pylist()):
            if skeleton == current:
                state.update(b"," + ids)
                continue
            if state is not None:
                yield told(current, state)
            current, state = skeleton, hashlib.sha256(ids)
    if state is not None:
        yield told(current, state)


def carried_up(nodes: list[tuple[int, bytes]], parts: dict[int, dict], ends: dict[int, str]) -> list[tuple]:
    """The skeleton's nodes with whole figures: (skeleton, conv_id, ..., ends_sha256), children before parents."""
    for k in range(len(nodes) - 1, -1, -1):
        own = parts[k]
        if not own["n_children"]:
            own["n_leaves"] = 1
        own["saved_tokens"] += (own["n_convs"] - 1) * own["last_bytes"]
        if k:
            above = parts[nodes[k][0]]
            above["n_children"] += 1
            above["n_leaves"] += own["n_leaves"]
            above["saved_tokens"] += own["saved_tokens"]
    rows = []
    for k, (parent, _) in enumerate(nodes):
        own = parts[k] | {"parent_conv_id": parts[parent]["conv_id"] if k else None}
        rows.append((k, *(own[x] for x in FIGURES), ends.get(k, NO_ENDS)))
    return rows


def conversation_trie(conversations: DataFrame, borrowed: int = BORROWED, sharing: int = SHARING, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row for each node."""
    spark = conversations.sparkSession
    ship(spark)
    paths = stored(rebuilt(conversations, borrowed, sharing), "paths")
    rows = paths.count()
    shards = max(1, min(rows // SAMPLES, max(rows // shard_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    points = splitters(paths, shards, rows)
    nodes = skeleton_of(points)
    shared = spark.sparkContext.broadcast((points, nodes))

    def placed(iterator):
        cuts = shared.value[0]
        for batch in iterator:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    def scan(iterator):
        skeleton = {step: k for k, step in enumerate(shared.value[1])}
        columns = (zip(*(batch.column(c).to_pylist() for c in ("path", "conv_id", "bytes"))) for batch in iterator)
        held = []
        for row in scanned((row for batch in columns for row in batch), skeleton):
            held.append(row)
            if len(held) == OUT_ROWS:
                yield record(held)
                held = []
        if held:
            yield record(held)

    dealt = paths.select("conv_id", "path", "bytes").mapInArrow(placed, "conv_id long, path binary, bytes array<long>, shard int")
    in_order = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("path", "conv_id")
    found = stored(in_order.mapInArrow(scan, FOUND), "nodes")
    dropped(paths)
    sums = [F.sum(c).alias(c) for c in FIGURES[3:]]
    figures = found.where(f"kind = {PART}").groupBy("skeleton", "depth", "last_bytes").agg(F.min("conv_id").alias("conv_id"), *sums)
    parts = {r.skeleton: r.asDict() for r in figures.collect()}  # as many rows as the skeleton has nodes
    pieces = found.where(f"kind = {PIECE}").select("skeleton", F.col("conv_id").alias("first"), "ids")
    ended = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "first").mapInArrow(digests, "skeleton int, ends string")
    whole = carried_up(nodes, parts, dict(ended.collect())) if parts else []
    kept = "skeleton int, " + ", ".join(f"{x} long" for x in FIGURES) + ", ends_sha256 string"
    upper = spark.createDataFrame(whole, kept)
    inner = found.where(f"kind = {NODE}").select("skeleton", *FIGURES, "ends_sha256")
    above = F.broadcast(upper.select("skeleton", F.col("conv_id").alias("above")))
    inner = inner.join(above, "skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*FIGURES, "ends_sha256").unionByName(upper.select(*FIGURES, "ends_sha256"))
