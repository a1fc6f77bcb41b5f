"""Token-id output: best-fit-decreasing packing and matrices of ids.

Documents longer than a sequence are split without loss into whole sequences
and a rest. In blocks of about `block_sequences` sequences, rests are placed
longest first into the fullest sequence that still takes them; a segment tree
over free capacities finds it. A sequence is one row: padded ids, cumulative
segment lengths, and the offsets at which positions start again at 0.

Null and empty texts have the end-of-document id alone. Null ids and repeated
rows are documents of their own. No documents give no sequences.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, mixed, ship, text_bytes
from .packing import BYTES_PER_TOKEN
from .tokens import vocabulary_file, word_tokenizer

SEQUENCES = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


class Capacities:
    """A segment tree that counts open sequences by free capacity."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, free: int, sequence: int) -> None:
        self.open[free].append(sequence)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The open sequence with the least free capacity of at least `need`."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._change(free, -1)
        return free, self.open[free].pop()

    def _change(self, free: int, by: int) -> None:
        node = free + self.leaves
        while node:
            self.count[node] += by
            node >>= 1


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The sequence of each length, given in falling order."""
    tree, found, used = Capacities(capacity), [], 0
    for length in lengths:
        place = tree.take(length)
        if place is None:
            place = capacity, used
            used += 1
        free, sequence = place
        found.append(sequence)
        tree.add(free - length, sequence)
    return found


def pack_ids(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    length: int = 4096,
    end_id: int = 2,
    pad_id: int = 0,
    id_bytes: int = 2,
    block_sequences: int = 256,
) -> DataFrame:
    """One row per packed sequence; ids are little-endian unsigned numbers of `id_bytes` bytes, `length` of them.

    cu_seqlens starts with 0 and ends with n_tokens; doc_ids and doc_starts name
    each segment's document and the place of its first id there.
    """
    if id_bytes not in (2, 4):
        raise ValueError("id_bytes is 2 or 4")
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    tokens = (size["bytes"] or 0) // BYTES_PER_TOKEN + size["rows"]
    blocks = max(1, -(-tokens // (block_sequences * length)))
    kind = f"<u{id_bytes}"

    def segments(iterator):
        memory, seen = word_tokenizer(vocabulary_file(tokenizer)), 0
        end = end_id.to_bytes(4, "little")
        for batch in batches(iterator, 4 << 20):
            rows = []
            found = list(memory.ids(batch.column(0).to_pylist()))
            every = np.frombuffer(end.join([*found, b""]), "<u4")  # each document's ids and the one that ends it
            if id_bytes == 2 and len(every) and int(every.max()) > 0xFFFF:
                raise ValueError("this vocabulary needs id_bytes=4")
            raw, at = memoryview(every.astype(kind).tobytes()), 0
            for doc, data in zip(batch.column(1).to_pylist(), found):
                size = len(data) // 4 + 1
                salt = size + int.from_bytes(data[:4] or end, "little")
                for start in range(0, size, length):
                    seen += 1
                    part = raw[id_bytes * (at + start) : id_bytes * (at + min(start + length, size))]
                    rows.append((doc, start, bytes(part), seen * 1_000_003 + salt))
                at += size
            if rows:
                doc, start, part, salt = zip(*rows)
                block = mixed(np.array(salt, np.uint64)) % np.uint64(blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(part, pa.binary()), pa.array(block.astype(np.int64))],
                    names=["doc_id", "start", "ids", "block"],
                )

    def place(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(n=group["ids"].map(len) // id_bytes)
        group = group.sort_values(["n", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        at = np.array(best_fit(group["n"].tolist(), length))
        order = np.argsort(at, kind="stable")
        at, sizes = at[order], group["n"].to_numpy()[order]
        ids, docs_all, starts = (group[x].to_numpy()[order].tolist() for x in ("ids", "doc_id", "start"))
        docs_all = [None if pd.isna(x) else int(x) for x in docs_all]
        firsts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rows = []
        for first, last in zip(firsts.tolist(), [*firsts[1:].tolist(), len(at)]):
            bounds = [0, *np.cumsum(sizes[first:last]).tolist()]
            pad = np.full(length - bounds[-1], pad_id, kind).tobytes()
            sequence = (int(key[0]) << 24) + int(at[first])
            rows.append((sequence, bounds[-1], b"".join(ids[first:last]) + pad, bounds, bounds[:-1], docs_all[first:last], starts[first:last]))
        return pd.DataFrame(rows, columns=["sequence_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_starts"])

    cut = docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        segments, "doc_id long, start long, ids binary, block long"
    )
    return cut.groupBy("block").applyInPandas(place, SEQUENCES)


def write_sequences(packed: DataFrame, path: str, parts: int | None = None) -> None:
    """Writes the sequences as Parquet: fixed-width id rows beside their segment bounds and position resets."""
    (packed if parts is None else packed.repartition(parts)).write.mode("overwrite").parquet(path)


def matrices(sequences: DataFrame, length: int = 4096, id_bytes: int = 2, rows: int = 256) -> DataFrame:
    """Row-major id matrices of up to `rows` sequences, with the ids of their rows: (matrix, sequence_ids, n_rows)."""
    kind = f"<u{id_bytes}"

    def join(iterator):
        for batch in iterator:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                raw = b"".join(part.column(1).to_pylist())
                if len(raw) != part.num_rows * length * np.dtype(kind).itemsize:
                    raise ValueError("a sequence has another length")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw], pa.binary()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([part.num_rows], pa.int32())],
                    names=["matrix", "sequence_ids", "n_rows"],
                )

    return sequences.select("sequence_id", "ids").mapInArrow(join, "matrix binary, sequence_ids array<bigint>, n_rows int")
