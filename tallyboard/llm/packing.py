"""Packing of tokenized documents into windows by multiway differencing.

Documents longer than a window give whole windows and a rest. Rests are dealt
to blocks of about `block_windows` windows. In a block, partial partitions are
merged largest imbalance first, the largest sum of one with the smallest of the
other, which leaves near-equal windows; if one exceeds the capacity, the window
count rises and the block is packed again. So that the differences can vanish,
a rest is cut into pieces of a quarter window at most, and one document in
eight into halving pieces.

Null and empty texts have the end-of-document id alone. Null ids and repeated
rows are documents of their own. No documents give no pieces.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, mixed, ship, text_bytes
from .tokens import vocabulary_file, word_tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Bytes of text that make about one token; it only sets the number of blocks.
BYTES_PER_TOKEN = 2
#: Documents of a block at most, on average; each of its pieces holds a number for every window of the block while they are merged.
BLOCK_PIECES = 16384


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each length, by the largest differencing method for several subsets."""
    if windows <= 1 or len(lengths) <= 1:
        return np.zeros(len(lengths), np.int64)
    sums: list[np.ndarray | None] = []
    for length in lengths.tolist():
        first = np.zeros(windows, np.int64)
        first[0] = length
        sums.append(first)
    merged: dict[int, tuple[int, int, np.ndarray]] = {}
    heap = [(-int(length), i) for i, length in enumerate(lengths.tolist())]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        node = len(sums)
        sums.append(total)
        sums[a] = sums[b] = None
        merged[node] = (a, b, order)
        heapq.heappush(heap, (-int(total[0]), node))
    found = np.zeros(len(lengths), np.int64)
    stack = [(heap[0][1], np.arange(windows))]
    while stack:
        node, labels = stack.pop()
        if node < len(lengths):
            found[node] = labels[0]
            continue
        a, b, order = merged[node]
        left, right = np.empty_like(labels), np.empty_like(labels)
        left[order] = labels
        right[windows - 1 - order] = labels
        stack += [(a, left), (b, right)]
    return found


def packed(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of at most the capacity; the count starts at the least possible and rises while one is exceeded."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    windows = max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()), 1)
    while True:
        found = differencing(lengths, windows)
        loads = np.bincount(found, lengths, minlength=windows)
        if loads.max() <= capacity:
            return found
        windows += max(1, int(np.maximum(loads - capacity, 0).sum()) // capacity)


def cuts(tokens: int, capacity: int, fine: bool) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    whole, rest = divmod(tokens, capacity)
    pieces = [capacity] * whole
    most = max(1, capacity // 4)
    while rest:
        piece = min(most, -(-rest // 2) if fine else rest)
        pieces.append(piece)
        rest -= piece
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    window: int = 4096,
    end_id: int = 2,
    block_windows: int = 256,
) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in its sequence.

    `docs` has doc_id and text; other columns are ignored. `tokenizer` names a
    public vocabulary file whose tokens never cross white space, or its path.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    tokens = (size["bytes"] or 0) // BYTES_PER_TOKEN + size["rows"]
    blocks = max(1, -(-tokens // (block_windows * window)), -(-size["rows"] // BLOCK_PIECES))

    def pieces(iterator):
        memory, seen = word_tokenizer(vocabulary_file(tokenizer)), 0
        end = end_id.to_bytes(4, "little")
        for batch in batches(iterator, 4 << 20):
            rows = []
            for doc, ids in zip(batch.column(1).to_pylist(), memory.ids(batch.column(0).to_pylist())):
                ids += end
                total, start = len(ids) // 4, 0
                whole = zlib.crc32(ids)
                for length in cuts(total, window, whole % 8 == 0):
                    seen += 1
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc, start, length, crc, total, seen * 1_000_003 + whole))
                    start += length
            if rows:
                doc, start, length, crc, total, salt = zip(*rows)
                block = mixed(np.array(salt, np.uint64)) % np.uint64(blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)] + [pa.array(block.astype(np.int64))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "block"],
                )

    def place(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=False, kind="stable").reset_index(drop=True)
        lengths = group["length"].to_numpy()
        full = lengths == window
        at = np.zeros(len(group), np.int64)
        at[~full] = packed(lengths[~full], window)
        used = int(at[~full].max()) + 1 if (~full).any() else 0
        at[full] = used + np.arange(int(full.sum()))
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.r_[True, at[order][1:] != at[order][:-1]]
        offsets = np.empty(len(group), np.int64)
        offsets[order] = begins - np.maximum.accumulate(np.where(first, begins, 0))
        return group.drop(columns="block").assign(sequence_id=(int(key[0]) << 24) + at, offset=offsets)

    cut = docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, block long"
    )
    return cut.groupBy("block").applyInPandas(place, PIECES)
