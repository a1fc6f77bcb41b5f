"""Removal of passages that occur earlier in the corpus, by repeated-phrase automata.

A window is `window` consecutive words. Of the short phrases inside any window
the one with the least hash is its anchor, so equal windows have equal anchors.
Anchors that occur twice or more mark the recurring passages, and their join
locates them. The phrases of a batch of documents are also compiled into an
Aho-Corasick automaton, over an alphabet in which every word is one letter,
which scans that batch alone. All windows around an occurrence are confirmed by 128-bit hashes: a word goes if a window that covers
it starts earlier too, in a smaller id or earlier in the document.

Of documents with the same words only the first takes part; in the others every
window starts earlier. Rows with equal id and text are one document; equal ids
with different texts are ordered by the hash of the text; null ids come first.
Null and empty texts have no words. No documents give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, dropped, gram_hashes, sequence_hash, ship, stored, text_bytes, word_hashes
from .near import text_key

#: Words of an anchor phrase.
PHRASE = 6
#: Letters of the automata's alphabet, all below the surrogates.
LETTERS = 55_000


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or greatest of each run of `width` values."""
    pick = np.minimum if least else np.maximum
    now, have = values, 1
    while 2 * have <= width:
        now = pick(now[:-have], now[have:])
        have *= 2
    shift = width - have
    return pick(now[: len(now) - shift], now[shift:]) if shift else now


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases that are the least of some window."""
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    phrases = gram_hashes(hashes, PHRASE)
    width = window - PHRASE + 1
    least = _slide(phrases, width, True)
    edge = np.zeros(width - 1, np.uint64)
    most = _slide(np.r_[edge, least, edge], width, False)
    places = np.flatnonzero(most == phrases)
    return places, phrases[places]


def letters(hashes: np.ndarray) -> str:
    """A word as one letter each; a zero hash is no word and has a letter of its own."""
    return np.where(hashes == 0, 0, (hashes >> np.uint64(24)) % np.uint64(LETTERS) + np.uint64(1)).astype("<u2").tobytes().decode("utf-16-le")


def located(text: str, phrases: set[str]) -> np.ndarray:
    """Where any of the phrases occurs in the text of a shard."""
    import ahocorasick

    shard = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        shard.add_word(phrase)
    if not len(shard):
        return np.empty(0, np.int64)
    shard.make_automaton()
    return np.fromiter((end for end, _ in shard.iter(text)), np.int64) - (PHRASE - 1)


def around(size: int, hits: np.ndarray, window: int) -> np.ndarray:
    """The windows of a shard that hold a phrase found at one of the hits."""
    last = max(size - window + 1, 0)
    edges = np.bincount(np.clip(hits - (window - PHRASE), 0, last), minlength=last + 1)
    edges = edges - np.bincount(np.clip(hits + 1, 0, last), minlength=last + 1)
    return np.flatnonzero(np.cumsum(edges[:-1]) > 0)


def covered(size: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window at one of the starts."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def _scan(docs: DataFrame, window: int) -> DataFrame:
    def read(iterator):
        for batch in batches(iterator, 4 << 20):
            rows = []
            for text in batch.column(0).to_pylist():
                words = text.split()
                joined = b" ".join(words)
                high, low = sequence_hash(joined)
                places, found = anchors(word_hashes(words, len(words)), window)
                rows.append((len(words), high, low, hashlib.sha256(joined).hexdigest(), places.astype(np.int32), found.view(np.int64)))
            n, high, low, digest, places, found = zip(*rows)
            bounds = pa.array(np.r_[0, np.cumsum([len(x) for x in places])].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(digest),
                    pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(places))),
                    pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(found))),
                ],
                names=["doc_id", "text_key", "n_words", "high", "low", "all_sha256", "places", "anchors"],
            )

    return _texts(docs).select(text_bytes().alias("text"), "doc_id", "text_key").mapInArrow(
        read,
        "doc_id long, text_key long, n_words long, high long, low long, all_sha256 string, places array<int>, anchors array<bigint>",
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))


def _with_text(docs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """The texts of the documents of `rows`, with columns of theirs."""
    asked = rows.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), *columns)
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
    return _texts(docs).join(asked, on).select(text_bytes().alias("text"), "doc_id", "text_key", *columns)


def _windows(found: DataFrame, window: int) -> DataFrame:
    """(first, second, number, place) of all windows around a recurring phrase."""

    def locate(iterator):
        for batch in batches(iterator, 4 << 20):
            split = [text.split() for text in batch.column(0).to_pylist()]
            sizes = np.array([len(words) + 1 for words in split])  # a document ends in a letter of its own
            begins = np.cumsum(sizes) - sizes
            hashes = np.zeros(int(sizes.sum()), np.uint64)
            for begin, words in zip(begins.tolist(), split):
                hashes[begin : begin + len(words)] = word_hashes(words, len(words))
            ends = begins + sizes - 1
            text = letters(hashes)
            own = batch.column(3)
            starts = np.repeat(begins, np.diff(own.offsets.to_numpy())) + own.flatten().to_numpy()
            phrases = {text[at : at + PHRASE] for at in starts.tolist()}
            places = around(len(hashes), located(text, phrases), window)
            row = np.searchsorted(begins, places, side="right") - 1
            whole = places + window <= ends[row]
            places, row = places[whole], row[whole]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram_hashes(hashes, window)[places].view(np.int64)),
                    pa.array(gram_hashes(hashes, window, 0xD6E8FEB86659FD93)[places].view(np.int64)),
                    batch.column(4).take(taken),
                    pa.array((places - begins[row]).astype(np.int32)),
                ],
                names=["first", "second", "number", "place"],
            )

    return found.mapInArrow(locate, "first long, second long, number long, place int")


def repeated_windows(docs: DataFrame, window: int = 20) -> tuple[DataFrame, DataFrame]:
    """The documents with is_first, and (doc_id, text_key, starts): the windows of first documents that start earlier too."""
    ship(docs.sparkSession)
    scanned = stored(_scan(docs, window).withColumn("row", F.monotonically_increasing_id()), "scanned")
    first = scanned.groupBy("high", "low").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("of"))
    plain = scanned.select("doc_id", "text_key", "n_words", "high", "low", "all_sha256").join(first, ["high", "low"])
    same = F.struct("doc_id", "text_key").eqNullSafe(F.struct("of.doc_id", "of.text_key"))
    known = plain.select("doc_id", "text_key", "n_words", "all_sha256", same.alias("is_first"))
    alone = scanned.where(f"n_words >= {window}").join(first.select(F.col("of.row").alias("row")), "row", "left_semi")
    marks = alone.select("row", F.explode(F.arrays_zip("anchors", "places")).alias("m")).select("row", "m.anchors", "m.places")
    # Documents with the same words are one here, so an anchor or a window has a row for each place in another text.
    held = marks.withColumn("holders", F.count("*").over(Window.partitionBy("anchors"))).where("holders > 1")
    places = held.groupBy("row").agg(F.collect_list("places").alias("places"))
    asked = scanned.select("row", "doc_id", "text_key").join(places, "row").orderBy("doc_id", "text_key")
    asked = stored(asked.withColumn("number", F.monotonically_increasing_id()), "asked")  # numbers follow the order
    known = stored(known, "known")
    dropped(scanned)  # the anchors of all texts are not needed any more
    windows = _windows(_with_text(docs, asked, "places", "number"), window)
    # Ranked as they stream by: no group is held together. Rows of one document tie.
    order = Window.partitionBy("first", "second").orderBy("number", "place")
    later = windows.withColumn("n", F.rank().over(order)).where("n > 1")
    starts = stored(later.groupBy("number").agg(F.collect_list("place").alias("starts")), "starts")
    return known, asked.select("doc_id", "text_key", "number").join(starts, "number")


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256 and kept: one row per row of `docs`.

    kept is the remaining words joined by one space, null where all words remain
    (kept_sha256 is of the words joined by one space in either case).
    """
    known, starts = repeated_windows(docs, window)

    def remove(iterator):
        for batch in batches(iterator, 4 << 20):
            rows = []
            for text, own in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                words = text.split()
                gone = covered(len(words), np.array(own, np.int64), window)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rows.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            n, digest, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(digest), pa.array(kept)],
                names=["doc_id", "text_key", "gone", "gone_sha256", "gone_kept"],
            )

    cut = _with_text(docs, starts, "starts").mapInArrow(
        remove, "doc_id long, text_key long, gone long, gone_sha256 string, gone_kept string"
    )
    cut = cut.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(
        F.first("gone").alias("gone"), F.first("gone_sha256").alias("gone_sha256"), F.first("gone_kept").alias("gone_kept")
    )
    joined = known.join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & F.col("is_first"), "left")
    copy = ~F.col("is_first") & (F.col("n_words") >= window)
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("gone_sha256", "all_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("gone_kept")).alias("kept"),
    )
