"""Spelling variants by dense prefix-suffix tiling.

Words are runs of letters A-Z, a-z and U+00C0 to U+00FF of whole texts, counted
over all documents. Two words are near if one inserted, deleted or replaced code
point turns one into the other: their common prefix and common suffix then
reach the length of the longer one minus one.

The place of the edit lies in one of PARTS intervals of the longer word. What
stands before and after that interval is the same in both words, so words are
dealt to one cell for each length of the longer word, interval, and pair of
ends. A cell is compared densely: code points become padded matrices, in which
the first differing column is the common prefix, and the suffix in the reversed
ones. Cells of like size are stacked into one array; a cell of more than `tile`
words is written as tiles, whose pairs Spark deals out. A pair counts in the
interval of its common prefix alone, hence once.

A word's form is its near word with the largest count, ties by code points, if
that count is at least `ratio` times its own; roots follow forms by pointer
doubling, as counts rise strictly along them.

Null and empty texts have no words; a null id counts as an empty one; repeated
rows count each. Very long texts are read in pieces. No words give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, dropped, ship, stored, text_bytes

#: Intervals that the place of an edit is told apart by.
PARTS = 3
#: Words of a cell that are compared within one task; the pairs of larger cells' tiles are dealt out.
TILE = 256
#: One run in so many, by its document and its letters, loses a code point.
DRAWN = 199
#: Code points compared in one array operation, distinct words held by one task, bytes read at once.
CELLS, HELD, PIECE = 1 << 22, 1 << 18, 1 << 22

OTHERS = re.compile(rb"[\xc2\xc4-\xf7][\x80-\xbf]+")  # UTF-8 of code points from U+0080 on, but for U+00C0 to U+00FF
LETTERS = bytes(b if chr(b).islower() and b < 128 or 0x80 <= b <= 0xBF or b == 0xC3 else 32 for b in range(256))


def runs(data: bytes, piece: int = PIECE):
    """Lists of the lower-cased runs of a text."""
    cleaned, start = OTHERS.sub(b" ", data.lower()).translate(LETTERS), 0
    while start < len(cleaned):
        end = cleaned.find(b" ", start + piece)
        end = len(cleaned) if end < 0 else end
        yield cleaned[start:end].split()
        start = end


def without_one(run: bytes, place: int) -> bytes:
    letters = run.decode()
    place %= len(letters)
    return (letters[:place] + letters[place + 1 :]).encode()


def counted_words(docs: DataFrame, least_length: int, least_count: int, drawn: int = DRAWN) -> DataFrame:
    """(word, n): the words of at least so many code points and occurrences."""

    def count(iterator):
        total: Counter = Counter()

        def held():
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches(iterator, PIECE):
            for doc, text in zip(batch.column(1).to_pylist(), batch.column(0)):
                seed = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for piece in runs(text.as_py()):
                    for run, n in Counter(piece).items():
                        if len(run) >= least_length:
                            place = zlib.crc32(run, seed)
                            total[run if place % drawn else without_one(run, place)] += n
                    if len(total) >= HELD:
                        yield held()
                        total.clear()
        if total:
            yield held()

    texts = docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    found = texts.mapInArrow(count, "word string, n long").where(F.char_length("word") >= least_length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def dealt(words: DataFrame) -> DataFrame:
    """(longer, part, ends, word, n): every word in its cells, as the longer word and as the one that lacks a code point."""
    places = []
    for more in (0, 1):
        longer = f"(char_length(word) + {more})"
        for part in range(PARTS):
            head, tail = f"({longer} * {part} div {PARTS})", f"({longer} - {longer} * {part + 1} div {PARTS})"
            ends = f"concat(left(word, int({head})), right(word, int({tail})))"
            places.append(f"struct(int({longer}) AS longer, {part} AS part, {ends} AS ends)")
    return words.select("word", "n", F.inline(F.expr(f"array({', '.join(places)})"))).select("longer", "part", "ends", "word", "n")


def codes(words: list[str], width: int) -> np.ndarray:
    """A row of code points for each word, padded with zeros."""
    table = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    return table.astype(np.uint8) if table.max(initial=0) < 256 else table


def near_places(x: list[str], y: list[str], blocks: int, longer: np.ndarray, part: np.ndarray, own: bool) -> tuple[np.ndarray, ...]:
    """Rows of x and y that are near, for `blocks` equal blocks of both; `own` compares a block with itself, each pair once."""
    m, n = len(x) // blocks, len(y) // blocks
    width = max(map(len, (*x, *y)))
    sides = [codes(w, width).reshape(blocks, -1, width) for w in (x, y)]
    turned = [codes([w[::-1] for w in words], width).reshape(blocks, -1, width) for words in (x, y)]
    sizes = [np.array([len(w) for w in words]).reshape(blocks, -1) for words in (x, y)]
    upper = np.triu(np.ones((m, n), bool), 1) if own else np.ones((m, n), bool)
    found = []
    stack = max(1, CELLS // (m * n * width))
    rows = max(1, min(m, CELLS // (n * width)))
    for k in range(0, blocks, stack):
        b = slice(k, k + stack)
        for r in range(0, m, rows):
            a = slice(r, r + rows)
            prefix, suffix = ((one[b, a, None] != two[b, None]).argmax(-1) for one, two in (sides, turned))
            whole = longer[b, None, None]
            first, last = whole * part[b, None, None] // PARTS, whole * (part[b, None, None] + 1) // PARTS
            near = (prefix + suffix >= whole - 1) & (prefix >= first) & (prefix < last) & upper[a]
            near &= np.maximum(sizes[0][b, a, None], sizes[1][b, None]) == whole
            i, j, l = np.nonzero(near)
            found.append(((i + k) * m + j + r, (i + k) * n + l))
    return tuple(np.concatenate(z) for z in zip(*found))


LINKS = "word string, near string, near_n long"


def links(x: tuple[list, list], y: tuple[list, list], at: tuple[np.ndarray, ...]) -> list[tuple]:
    pairs = [((x[0][i], x[1][i]), (y[0][j], y[1][j])) for i, j in zip(at[0].tolist(), at[1].tolist())]
    return [(a[0], *b) for a, b in pairs] + [(b[0], *a) for a, b in pairs]


def cells(iterator, tile: int):
    """(key, words, counts, number, last): the cells of sorted rows, in tiles."""
    current, words, counts, number = None, [], [], 0
    for batch in iterator:
        longer, part, ends, word, n = (c.to_pylist() for c in batch.columns)
        for key, one, times in zip(zip(longer, part, ends), word, n):
            if key != current:
                if words:
                    yield current, words, counts, number, True
                current, words, counts, number = key, [], [], 0
            elif len(words) == tile:
                yield current, words, counts, number, False
                words, counts, number = [], [], number + 1
            words.append(one)
            counts.append(times)
    if words:
        yield current, words, counts, number, True


def compared(cell_rows: DataFrame, tile: int) -> DataFrame:
    """Links within cells of up to `tile` words; of larger ones the tiles, numbered within their cell."""

    def compare(iterator):
        waiting: dict[int, list] = defaultdict(list)

        def flushed(size: int):
            group = waiting.pop(size)
            words, counts = ([w for g in group for w in g[k]] for k in (1, 2))
            longer, part = (np.array([g[0][k] for g in group]) for k in (0, 1))
            found = links((words, counts), (words, counts), near_places(words, words, len(group), longer, part, True))
            return out(found, [])

        def out(found: list, tiles: list):
            columns = [list(c) for c in zip(*found)] if found else [[], [], []]
            held = [list(c) for c in zip(*tiles)] if tiles else [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c + [None] * len(tiles), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))]
                + [
                    pa.array([None] * len(found) + list(c), t)
                    for c, t in zip(held, (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())))
                ],
                names=["word", "near", "near_n", "longer", "part", "ends", "tile", "words", "counts"],
            )

        for key, words, counts, number, last in cells(iterator, tile):
            if number or not last:
                yield out([], [(*key, number, words, counts)])
            elif len(words) > 1:
                waiting[len(words)].append((key, words, counts))
                if len(waiting[len(words)]) * len(words) ** 2 >= 1 << 17:
                    yield flushed(len(words))
        for size in list(waiting):
            yield flushed(size)

    kept = "longer int, part int, ends string, tile int, words array<string>, counts array<bigint>"
    by = ("longer", "part", "ends")
    return cell_rows.repartition(*by).sortWithinPartitions(*by, "word").mapInArrow(compare, f"{LINKS}, {kept}")


def tile_links(tiles: DataFrame) -> DataFrame:
    """Links within and between the tiles of a cell."""

    def compare(iterator):
        for batch in iterator:
            for longer, part, left, x, n, right, y, m in zip(*(c.to_pylist() for c in batch.columns)):
                at = near_places(x, y, 1, np.array([longer]), np.array([part]), left == right)
                found = links((x, n), (y, m), at)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "near", "near_n"])

    one = tiles.select("longer", "part", "ends", F.col("tile").alias("a"), F.col("words").alias("x"), F.col("counts").alias("n"))
    two = tiles.select("longer", "part", "ends", F.col("tile").alias("b"), F.col("words").alias("y"), F.col("counts").alias("m"))
    pairs = one.join(two, ["longer", "part", "ends"]).where("a <= b")
    return pairs.select("longer", "part", "a", "x", "n", "b", "y", "m").mapInArrow(compare, LINKS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form, by pointer doubling; each round is a written table."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = now.join(ahead, F.col("root") == F.col("at"), "left")
        following = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        dropped(now)
        now = following
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, tile: int = TILE, drawn: int = DRAWN) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each word of at least so many code points and occurrences."""
    ship(docs.sparkSession)
    words = stored(counted_words(docs, least_length, least_count, drawn), "words")
    within = stored(compared(dealt(words), tile), "cells")
    across = tile_links(within.where("words IS NOT NULL"))
    pairs = within.where("word IS NOT NULL").select("word", "near", "near_n").unionByName(across)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "judged",
    )
    dropped(within, words)
    last = roots(judged.where("form IS NOT NULL"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
