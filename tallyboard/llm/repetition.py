"""Quality rules on repetition inside a document, by suffix arrays of words.

Suffixes of all documents of a slice are sorted at once by prefix doubling;
words are ranked within their document, so that only repeats inside a document
meet. Common prefixes of neighbours in the suffix array give the LCP intervals,
hence the maximal repeated substrings; their spans are united. A document is
rejected if the spans cover too much of it or one repeat is too long.

Null and empty texts have no words and fail the base rule. Null ids and
repeated rows are judged like any other row. No documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, mixed, quoted, ship, text_bytes, word_hashes

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
#: Words of a window of the base rule, and the least words of a repeat that the method counts.
WINDOW, SPAN = 8, 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def suffix_ranks(words: np.ndarray, document: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until none are equal.

    `document` is each word's document, `ends` the end of that document. At
    every level equal ranks mean equal words; at the last level the ranks are
    the inverse of the suffix array.
    """
    size = len(words)
    keys = mixed(words ^ mixed(document.astype(np.uint64) + np.uint64(1)))
    order = np.lexsort((keys, document))
    ordered = keys[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]) | (document[order][1:] != document[order][:-1])]
    starts = np.flatnonzero(new)
    rank = np.empty(size, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, size]))
    shared = np.repeat(np.diff(np.r_[starts, size]) > 1, np.diff(np.r_[starts, size]))
    active = order[shared]
    levels, step = [rank], 1
    while len(active):
        after = active + step
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, size - 1)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        active, first, second = active[order], first[order], second[order]
        group = np.r_[True, first[1:] != first[:-1]]
        new = group | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(active))
        begin = np.maximum.accumulate(np.where(group, at, 0))
        part = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = first + part - begin
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(active)])
        active = active[np.repeat(sizes > 1, sizes)]
        levels.append(rank)
        step *= 2
    return levels


def repeats(words: np.ndarray, document: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run from there that occurs elsewhere in its document."""
    size = len(words)
    longest = np.zeros(size, np.int64)
    if not size:
        return longest
    levels = suffix_ranks(words, document, ends)
    wanted = SPAN.bit_length() - 1  # words that neighbours share at this level are too few to count, or just enough
    if len(levels) <= wanted:
        return longest
    suffixes = np.empty(size, np.int64)
    suffixes[levels[-1]] = np.arange(size)
    same = levels[wanted][suffixes]
    pair = np.flatnonzero(same[1:] == same[:-1])
    left, right = suffixes[pair], suffixes[pair + 1]
    common = np.zeros(len(pair), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < ends[left]) & (b < ends[right])
        a, b = np.minimum(a, size - 1), np.minimum(b, size - 1)
        common += np.where(inside & (levels[level][a] == levels[level][b]), 1 << level, 0)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def spans(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least so many words."""
    begin = np.flatnonzero(longest >= least)
    edges = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + longest[begin], -1)
    return np.cumsum(edges[:-1]) > 0


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text."""
    split = [text.split() for text in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    words = word_hashes((w for x in split for w in x), int(sizes.sum()))
    bounds = np.r_[0, np.cumsum(sizes)]
    document = np.repeat(np.arange(len(texts)), sizes)
    longest = repeats(words, document, np.repeat(bounds[1:], sizes))
    windowed = spans(np.minimum(longest, WINDOW), WINDOW)
    covered = spans(longest, SPAN)
    found = {"n_words": sizes}
    found["word_chars"] = np.array([len(t.decode("utf-8", "replace")) - sum(map(t.count, SPACES)) for t in texts], np.int64)
    found["n_symbols"] = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
    found["n_dup_lines"] = np.array([_repeated_lines(t) for t in texts], np.int64)
    found["n_repeat_words"] = np.bincount(document, windowed, len(texts)).astype(np.int64)
    found["covered_words"] = np.bincount(document, covered, len(texts)).astype(np.int64)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, document, longest)
    found["longest_repeat"] = np.where(most >= SPAN, most, 0)
    return found


def _repeated_lines(text: bytes) -> int:
    seen, count = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            count += line in seen
            seen.add(line)
    return count


def repetition_rules(
    docs: DataFrame,
    max_covered: float = 0.30,
    max_longest: int = 60,
    min_words: int = 20,
    max_repeat_words: float = 0.30,
) -> DataFrame:
    """doc_id, the counts, covered_words, longest_repeat, base_failed and kept; one row per row of `docs`.

    base_failed: fewer than `min_words` words, or more than `max_repeat_words`
    of them in repeated 8-word windows. The method rejects a document of which
    repeats of 5 words or more cover more than `max_covered`, or that has a
    repeat of more than `max_longest` words.
    """
    ship(docs.sparkSession)

    def measure(iterator):
        for batch in batches(iterator, 2 << 20):
            found = measures(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(found[x]) for x in COUNTS)], names=["doc_id", *COUNTS]
            )

    counted = docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        measure, "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS)
    )
    return judged(counted, max_covered, max_longest, min_words, max_repeat_words)


def judged(counted: DataFrame, max_covered: float, max_longest: int, min_words: int, max_repeat_words: float) -> DataFrame:
    share, allowed = round(100 * max_repeat_words), round(100 * max_covered)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > share * F.col("n_words"))
    repeated = (100 * F.col("covered_words") > allowed * F.col("n_words")) | (F.col("longest_repeat") > max_longest)
    return counted.withColumn("base_failed", base).withColumn("kept", ~base & ~repeated)


def without_repetitive(docs: DataFrame, **limits) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns, whatever they are called; decided row by row without a join."""
    ship(docs.sparkSession)
    rules = {"max_covered": 0.30, "max_longest": 60, "min_words": 20, "max_repeat_words": 0.30} | limits
    share, allowed = round(100 * rules["max_repeat_words"]), round(100 * rules["max_covered"])
    names = docs.columns
    # By position: a name of the caller's may be any text.
    fields = [T.StructField(f"c{i}", field.dataType) for i, field in enumerate(docs.schema)]
    marked = docs.select(text_bytes(), *quoted(docs)).toDF("text", *(f.name for f in fields))

    def keep(iterator):
        for batch in batches(iterator, 2 << 20):
            found = measures(batch.column(0).to_pylist())
            n, again = found["n_words"], found["n_repeat_words"]
            base = (n < rules["min_words"]) | (100 * again > share * n)
            repeated = (100 * found["covered_words"] > allowed * n) | (found["longest_repeat"] > rules["max_longest"])
            rows = batch.filter(pa.array(~base & ~repeated))
            yield pa.RecordBatch.from_arrays(rows.columns[1:], names=[f.name for f in fields])

    return marked.mapInArrow(keep, T.StructType(fields)).toDF(*names)
