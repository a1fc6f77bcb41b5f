"""Fuzzy deduplication of lines.

Lines are normalised: lower case, words parted by single spaces; digits and
punctuation count. Equal lines are one. Two others are near if at most 10% of
the words of the longer one, rounded down, must be inserted, deleted or
replaced, and none of these holds a digit: lines that differ in a figure, a year
or an amount tell different facts. So an edit is tolerated from ten words on.

Candidates are joined by pigeonhole over runs of RUN words, two here: an edit
breaks at most two of them, so where e edits are allowed, the 2e + 1 first runs of
two lines, in one order of all runs, have one in common, whatever the order. Runs
that are frequent in a sample come last, which only keeps the keys small.
Candidates must agree in their figures and, as an edit changes at most two bits
of it, nearly in the parity of their words, then in a wider one; the rest is verified, first by the
words that one line has and the other lacks, then by the edit distance. No pair
that the rule accepts is lost. Of each connected group the first occurrence
stays, by id, text and line number.

This is not SimHash: near lines differ in up to 42 of 64 of its bits, and blocks
that find nine in ten of them need some fifty keys a line (see the README).

Lines of fewer than `min_words` words are too short to be told from phrases that
writers share: they go only where `short_documents` documents or more hold them.
Lines without words always stay. Null and empty texts stay as they are. Rows
with equal id and text are one document and lose the same lines; null ids come
first. A line may be as long as a text. Further columns of the caller pass
whatever they are called; one called lines_removed is replaced. No documents
give no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, dropped, mixed, packed_row, ship, stored, text_bytes, word_hashes
from .links import linked, paired
from .near import text_key

#: Words of a run that is a key. Documents whose runs are counted for the order of all runs, and the commonest runs that are told apart by their count.
RUN = 2
#: Numbers of 64 bits that hold the parities by which candidates are told before their words are read.
WIDE = 4
SAMPLE, COMMON = 4000, 1 << 16
_DIGIT = re.compile(rb"[0-9]")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def normalised(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode()


def line_words(line: bytes) -> np.ndarray:
    """The normalised words of a line as hashes, odd for words with a digit."""
    words = normalised(line).split()
    digit = np.fromiter((bool(_DIGIT.search(w)) for w in words), bool, len(words))
    return told_figures(word_hashes(words, len(words)), digit)


def told_figures(hashes: np.ndarray, digit: np.ndarray) -> np.ndarray:
    return (hashes & ~np.uint64(1)) | digit.astype(np.uint64)


class Lines:
    """The words of all lines of some texts: hashes, the sizes and begins of lines, each word's line, words with digits."""

    def __init__(self, texts: list[bytes]):
        texts = [normalised(text) for text in texts]
        data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero(raw == 10)
        text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        self.row = np.searchsorted(text_ends, ends)
        self.number = np.arange(len(ends)) - np.searchsorted(ends, np.r_[-1, text_ends[:-1]] + 1)[self.row]
        space = _SPACE[raw]
        at = np.flatnonzero(~space & np.r_[True, space[:-1]])
        words = data.split()
        self.words = word_hashes(words, len(words))
        digit = (raw >= 48) & (raw <= 57)
        self.figure = np.add.reduceat(digit, at, dtype=np.int64) > 0 if len(at) else np.zeros(0, bool)
        self.words = told_figures(self.words, self.figure)
        self._measure(np.searchsorted(ends, at), len(ends))

    def _measure(self, line: np.ndarray, lines: int) -> None:
        self.line, self.sizes = line, np.bincount(line, minlength=lines)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def keep(self, chosen: np.ndarray) -> None:
        """Leaves the chosen lines only."""
        words = chosen[self.line]
        self.words, self.figure = self.words[words], self.figure[words]
        self.row, self.number = self.row[chosen], self.number[chosen]
        self._measure((np.cumsum(chosen) - 1)[self.line[words]], int(chosen.sum()))

    def place(self) -> np.ndarray:
        return np.arange(len(self.words)) - self.begins[self.line]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of some 64-bit values of the words of each line; every line has a word."""
        return np.add.reduceat(values, self.begins)

    def figures(self) -> np.ndarray:
        """A hash of the words with digits of each line, in their order."""
        before = np.cumsum(self.figure) - self.figure
        order = before - before[self.begins][self.line]
        return self.sums(np.where(self.figure, mixed(self.words ^ mixed(order.astype(np.uint64) + np.uint64(7))), np.uint64(0)))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each word and its followers in the line, and their lines."""
        first = self.line[: max(len(self.line) - RUN + 1, 0)]
        whole = first == self.line[RUN - 1 :]
        hashes = self.words
        for _ in range(RUN - 1):
            hashes = chained(hashes, self.words)
        return hashes[whole], first[whole]


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether so many insertions, deletions and replacements turn a into b, by furthest-reaching diagonals."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False

    def slide(i: int, j: int) -> int:
        width = 16
        while i < n and j < m:
            size = min(width, n - i, m - j)
            differ = np.flatnonzero(a[i : i + size] != b[j : j + size])
            if len(differ):
                return i + int(differ[0])
            i, j, width = i + size, j + size, 2 * width
        return i

    reach = {0: slide(0, 0)}
    for edits in range(most + 1):
        if reach.get(n - m, -1) >= n:
            return True
        if edits == most:
            return False
        following = {}
        for d in range(-edits - 1, edits + 2):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2) + 1, reach.get(d + 1, -2))
            if i < 0:
                continue
            i = min(i, n, m + d)
            if i >= 0 and i - d >= 0:
                following[d] = slide(i, i - d)
        reach = following
    return False


def allowed(words: np.ndarray, percent: int) -> np.ndarray:
    """The most edits between a line of so many words and any line near it, itself up to 100 / percent as long."""
    return (100 - percent) * (100 * words // percent) // 100


def tokens(words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word and how often it came before in its line; with their lines, which stay in order."""
    keys = (line.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24))
    keys.sort()
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    before = np.arange(len(keys)) - np.repeat(new, np.diff(np.r_[new, len(keys)]))
    with np.errstate(over="ignore"):
        numbers = mixed((keys & np.uint64(2**40 - 1)) + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers, (keys >> np.uint64(40)).astype(np.int64)


def first_runs(lines: Lines, most: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line with edits allowed the RUN * `most` + 1 first tokens in the order of all tokens, and how many these are.

    A token is ordered and named by 44 bits: its rank among the common ones and
    28 of its own. Tokens of one name only make more candidates.
    """
    runs, line = lines.runs()
    sizes = np.maximum(lines.sizes - RUN + 1, 0)
    found, counts = [np.zeros(0, np.uint64)], np.where(most > 0, np.minimum(RUN * most + 1, sizes), 0)
    begins = np.cumsum(sizes) - sizes
    for start in range(0, len(sizes), 1 << 20):
        own = slice(start, start + (1 << 20))
        line = np.repeat(np.arange(len(sizes[own])), sizes[own])
        numbers, line = tokens(runs[begins[start] : begins[start] + len(line)], line)
        rank = np.zeros(len(numbers), np.uint64)
        if len(common):
            at = np.minimum(np.searchsorted(common, numbers), len(common) - 1)
            rank = np.where(common[at] == numbers, ranks[at], np.uint64(0))
        names = (line.astype(np.uint64) << np.uint64(44)) | (rank << np.uint64(28)) | (numbers >> np.uint64(36))
        names.sort()
        place = np.arange(len(names)) - (begins[own] - begins[start])[line]
        found.append(names[place < counts[own][line]] & np.uint64(2**44 - 1))
    return np.concatenate(found), counts


def parities(words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64 bits of each line: whether an odd number of its words falls to a bit. One edit changes at most two of them."""
    return np.bitwise_xor.reduceat(np.uint64(1) << (mixed(words) & np.uint64(63)), begins)


def wide_parities(words: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """As `parities`, of WIDE * 64 bits: lines of hundreds of words are told apart by them too."""
    spread = mixed(words ^ np.uint64(0x5851F42D4C957F2D))
    bit, part = np.uint64(1) << (spread & np.uint64(63)), (spread >> np.uint64(32)) % np.uint64(WIDE)
    return [np.bitwise_xor.reduceat(np.where(part == i, bit, np.uint64(0)), begins) for i in range(WIDE)]


def common_runs(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The commonest tokens of sampled documents, sorted, and their ranks from 1, the commonest last."""
    share = sample / max(docs.count(), 1)
    drawn = docs.where(F.pmod(text_key(), F.lit(1_000_000)) < share * 1_000_000)

    def count(iterator):
        for batch in batches(iterator, 1 << 20):
            lines = Lines(batch.column(0).to_pylist())
            numbers, _ = tokens(*lines.runs())
            numbers, n = np.unique(numbers, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), pa.array(n)], names=["token", "n"])

    counted = drawn.select(text_bytes().alias("text")).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.where("n > 1").orderBy(F.desc("n"), "token").limit(COMMON - 1).collect()
    common = np.array([r.token for r in top], np.int64).view(np.uint64)
    order = np.argsort(common)
    return common[order], (len(top) - order).astype(np.uint64)


def all_lines(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_key, line, the hash of the normalised line, its parity, figures, word count, keys and wide parity, for all lines with words."""
    common, ranks = common_runs(docs)

    def measure(iterator):
        for batch in batches(iterator, 1 << 20):
            lines = Lines(batch.column(0).to_pylist())
            lines.keep(lines.sizes > 0)
            if not len(lines.sizes):
                continue
            place = lines.place().astype(np.uint64)
            high, low = (lines.sums(mixed(lines.words ^ mixed(place + np.uint64(seed)))) for seed in (1, 1 << 40))
            keys, counts = first_runs(lines, allowed(lines.sizes, percent), common, ranks)
            taken = pa.array(lines.row)
            wide = np.stack(wide_parities(lines.words, lines.begins), 1).ravel().view(np.int64)
            numbers = (high, low, parities(lines.words, lines.begins), lines.figures())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(taken),
                    batch.column(2).take(taken),
                    pa.array(lines.number.astype(np.int32)),
                    *(pa.array(x.view(np.int64)) for x in numbers),
                    pa.array(lines.sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(keys.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(lines.sizes) + 1, dtype=np.int32) * WIDE), pa.array(wide)),
                ],
                names=["doc_id", "text_key", "line", "high", "low", "parity", "figures", "n_words", "keys", "wide"],
            )

    return docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")).mapInArrow(
        measure, "doc_id long, text_key long, line int, high long, low long, parity long, figures long, n_words int, keys array<bigint>, wide array<bigint>"
    )


def repeated_lines(docs: DataFrame, min_words: int = 5, percent: int = 90, short_documents: int = 20) -> DataFrame:
    """(doc_id, text_key, lines): the numbers of the lines to remove from each document that loses any."""
    ship(docs.sparkSession)
    every = stored(all_lines(docs, percent).withColumn("row", F.monotonically_increasing_id()), "lines")
    short = F.col("n_words") < min_words
    holders = every.where(short).select("high", "low", "doc_id", "text_key").distinct()
    widely = holders.groupBy("high", "low").count().where(F.col("count") >= short_documents).select("high", "low")
    counted = every.where(~short).unionByName(every.where(short).join(widely, ["high", "low"], "left_semi"))
    distinct = stored(
        counted.groupBy("high", "low").agg(
            F.min("row").alias("node"),
            F.min(F.struct("doc_id", "text_key", "line")).alias("first"),
            F.count("*").alias("held"),
            *(F.first(x).alias(x) for x in ("parity", "figures", "n_words", "keys", "wide")),
        ),
        "distinct",
    )
    # The keys are the bulk of both tables: each is dropped as soon as a slim one is written.
    slim = stored(every.select("doc_id", "text_key", "line", "high", "low"), "slim")
    dropped(every)

    def within(a: str, b: str, apart: Column) -> Column:
        n, m = F.col(f"{a}n_words"), F.col(f"{b}n_words")
        edits = F.floor((100 - percent) * F.greatest(n, m) / 100)
        return (apart <= 2 * edits - F.abs(n - m)) & (100 * n >= percent * m) & (100 * m >= percent * n)

    def close(a: str, b: str) -> Column:
        return within(a, b, F.bit_count(F.col(f"{a}parity").bitwiseXOR(F.col(f"{b}parity"))))

    # Lines near each other have the same figures, so these belong to the key.
    keyed = distinct.select("node", "parity", "n_words", "figures", F.explode(F.array_distinct("keys")).alias("run"))
    met = paired(keyed.select(F.xxhash64("run", "figures").alias("key"), "node", "parity", "n_words"), may_be_close(percent))
    nodes = stored(distinct.select("node", "first", "held", "high", "low", "n_words", "wide"), "nodes")
    dropped(distinct)

    def verified(pairs: DataFrame) -> DataFrame:
        one, two = (nodes.select(F.col("node").alias(x), *(F.col(y).alias(f"{x}_{y}") for y in ("n_words", "wide"))) for x in "ab")
        bits = (F.bit_count(F.col("a_wide")[i].bitwiseXOR(F.col("b_wide")[i])) for i in range(WIDE))
        candidates = stored(pairs.join(one, "a").join(two, "b").where(within("a_", "b_", sum(bits))).select("a", "b"), "candidates")
        asked = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        words = stored(words_of(docs, nodes.join(asked, "node", "left_semi").select("node", "first.*")), "words")
        links = stored(similar(candidates, words, percent), "links")
        dropped(candidates, words)
        return links

    labels = linked(met, verified, close)
    grouped = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = grouped.groupBy("label").agg(F.min("first").alias("group_first"), F.sum("held").alias("group_held"))
    again = grouped.join(groups.where("group_held > 1"), "label").select("high", "low", "group_first")
    here = F.struct("doc_id", "text_key", "line")
    gone = slim.join(again, ["high", "low"]).where(~here.eqNullSafe(F.col("group_first")))
    result = stored(gone.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines")), "gone")
    dropped(slim, nodes)
    return result


def may_be_close(percent: int):
    """What two near lines' parities and numbers of words agree to, on arrays."""

    def close(a: dict, b: dict) -> np.ndarray:
        n, m = a["n_words"], b["n_words"]
        edits = (100 - percent) * np.maximum(n, m) // 100
        apart = np.bitwise_count(a["parity"].view(np.uint64) ^ b["parity"].view(np.uint64)).astype(np.int64)
        return (apart <= 2 * edits - abs(n - m)) & (100 * n >= percent * m) & (100 * m >= percent * n)

    return close


def words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) of the lines (node, doc_id, text_key, line); a text is read once for all its lines."""
    asked = wanted.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_list(F.struct("line", "node")).alias("asked"))
    texts = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    found = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))

    def build(iterator):
        for batch in batches(iterator, 2 << 20):
            nodes, words = [], []
            for text, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                split = text.split(b"\n")
                for one in lines:
                    nodes.append(one["node"])
                    words.append(line_words(split[one["line"]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(words, pa.binary())], names=["node", "words"])

    built = found.select(text_bytes().alias("text"), "asked").mapInArrow(build, "node long, words binary")
    return built.groupBy("node").agg(F.first("words").alias("words"))


def may_be_near(left: list[np.ndarray], right: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Whether each of two lists of lines lacks at most `most` words of the other, however often they are there.

    An edit puts in or takes out one word of either line at most.
    """
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    pair = np.concatenate([np.repeat(np.arange(len(most)), n) for n in sizes])
    side = np.repeat(np.array([1, -1]), [n.sum() for n in sizes])
    words = np.concatenate([*left, *right]) if len(pair) else np.zeros(0, np.uint64)
    keys = (pair.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24))
    order = np.argsort(keys, kind="stable")
    keys, side = keys[order], side[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[: len(keys)]
    excess = np.add.reduceat(side, first) if len(keys) else np.zeros(0, np.int64)
    of = (keys[first] >> np.uint64(40)).astype(np.int64)
    over, under = (np.bincount(of, np.maximum(sign * excess, 0), len(most)) for sign in (1, -1))
    return np.maximum(over, under) <= most


def chained(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hash of each run, made one word longer; a run ends where its last word does."""
    with np.errstate(over="ignore"):
        return mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[len(words) - len(hashes) + 1 :])


def same_figures(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the words with digits are the same, in the same order."""
    return np.array_equal(x[x & np.uint64(1) == 1], y[y & np.uint64(1) == 1])


def near_lines(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether so many edits turn one line into the other; what both begin and end with is left aside."""
    shorter = min(len(x), len(y))
    differ = np.flatnonzero(x[:shorter] != y[:shorter])
    same = int(differ[0]) if len(differ) else shorter
    x, y, shorter = x[same:], y[same:], shorter - same
    differ = np.flatnonzero(x[len(x) - shorter :][::-1] != y[len(y) - shorter :][::-1])
    same = int(differ[0]) if len(differ) else shorter
    return edits_within(x[: len(x) - same], y[: len(y) - same], most)


def similar(pairs: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The pairs whose words differ by few enough edits for their length."""
    one = words.select(F.col("node").alias("a"), F.col("words").alias("left"))
    two = words.select(F.col("node").alias("b"), F.col("words").alias("right"))

    def compare(iterator):
        for batch in iterator:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                left, right = ([np.frombuffer(w, np.uint64) for w in part.column(c).to_pylist()] for c in (2, 3))
                most = np.array([(100 - percent) * max(len(x), len(y)) // 100 for x, y in zip(left, right)])
                keep = may_be_near(left, right, most)
                # An edit breaks two pairs of neighbours: words in another order are told here.
                keep &= may_be_near([chained(x, x) for x in left], [chained(x, x) for x in right], 2 * most)
                for i in np.flatnonzero(keep):
                    keep[i] = same_figures(left[i], right[i]) and near_lines(left[i], right[i], int(most[i]))
                rows = part.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays(rows.columns[:2], names=["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def without_repeated_lines(docs: DataFrame, min_words: int = 5, percent: int = 90, short_documents: int = 20) -> DataFrame:
    """`docs` without the repeated lines in the text, and lines_removed, their number."""
    gone = repeated_lines(docs, min_words, percent, short_documents)
    gone = gone.select(F.struct(F.col("doc_id"), F.col("text_key")).alias("document"), F.col("lines").alias("gone"))
    # The caller's columns are packed while others stand beside them.
    held = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")).alias("document"), packed_row(docs))
    joined = held.join(gone, held["document"].eqNullSafe(gone["document"]), "left").select("row", "gone")
    whole = F.col("row").getField("text")
    rest = F.filter(F.split(whole, "\n", -1), lambda x, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(rest, "\n"))
    kept = [(text if x == "text" else F.col("row").getField(x)).alias(x) for x in docs.columns if x != "lines_removed"]
    return joined.select(*kept, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"))
