"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of character classes,
word measures and repetition, its own and its neighbours'. The field is trained
on labelled documents, all lines of which get the document's label; the score
of a document is the mean of its lines' forward-backward marginals of "good",
weighted by their characters.

Training uses the `sample` labelled ids with the smallest hashes, one text of
each and at most `sample_lines` neighbouring lines from a place in it that a
hash chooses; both are bounds of the training sample only. Every document is scored whole. Null and empty texts, which have no line
with a word, get the share of good documents in the sample; without labels that
is one half and every score is 0.5. Several labels of one id count as one, good
if at least half of them are. Null ids are scored and have no label. No
documents give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, ship, text_bytes, word_hashes

#: Character classes by byte: 1 lower case, 2 upper case, 3 digit, 4 white space, 5 symbol, 6 bar, 7 exclamation, 8 other punctuation, 9 beyond ASCII.
CLASSES = np.zeros(256, np.uint8)
CLASSES[33:127] = 8
CLASSES[ord("a") : ord("z") + 1] = 1
CLASSES[ord("A") : ord("Z") + 1] = 2
CLASSES[ord("0") : ord("9") + 1] = 3
CLASSES[[9, 10, 11, 12, 13, 32]] = 4
CLASSES[[ord(x) for x in "#*$%&<>@^~_=+"]] = 5
CLASSES[ord("|")] = 6
CLASSES[ord("!")] = 7
CLASSES[128:] = 9
#: Features of a line itself.
OWN = 14


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all lines with a word, their document and their number of characters other than white space."""
    data = b"\n".join(texts) + b"\n"
    bytes_ = np.frombuffer(data, np.uint8)
    classes = CLASSES[bytes_]
    line_ends = np.flatnonzero(bytes_ == 10)
    starts = np.r_[0, line_ends[:-1] + 1]
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    document = np.searchsorted(text_ends, starts)
    counts = np.stack([np.add.reduceat((classes == c).view(np.uint8), starts, dtype=np.int64) for c in range(1, 10)], 1)
    visible = counts.sum(1) - counts[:, 3]
    space = classes == 4
    word_at = np.flatnonzero(~space & np.r_[True, space[:-1]])
    word_line = np.searchsorted(line_ends, word_at)
    words = data.split()
    hashes = word_hashes(words, len(words))
    n_words = np.bincount(word_line, minlength=len(starts))
    order = np.lexsort((hashes, word_line))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (word_line[order][1:] != word_line[order][:-1])] if len(words) else np.zeros(0, bool)
    distinct = np.bincount(word_line[order], new, len(starts))
    held = np.flatnonzero(n_words > 0)
    counts, visible, n_words, distinct, document = counts[held], visible[held], n_words[held], distinct[held], document[held]
    if not len(held):
        return np.zeros((0, 3 * OWN + 1)), document, visible
    first_word = np.r_[0, np.cumsum(n_words)[:-1]]
    place = np.arange(len(hashes)) - np.repeat(first_word, n_words)
    echo = np.r_[False, hashes[1:] == hashes[:-1]] & (place > 0)
    echoed = np.add.reduceat(echo.astype(np.int64), first_word)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(hashes * (2 * place + 1).astype(np.uint64), first_word)
    order = np.lexsort((np.arange(len(held)), whole, document))
    again = np.zeros(len(held))
    again[order[1:]] = (whole[order][1:] == whole[order][:-1]) & (document[order][1:] == document[order][:-1])
    letters = np.maximum(counts[:, 0] + counts[:, 1] + counts[:, 8] / 2, 1)
    own = np.column_stack(
        [
            counts[:, 1] / letters,
            counts[:, 2] / visible,
            np.minimum(counts[:, 4] / n_words, 2),
            np.minimum(counts[:, 5] / n_words, 1),
            np.minimum(counts[:, 6] / n_words, 2),
            counts[:, 7] / visible,
            counts[:, 8] / visible,
            np.minimum(visible / n_words, 20) / 20,
            np.log1p(n_words) / 8,
            1 - distinct / n_words,
            echoed / n_words,
            again,
            n_words < 4,
            (counts[:, 4:7].sum(1) > n_words / 2),
        ]
    )
    same = document[1:] == document[:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.column_stack([own, before, after, np.ones(len(own))]), document, visible


def marginals(evidence: np.ndarray, transition: np.ndarray, sizes: np.ndarray, pairs: bool = False):
    """P(good) of every line by forward-backward in logarithms, all chains at once.

    `evidence` is a line's log-odds of good, `transition` the 2x2 log weights
    between neighbours, `sizes` the lines of each chain in order. With `pairs`
    also the expected counts of the four transitions and the log partition sums.
    """
    chains = len(sizes)
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    begins = begins[order]
    score = np.column_stack([np.zeros(len(evidence)), evidence])
    forward = score.copy()
    backward = np.zeros_like(score)
    most = int(falling[0]) if chains else 0
    alive = [int(np.searchsorted(-falling, -t, side="left")) for t in range(most + 1)]  # chains with more than t lines
    for t in range(1, most):
        at = begins[: alive[t]] + t
        last = forward[at - 1]
        forward[at] += np.logaddexp(last[:, :1] + transition[0], last[:, 1:] + transition[1])
    for t in range(most - 2, -1, -1):
        at = begins[: alive[t + 1]] + t
        nxt = score[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(nxt[:, :1] + transition[:, 0], nxt[:, 1:] + transition[:, 1])
    both = forward + backward
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if not pairs:
        return good
    partition = np.logaddexp(both[:, 0], both[:, 1])
    starts = np.zeros(len(evidence), bool)
    starts[begins] = True
    later = np.flatnonzero(~starts)
    expected = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            expected[a, b] = np.exp(forward[later - 1, a] + transition[a, b] + score[later, b] + backward[later, b] - partition[later]).sum()
    return good, expected, float(partition[begins].sum())


def fit(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rounds: int = 300, penalty: float = 1e-4):
    """Weights and transitions by gradient ascent (Adam) on the conditional log-likelihood; classes count alike."""
    good = labels.mean()
    if not 0 < good < 1:
        return np.zeros(features.shape[1]), np.zeros((2, 2))
    line_label = np.repeat(labels, sizes).astype(float)
    stay = np.array([[((sizes - 1) * (labels == 0)).sum(), 0], [0, ((sizes - 1) * (labels == 1)).sum()]], float)
    weights, transition = np.zeros(features.shape[1]), np.zeros((2, 2))
    size = len(features)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, rounds + 1):
        found, expected, _ = marginals(features @ weights, transition, sizes, pairs=True)
        gradients = features.T @ (line_label - found) / size - penalty * weights, (stay - expected) / size - penalty * transition
        for i, gradient in enumerate(gradients):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * gradient
            moments[2 * i + 1] = 0.99 * moments[2 * i + 1] + 0.01 * gradient**2
            change = 0.1 * (moments[2 * i] / (1 - 0.9**step)) / (np.sqrt(moments[2 * i + 1] / (1 - 0.99**step)) + 1e-9)
            if i:
                transition = transition + change
            else:
                weights = weights + change
    return weights, transition


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, sample_lines: int = 100) -> dict:
    """The model, from labelled documents that are not held out; the driver gets the bounded sample's features alone."""
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    rows = known.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def features(iterator):
        for batch in batches(iterator, 2 << 20):
            texts = batch.column(0).to_pylist()
            found, document, _ = line_features(texts)
            for i, label in enumerate(batch.column(1).to_pylist()):
                own = found[np.searchsorted(document, i) : np.searchsorted(document, i, side="right")]
                # Of a longer text a run of neighbouring lines, from anywhere in it by a hash.
                start = zlib.crc32(texts[i]) % max(1, len(own) - sample_lines + 1)
                own = own[start : start + sample_lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label], pa.int32()), pa.array([len(own)], pa.int32()), pa.array([own.astype("<f4").tobytes()], pa.binary())],
                    names=["label", "lines", "features"],
                )

    got = rows.select(text_bytes().alias("text"), "label").mapInArrow(features, "label int, lines int, features binary").collect()
    if not got:
        return {"prior": 0.5, "weights": np.zeros(3 * OWN + 1), "transition": np.zeros((2, 2))}
    prior = float(np.mean([r["label"] for r in got]))
    got = [r for r in got if r["lines"]]
    if not got:
        return {"prior": prior, "weights": np.zeros(3 * OWN + 1), "transition": np.zeros((2, 2))}
    width = 3 * OWN + 1
    matrix = np.concatenate([np.frombuffer(r["features"], "<f4").reshape(-1, width) for r in got]).astype(float)
    weights, transition = fit(matrix, np.array([r["lines"] for r in got]), np.array([r["label"] for r in got]))
    return {"prior": prior, "weights": weights, "transition": transition}


def scores(texts: list[bytes], model: dict) -> np.ndarray:
    features, document, visible = line_features(texts)
    found = np.full(len(texts), model["prior"])
    if len(features):
        lines = np.bincount(document, minlength=len(texts))
        good = marginals(features @ model["weights"], model["transition"], lines[lines > 0])
        held = np.bincount(document, visible, len(texts))
        mean = np.bincount(document, visible * good, len(texts)) / np.maximum(held, 1)
        found = np.where(held > 0, mean, found)
    return np.clip(found, 0.0, 1.0)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **sample) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of `docs`; only the text enters a score."""
    model = train(docs, labels, **sample)

    def score(iterator):
        for batch in batches(iterator, 2 << 20):
            found = scores(batch.column(0).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found)], names=["doc_id", "score"])

    scored = docs.select(text_bytes().alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
