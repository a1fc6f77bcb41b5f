"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyboard.llm import spellings

from .conftest import ODD


def brute(rows, drawn=199, least=6, count=5, ratio=5):
    total = Counter()
    for doc, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            total[run if h % drawn else run[:at] + run[at + 1 :]] += 1
    words = {w: n for w, n in total.items() if len(w) >= least and n >= count}
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a != b and abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].add(b)
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def misspelt(seed, count=40):
    """Texts of a few words, each in many spellings of falling counts."""
    draw = random.Random(seed)
    letters = "abcdeé÷ÀÿZ"
    stems = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 12))) for _ in range(12)] + ["aaaaaa", "aaaaaaa", "ababababab"]
    words = []
    for stem in stems:
        for weight in (200, 30, 6, 6, 5, 1):
            words += [stem] * weight
            at = draw.randrange(len(stem))
            stem = draw.choice([stem[:at] + stem[at + 1 :], stem[:at] + draw.choice(letters) + stem[at:], stem[:at] + draw.choice(letters) + stem[at + 1 :]])
    draw.shuffle(words)
    seps = [" ", "\n", "1", "’", "Ā", "¿", ", "]
    texts = [""] * count
    for i, word in enumerate(words):
        texts[i % count] += word + draw.choice(seps)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, tile, drawn", [(1, 256, 199), (2, 2, 3), (3, 3, 7)])
def test_variants(docs, seed, tile, drawn):
    rows = misspelt(seed)
    got = spellings.spelling_variants(docs(rows), tile=tile, drawn=drawn).collect()
    want = brute(rows, drawn)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r[1] and r[2] != r[1] for r in want) or drawn == 3  # some chains of forms


def test_large_cells_go_through_tiles(docs):
    rows = [(0, " ".join(f"wordss{a}{b}" for a in "abcdefghij" for b in "klmnopqrst") + " ") for _ in range(5)]
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    want = brute(rows, 10**9)
    for tile in (4, 1000):
        assert {tuple(r) for r in spellings.spelling_variants(docs(rows), tile=tile, drawn=10**9).collect()} == want


def test_stacked_blocks_and_row_slices(monkeypatch):
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("ab") for _ in range(8)) for _ in range(90)})
    every = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for cells in (64, 1 << 22):
        monkeypatch.setattr(spellings, "CELLS", cells)
        found = set()
        for part in range(spellings.PARTS):
            i, j = spellings.near_places(words, words, 1, np.array([8]), np.array([part]), True)
            pairs = {(words[a], words[b]) for a, b in zip(i, j)}
            assert not pairs & found  # a pair belongs to one interval
            found |= pairs
        assert found == every


def test_odd_rows(docs):
    odd = [*ODD, (None, "letter letter"), (None, "letter letter"), (1, "letter LETTER letter")]
    table = docs([(d, t, "x", 1) for d, t in odd], ", word string, n int")
    assert {tuple(r) for r in spellings.spelling_variants(table).collect()} == brute(odd)
    assert spellings.spelling_variants(docs([])).collect() == []
    assert spellings.spelling_variants(docs([(1, None), (2, "")])).collect() == []


def test_very_long_texts(docs, monkeypatch):
    draw = random.Random(3)
    words = ["banana", "bananas", "bananna", "cabbage"]
    rows = [(1, " ".join(draw.choices(words, [40, 4, 1, 30], k=200_000))), (2, "x" * 2_000_000), (3, "Éclair1" * 9)]
    assert {tuple(r) for r in spellings.spelling_variants(docs(rows)).collect()} == brute(rows)
    assert [p for p in spellings.runs(b"ab cd-ef gh", 3)] == [[b"ab", b"cd"], [b"ef"], [b"gh"]]
