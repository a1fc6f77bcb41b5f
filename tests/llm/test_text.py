"""Repeated passages, near duplicates, repetition rules and fuzzy lines against plain versions."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from tallyboard.llm import lines, near, phrases, repetition

from . import brute
from .conftest import ODD


def corpus(seed=1, count=60):
    """Documents that share passages, copies and near copies."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 3000)}"
    passages = [[word() for _ in range(draw.randint(10, 70))] for _ in range(6)]
    rows = []
    for i in range(count):
        kind = i % 6
        if kind == 5 and rows:
            own = draw.choice(rows)[1].split(" ")
            own = list(own)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = word()
        else:
            own = [word() for _ in range(draw.randint(1, 120))]
            if kind in (1, 2, 3):
                at = draw.randint(0, len(own))
                own[at:at] = draw.choice(passages)
            if kind == 3:
                own += own[:45]
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_windows(docs, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.without_repeats(docs(rows)).collect()}
    assert got == brute.repeated(rows, 20)


def test_sliding_extremes():
    values = np.array([5, 3, 9, 1, 7, 7, 2, 8], np.uint64)
    for width in range(1, 8):
        for least, pick in ((True, min), (False, max)):
            expected = [pick(values[i : i + width]) for i in range(len(values) - width + 1)]
            assert phrases._slide(values, width, least).tolist() == expected


def test_repeated_windows_of_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(25))
    rows = [*ODD, (9, long), (9, long), (10, long), (None, long)]
    table = docs([(d, t, 1, 2) for d, t in rows], ", n_words int, starts int")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in phrases.without_repeats(table).collect())
    assert len(got) == len(rows)
    assert [x for x in got if x[1] == 25] == [(-1, 25, 0), (9, 25, 25), (9, 25, 25), (10, 25, 25)]  # a null id comes first
    assert phrases.without_repeats(docs([])).count() == 0


@pytest.mark.parametrize("leaders", [1, 8])
def test_near_duplicates(docs, monkeypatch, leaders):
    monkeypatch.setattr("tallyboard.llm.links.LEADERS", leaders)
    rows = corpus(3, 90) + [(100 + i, "Short  one") for i in range(3)] + [(104, "short ONE"), (105, "É one"), (106, "é one")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(docs(rows)).collect()}
    assert got == brute.near(rows)


def test_a_chain_of_near_copies_is_one_group(docs, monkeypatch):
    monkeypatch.setattr("tallyboard.llm.links.LEADERS", 2)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(25):  # each differs from the one before by one word
        base[3 * i] = f"x{i}"
        rows.append((i, " ".join(base)))
    got = near.near_duplicates(docs(rows)).collect()
    want = brute.near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert {c for _, c in want.values()} == {0}


def test_a_repeated_row_that_shares_a_passage(docs):
    passage = [f"p{i}" for i in range(30)]
    one, two = " ".join(["a", *passage, "b"]), " ".join(["c", *passage, "d"])
    got = sorted((r.doc_id, r.n_removed) for r in phrases.without_repeats(docs([(1, one), (1, one), (2, two), (2, two)])).collect())
    assert got == [(1, 0), (1, 0), (2, 30), (2, 30)]


def test_near_duplicates_of_odd_rows(docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [*ODD, (20, text), (21, text), (21, text), (None, text + " z")]
    table = docs([(d, t, "k", 5) for d, t in rows], ", kept string, node int")
    got = near.near_duplicates(table).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = near.without_near_duplicates(table)
    assert left.columns == table.columns
    # The empty ones stay, apart from repeated rows: equal id and text are one document.
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted(
        [(-1, ""), (3, ""), (4, ""), (5, " \n\t "), (6, "a b"), (7, "x"), (7, "y z"), (20, text)]
    )
    assert near.near_duplicates(docs([])).count() == 0 and near.without_near_duplicates(docs([])).count() == 0


def test_groups_of_null_ids_stay_apart(docs):
    table = docs([(None, "a b c d e f"), (None, "p q r s t u"), (None, "A b c d e f")])
    assert near.without_near_duplicates(table).count() == 2


def test_repetition_against_all_pairs():
    draw = random.Random(3)
    texts = []
    for k in range(60):
        own = [draw.choice("abcdefgh") if k % 3 else str(draw.randint(0, 10**6)) for _ in range(draw.randint(0, 150))]
        texts.append(" ".join(own + own[3:25] + ["z"] + own[:9] if k % 4 == 0 else own).encode())
    found = repetition.measures(texts)
    for i, text in enumerate(texts):
        runs = brute.longest_repeats(text.split())
        eight, five = set(), set()
        for a, n in enumerate(runs):
            eight.update(range(a, a + 8) if n >= 8 else ())
            five.update(range(a, a + n) if n >= 5 else ())
        longest = max(runs, default=0)
        assert found["n_repeat_words"][i] == len(eight) and found["covered_words"][i] == len(five)
        assert found["longest_repeat"][i] == (longest if longest >= 5 else 0)


def test_base_counts_of_odd_texts(docs):
    rows = [(1, "é ü|#\nab\n\nab\n ab\n$"), (2, None), (3, ""), (4, "\x1c\x85 a b\v")]
    got = {r.doc_id: r for r in repetition.repetition_rules(docs([(*r, 1) for r in rows], ", n_words int")).collect()}
    assert (got[1].n_words, got[1].word_chars, got[1].n_symbols, got[1].n_dup_lines) == (6, 11, 3, 1)
    assert (got[4].n_words, got[4].word_chars) == (2, 5)
    assert all(r.base_failed and not r.kept for r in got.values())
    assert repetition.repetition_rules(docs([])).count() == 0


def test_limits_of_the_method(docs):
    plain = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(plain)), (2, " ".join(plain + plain[:61])), (3, " ".join(plain + plain[:60])), (4, " ".join(plain[:60] + plain[:7] + ["x"] + plain[20:27] + ["y"] + plain[40:47]))]
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.repetition_rules(docs(rows)).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (False, True), 4: (False, False)}
    table = docs([(*r, "k") for r in rows], ", kept string")
    assert sorted(r.doc_id for r in repetition.without_repetitive(table).collect()) == [1, 3]


def test_edit_bound():
    draw = random.Random(4)
    for _ in range(800):
        a = [draw.randint(0, 5) for _ in range(draw.randint(0, 14))]
        b = [x for x in a if draw.random() > 0.1]
        for _ in range(draw.randint(0, 3)):
            b.insert(draw.randint(0, len(b)), draw.randint(0, 5))
        for most in range(6):
            assert lines.edits_within(np.array(a), np.array(b), most) == (brute.edits(a, b) <= most)


def letters(n):
    return "".join("abcdefghij"[int(c)] for c in str(n))


def line_corpus():
    draw = random.Random(9)
    base = [[f"word{letters(draw.randint(0, 900))}" for _ in range(draw.randint(5, 70))] for _ in range(40)]
    rows = []
    for i in range(70):
        own = []
        for _ in range(draw.randint(1, 5)):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 2)):
                line[draw.randrange(len(line))] = f"Word{letters(draw.randint(0, 900))},"
            own.append(" ".join(line))
        own.append("too short")
        rows.append((i, "\n".join(own)))
    return rows


def plain_words(line):
    """Lower-cased words of a line, by the six white-space characters."""
    return [w for w in re.split("[\x20\x09-\x0D]+", line.lower()) if w]


def near_lines(a, b):
    """The rule itself: equal words, or a tenth of them edited and every word with a digit the same."""
    most = max(len(a), len(b)) // 10
    if a == b:
        return True
    if not most or abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
        return False  # an edit changes the length by one and two words at most
    figures = [[w for w in x if re.search("[0-9]", w)] for x in (a, b)]
    return figures[0] == figures[1] and brute.edits(a, b) <= most


def brute_lines(rows, short_documents=20):
    found, holders = [], {}
    for doc, text in sorted(rows):
        for n, line in enumerate(text.split("\n")):
            own = plain_words(line)
            if own:
                found.append((doc, n, own))
                holders.setdefault(tuple(own), set()).add(doc)
    found = [f for f in found if len(f[2]) >= 5 or len(holders[tuple(f[2])]) >= short_documents]
    links = [(y, x) for x in range(len(found)) for y in range(x) if near_lines(found[x][2], found[y][2])]
    root = brute.components(range(len(found)), links)
    gone = {}
    for i, (doc, n, _) in enumerate(found):
        if root[i] != i:
            gone.setdefault(doc, set()).add(n)
    return gone, sum(1 for a, b in links if found[a][2] != found[b][2])


@pytest.mark.parametrize("leaders", [8, 1])
def test_fuzzy_lines(docs, monkeypatch, leaders):
    monkeypatch.setattr("tallyboard.llm.links.LEADERS", leaders)
    rows = line_corpus()
    want, fuzzy = brute_lines(rows)
    assert fuzzy > 20
    assert any(len(plain_words(dict(rows)[d].split("\n")[n])) < 5 for d, own in want.items() for n in own)
    got = {r.doc_id: set(r.lines) for r in lines.repeated_lines(docs(rows)).collect()}
    assert got == want
    texts = dict(rows)
    for r in lines.without_repeated_lines(docs(rows)).collect():
        kept = [x for n, x in enumerate(texts[r.doc_id].split("\n")) if n not in want.get(r.doc_id, ())]
        assert r.text == "\n".join(kept) and r.lines_removed == len(want.get(r.doc_id, ()))


def test_lines_that_differ_in_a_figure_are_different(docs):
    filler = " ".join(f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    texts = [
        "total 10 20 30 40 50", "total 11 22 33 44 55", "Order 2019 paid on 12 May", "Order 2024 paid on 31 May",
        f"{filler} in 1987 alone", f"{filler} in 1988 alone", f"{filler} in 1987 again", f"{filler} for 1,000 EUR", f"{filler} for 1.000 EUR",
        "if a != b then return c", "if a == b then return c", "Total  10 20 30 40\t50",
    ]
    rows = list(enumerate(texts))
    want, _ = brute_lines(rows)
    assert want == {6: {0}, 11: {0}}  # one word of 29 edited; equal but for case and spaces
    assert {r.doc_id: set(r.lines) for r in lines.repeated_lines(docs(rows)).collect()} == want


def test_short_lines_go_where_many_documents_hold_them(docs):
    rows = [(i, f"Read more\nonly {i}\nRead more\n\n") for i in range(6)] + [(9, "read MORE\nRead\nRead\nRead\nRead\nRead\nRead")]
    for least in (7, 8):
        got = {r.doc_id: set(r.lines) for r in lines.repeated_lines(docs(rows), short_documents=least).collect()}
        assert got == brute_lines(rows, least)[0]
        assert bool(got) == (least == 7)


def test_words_that_one_line_lacks():
    draw = random.Random(6)
    sides = [[np.array([draw.randint(0, 6) << 30 for _ in range(draw.randint(0, 9))], np.uint64) for _ in range(200)] for _ in range(2)]
    most = np.array([draw.randint(0, 4) for _ in range(200)])
    got = lines.may_be_near(*sides, most)
    for x, y, n, may in zip(*(side for side in sides), most, got):
        a, b = collections.Counter(x.tolist()), collections.Counter(y.tolist())
        assert may == (max((a - b).total(), (b - a).total()) <= n)
        near = brute.edits(x.tolist(), y.tolist()) <= n
        assert may or not near
        assert lines.near_lines(x, y, int(n)) == near
    assert lines.may_be_near([], [], np.array([], int)).tolist() == []


def test_very_long_lines(docs):
    draw = random.Random(2)
    own = [f"v{draw.randint(0, 5000)}x" for _ in range(30_000)]
    words = [w.replace("v", "").translate(str.maketrans("0123456789", "abcdefghij")) for w in own]
    near = list(words)
    for at in draw.sample(range(len(words)), 40):
        near[at] = "other"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(reversed(words)))]
    assert {r.doc_id: set(r.lines) for r in lines.repeated_lines(docs(rows)).collect()} == {2: {0}}


def test_fuzzy_lines_of_odd_rows(docs):
    line = "one two three four five six"
    rows = [*ODD, (30, line), (30, line), (31, line.upper() + " \nnext"), (None, None)]
    clashing = ["gone_lines", "gone_id", "gone", "row", "document", "text_key", "line", "lines", "node", "label", "high", "a.b`c"]
    extra = "".join(f", `{c.replace('`', '``')}` string" for c in clashing)
    table = docs([(d, t, 1, *clashing) for d, t in rows], ", lines_removed int" + extra)
    got = lines.without_repeated_lines(table)
    assert got.columns == ["doc_id", "text", *clashing, "lines_removed"]
    assert all([r[c] for c in clashing] == clashing for r in got.collect())
    by = sorted((r.doc_id or -1, r.text or "", r.lines_removed) for r in got.collect())
    assert len(by) == len(rows)
    assert [x for x in by if x[0] >= 30] == [(30, line, 0), (30, line, 0), (31, "next", 1)]
    assert lines.without_repeated_lines(docs([])).count() == 0


def test_near_equal_lines_are_all_found(docs):
    """Against edit similarity alone."""
    draw = random.Random(12)
    vocabulary = ["".join(draw.choice("abcdefghijklm") for _ in range(3)) for _ in range(400)]
    rows = []
    for _ in range(60):
        own = [draw.choice(vocabulary[: draw.choice((3, 400))]) for _ in range(draw.choice((9, 10, 19, 20, 30, 100)))]
        rows.append(" ".join(own))
        most = len(own) // 10
        for _ in range(draw.randint(0, most)):
            at = draw.randrange(len(own))
            own[at : at + draw.randint(0, 1)] = [draw.choice(vocabulary)] * draw.randint(0, 1)
        rows.append(" ".join(own))
    rows = list(enumerate(rows))
    links = []
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        a, b = a.split(), b.split()
        if brute.edits(a, b) <= max(len(a), len(b)) // 10:
            links.append((i, j))
    root = brute.components(range(len(rows)), links)
    assert 40 < len({i for i in root if root[i] != i})
    assert {r.doc_id for r in lines.repeated_lines(docs(rows)).collect()} == {i for i in root if root[i] != i}
