"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def repeated(rows, window):
    """{doc_id: (words, removed, sha256 of what is kept)}."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        own = words(text)
        for i in range(len(own) - window + 1):
            first.setdefault(tuple(own[i : i + window]), (doc, i))
    for doc, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < (doc, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out[doc] = (len(own), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def shingle_set(text, size=5):
    own = [w.lower() for w in words(text)]
    if not own:
        return frozenset()
    if len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def near(rows):
    """{doc_id: (set size, component)}."""
    sets = {d: shingle_set(t) for d, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = components(sorted(sets), links)
    return {d: (len(sets[d]), found[d]) for d in sets}


def longest_repeats(own):
    """For each word, the longest run from there that occurs elsewhere."""
    out = []
    for a in range(len(own)):
        best = 0
        for b in range(len(own)):
            if a != b:
                n = 0
                while a + n < len(own) and b + n < len(own) and own[a + n] == own[b + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        following = [i + 1]
        for j, y in enumerate(b):
            following.append(min(row[j + 1] + 1, following[j] + 1, row[j] + (x != y)))
        row = following
    return row[-1]


def luhn(digits):
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = int(x)
        if i % 2:
            d = 2 * d - (9 if d > 4 else 0)
        total += d
    return total % 10 == 0
