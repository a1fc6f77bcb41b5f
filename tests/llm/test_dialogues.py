"""The trie of conversations against a plain version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tallyboard.llm import dialogues

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, borrowed=9, sharing=5):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in said.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % borrowed
        lender = c - (abs(c) % sharing) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(lender, [])[:h] + own[c][h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p])
            + (hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),)
            for p, m in members.items()
        ),
        key=str,
    )


def talks(seed, count=400):
    """Conversations that share first turns, copies, and a hot first turn."""
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-30, 3 * count), count):
        length, copy = draw.randint(1, 9), conv % 3 == 0
        for turn in range(length if not copy else 4):
            text = f"same {turn}" if copy else "hot" if turn == 0 and conv % 2 else draw.choice(["é", "a", "bb", f"{draw.random()}"])
            rows.append((conv, turn, "user" if turn % 2 else "assistant", text))
    draw.shuffle(rows)
    return rows


def found(spark, rows, schema=SCHEMA, **options):
    table = spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in dialogues.conversation_trie(table, **options).collect()), key=str)


@pytest.mark.parametrize("seed, partitions, depth", [(1, 1, 64), (2, 9, 64), (3, 9, 2), (4, 12, 0)])
def test_every_node(spark, monkeypatch, seed, partitions, depth):
    monkeypatch.setattr(dialogues, "SPLITTER_TURNS", depth)
    monkeypatch.setattr(dialogues, "SAMPLES", 4)
    rows = talks(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert found(spark, rows) == brute(rows)
        assert found(spark, rows, borrowed=3, sharing=2, shard_rows=10) == brute(rows, 3, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("pieces", [1, 7])
def test_nodes_across_shards(monkeypatch, pieces):
    """The scan of shards and the reduction, without Spark."""
    monkeypatch.setattr(dialogues, "PIECE_IDS", pieces)
    draw = random.Random(pieces)
    step = lambda t: hashlib.sha256(t.encode()).digest()[: dialogues.STEP]
    rows = []
    for conv in range(300):
        turns = ["a", "b", "c"][: draw.randint(0, 3)] + [draw.choice("xyz") for _ in range(draw.randint(0, 2))] if conv % 3 else ["a", "b"]
        rows.append((b"".join(map(step, turns)), conv, [len(t) for t in turns]))
    rows.sort()

    def figures(cuts):
        nodes = dialogues.skeleton_of(cuts)
        known = {s: k for k, s in enumerate(nodes)}
        shards = defaultdict(list)
        for row in rows:
            shards[sum(c <= row[:2] for c in cuts)].append(row)
        out = [r for shard in shards.values() for r in dialogues.scanned(shard, known)]
        parts, texts = {}, defaultdict(list)
        for kind, conv, depth, _, n, children, leaves, saved, _, skeleton, size, ids in out:
            if kind == dialogues.PART:
                p = parts.setdefault(skeleton, dict(conv_id=conv, depth=depth, n_convs=0, n_children=0, n_leaves=0, saved_tokens=0, last_bytes=size))
                p["conv_id"] = min(p["conv_id"], conv)
                for name, value in zip(("n_convs", "n_children", "n_leaves", "saved_tokens"), (n, children, leaves, saved)):
                    p[name] += value
            elif kind == dialogues.PIECE:
                texts[skeleton].append((conv, ids))
        ends = {k: hashlib.sha256(b",".join(x for _, x in sorted(v))).hexdigest() for k, v in texts.items()}
        upper = dialogues.carried_up(nodes, parts, ends)
        lower = [(*r[1:3], r[3] if r[3] is not None else parts[r[9]]["conv_id"], *r[4:9]) for r in out if r[0] == dialogues.NODE]
        return sorted([*lower, *(r[1:] for r in upper)], key=str)

    whole = figures([])
    for count in (1, 5, 40):
        assert figures(sorted({rows[draw.randrange(300)][:2] for _ in range(count)})) == whole


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (5, None, None, None), (5, 2, "user", ""), (5, 2, "user", ""), (6, 2, "", "x"), (6, 2, "x", ""),
        (-7, 0, "user", "é"), (-5, 0, "user", "lent"), (12, 3, None, "only"),
    ]
    wide = [(*r, 1, "x", 2) for r in rows]
    assert found(spark, wide, SCHEMA + ", depth int, path string, bytes int") == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    # every turn is borrowed from a conversation that is not there
    gone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    none = hashlib.sha256(str(gone).encode()).hexdigest()
    assert found(spark, [(gone, 0, "user", "x")]) == [(gone, 0, None, 1, 0, 1, 0, none)]


def test_long_conversations_and_texts(spark):
    rows = [(c, t, "user", f"{t}") for c in (10, 15) for t in range(200)] + [(10, 200, "user", "y" * 3_000_000)]
    assert found(spark, rows) == brute(rows)
