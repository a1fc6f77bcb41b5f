"""Pairs of a key's members: leaders and those behind them, streamed in batches of any size."""

import numpy as np
import pyarrow as pa
import pytest

from tallyboard.llm import lines, links, near


def members(seed=5):
    random = np.random.default_rng(seed)
    sizes = random.integers(1, 14, 60).tolist() + [40, 1, 90, 2]
    random.shuffle(sizes)
    keys = np.repeat(np.arange(len(sizes)), sizes)
    return keys, np.arange(len(keys)) * 3, random.integers(0, 12, len(keys))


def alike(a, b):
    return abs(a["v"] - b["v"]) <= 1


@pytest.mark.parametrize("batch, bound", [(1, 256), (7, 256), (7, 20), (1000, 20), (3, 4), (1000, 1)])
@pytest.mark.parametrize("leaders", [1, 3])
def test_no_pair_of_a_key_is_lost(batch, bound, leaders):
    keys, nodes, values = members()
    table = [pa.RecordBatch.from_arrays([pa.array(x[i : i + batch]) for x in (keys, nodes, values)], names=["key", "node", "v"]) for i in range(0, len(keys), batch)]
    found = pa.Table.from_batches(links.meeting(iter(table), ["v"], alike, leaders, bound)).to_pylist()
    first = [(r["leader"], r["node"]) for r in found if r["leader"] is not None]
    behind = [(r["key"], r["node"]) for r in found if r["leader"] is None]
    assert len(set(first)) == len(first) and len(set(behind)) == len(behind)
    value, want_first, want_behind = dict(zip(nodes.tolist(), values.tolist())), set(), set()
    for key in set(keys.tolist()):
        own = nodes[keys == key].tolist()
        want_first |= {(a, b) for i, a in enumerate(own[:leaders]) for b in own[i + 1 :] if abs(value[a] - value[b]) <= 1}
        rest = own[leaders:]
        want_behind |= {(key, a) for a in rest if len(own) > bound or any(a != b and abs(value[a] - value[b]) <= 1 for b in rest)}
    assert set(first) == want_first
    assert set(behind) == want_behind


def test_postings_are_dealt_out_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr("tallyboard.llm.links.stored", lambda df, name: written.append(df) or df)
    postings = spark.createDataFrame([(k, n, 1) for k in range(5) for n in range(20)], "key long, node long, n int")
    assert links.paired(postings, lambda a, b: a["n"] == b["n"]).where("leader is null").count() == 5 * 12
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_classes_that_reach_no_other_are_not_paired(docs, spark, monkeypatch):
    monkeypatch.setattr("tallyboard.llm.links.LEADERS", 2)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(30):  # each far from the others: agreeing in coordinates, below the similarity
        own = list(base)
        for j in range(10, 200, 25):
            own[j] = f"x{i}y{j}"
        rows.append((i, " ".join(own)))
    asked, plain = [], near.confirmed

    def confirmed(pairs, sets, percent):
        asked.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(near, "confirmed", confirmed)
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs(rows)).collect()}
    assert got == {i: i for i in range(30)}
    assert len(asked) == 1  # behind the leaders nothing is left to confirm
    monkeypatch.setattr(near, "reaching", lambda members, foreign, percent: members)
    assert {r.doc_id: r.component_id for r in near.near_duplicates(docs(rows)).collect()} == got
    assert len(asked) == 3 and asked[2] > 0


def test_arrays_and_columns_tell_the_same_lines_apart(spark):
    random = np.random.default_rng(3)
    n, m = random.integers(10, 60, (2, 500))
    one = random.integers(-(2**63), 2**63, 500)
    two = one ^ np.bitwise_or.reduce(np.int64(1) << random.integers(0, 64, (4, 500)), 0)
    got = lines.may_be_close(90)({"n_words": n, "parity": one}, {"n_words": m, "parity": two})
    want = []
    for a, b, x, y in zip(n.tolist(), m.tolist(), one.tolist(), two.tolist()):
        edits, apart = max(a, b) // 10, bin((x ^ y) & (2**64 - 1)).count("1")
        want.append(apart <= 2 * edits - abs(a - b) and 100 * a >= 90 * b and 100 * b >= 90 * a)
    assert got.tolist() == want and any(want) and not all(want)
