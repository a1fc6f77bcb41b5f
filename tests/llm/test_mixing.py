import hashlib
import math

import duckdb
import pytest

from tallyboard.llm import mixing, oracle

from .conftest import SF


def taken(df):
    return df.select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_order").collect()


@pytest.fixture
def sources(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "big" if i % 10 else f"s{i % 30}") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def expected(rows, seed, budget, alpha):
    """Plain mixture: {(doc_id, epoch)}."""
    tokens, own = {}, {}
    for doc, text, source in rows:
        n = len(text.split()) + 1
        tokens[source] = tokens.get(source, 0) + n
        own.setdefault(source, []).append((doc, n))
    total = sum(tokens.values())
    z = sum((n / total) ** alpha for n in tokens.values())
    out = set()
    for source, n in tokens.items():
        weight = max(1, round(mixing.PARTS * (n / total) ** alpha / z))
        quota = weight * budget // mixing.PARTS
        for epoch in range(quota // n + 1):
            left = quota - epoch * n
            order = sorted(own[source], key=lambda x: hashlib.md5(f"{seed}|{epoch}|{x[0]}".encode()).hexdigest())
            at = 0
            for doc, size in order:
                if at < left:
                    out.add((doc, epoch))
                at += size
    return out


def test_a_mixture_follows_its_weights(sources):
    rows = [tuple(r) for r in sources.collect()]
    total = sum(len(t.split()) + 1 for _, t, _ in rows)
    got = taken(mixing.mixed_sources(sources, 2 * total, 0.9, None, seed="s"))
    tokens = {}
    for r in got:
        tokens[r.source] = tokens.get(r.source, 0) + r.mix_tokens
    shares = [n / sum(tokens.values()) for n in tokens.values()]
    entropy = -sum(p * math.log(p) for p in shares) / math.log(len(shares))
    assert entropy == pytest.approx(0.9, abs=0.01)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split()) + 1

    def share(alpha):
        z = sum((n / total) ** alpha for n in sizes.values())
        p = [(n / total) ** alpha / z for n in sizes.values()]
        return -sum(x * math.log(x) for x in p) / math.log(len(p))

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if share(mid) >= 0.9 else (low, mid)
    assert {(r.doc_id, r.mix_epoch) for r in got} == expected(rows, "s", 2 * total, low)


def test_blocks_of_any_size_give_the_same(sources, monkeypatch):
    one = {(r.doc_id, r.mix_epoch) for r in taken(mixing.mixed_sources(sources, None, 0.95))}
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 1)
    assert {(r.doc_id, r.mix_epoch) for r in taken(mixing.mixed_sources(sources, None, 0.95))} == one


def test_repeats_stay_under_the_limit(sources):
    got = taken(mixing.mixed_sources(sources, None, 1.0, 1.5))
    size, used = {}, {}
    for r in sources.collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split()) + 1
    for r in got:
        used[r.source] = used.get(r.source, 0) + r.mix_tokens
    assert max(used[s] / size[s] for s in used) <= 1.5 + 8 / min(size.values())


def test_a_covering_mixture_takes_every_document(sources):
    got = taken(mixing.mixed_sources(sources, None, 0.95, 2.0, cover=True))
    count = {}
    for r in got:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert set(count) == set(range(600)) and max(count.values()) == 2


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", "a"), (2, "x y", None), (2, "x y", None), (3, None, "b")]
    table = spark.createDataFrame([(*r, 9, "k") for r in rows], "doc_id long, text string, source string, mix_tokens int, weight string")
    got = mixing.mixed_sources(table, cover=True)
    assert got.count() >= 5 and got.columns == ["doc_id", "text", "source", "weight", "mix_tokens", "mix_epoch", "mix_order"]
    assert mixing.mixed_sources(table.limit(0)).count() == 0


def test_sql_agrees_on_a_mixture_that_moves_weight(spark, sources, monkeypatch, tmp_path):
    sources.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    sql = oracle.OP2.replace(f">= {oracle.ENTROPY_SHARE} *", ">= 0.9 *").replace(f"> {oracle.MOST_REPEATS} ", "> 3.0 ")
    want = sorted(con.execute(sql).fetchall())
    got = mixing.mixed_sources(sources, None, 0.9, 3.0, seed=oracle.MIX_SEED)
    assert sorted((r.doc_id, r.source, r.mix_tokens, r.mix_epoch, r.mix_order) for r in taken(got)) == want
