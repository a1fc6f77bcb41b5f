"""The queries against SQL, and the pipeline against plain versions of its stages."""

import importlib

import duckdb
import pytest

import __spark_entry__
from tallyboard.llm import oracle, queries

from . import brute
from .conftest import SF
from .test_packing import FILE
from .test_text import brute_lines


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(oracle.ORACLE_SQL[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, got.select(*names).collect())) == sorted(
        "Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, row)) + ")" for row in want.fetchall()
    )


def test_all_are_registered():
    found = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert set(__spark_entry__.oracle_sql()) <= set(found)


def test_pipeline(spark, small):
    pipeline = importlib.import_module("corpus_pipeline")
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    good = []
    for doc, text in rows:
        own = brute.words(text)
        runs = brute.longest_repeats(own) if len(own) < 700 else None
        if runs is None:  # the long ones by the operator itself, which the other tests hold against brute force
            kept = queries.repetition.repetition_rules(small.where(f"doc_id = {doc}")).first().kept
        else:
            eight = {x for a, n in enumerate(runs) if n >= 8 for x in range(a, a + 8)}
            five = {x for a, n in enumerate(runs) if n >= 5 for x in range(a, a + n)}
            kept = len(own) >= 20 and 100 * len(eight) <= 30 * len(own) and 100 * len(five) <= 30 * len(own) and max(runs) <= 60
        if kept:
            good.append((doc, text))
    docs = small
    stages = dict(pipeline.STAGES)
    docs = stages["quality_rules"](spark, docs, SF)
    assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == sorted(good)
    gone, _ = brute_lines(good)
    lined = [(d, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ()))) for d, t in good]
    docs = stages["line_dedup"](spark, docs, SF)
    assert docs.columns == small.columns
    got = docs.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(lined)
    assert all(r.n_chars == len(r.text) for r in got if gone.get(r.doc_id))
    groups = brute.near(lined)
    unique = {d for d, (n, c) in groups.items() if d == c}
    docs = stages["minhash_near_dedup"](spark, docs, SF)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(unique)
    mixed = stages["mix_sources"](spark, docs, SF)
    assert mixed.columns == small.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) == unique and max(times.values()) <= 2
    model = Tokenizer.from_file(FILE)
    packed = pipeline.run(spark, SF).collect()
    texts = dict(lined)
    total = {d: len(model.encode(texts[d], add_special_tokens=False).ids) + 1 for d in times}
    assert sum(r.length for r in packed) == sum(total[d] * n for d, n in times.items())
    once = [(d, texts[d]) for d, n in times.items() if n == 1]
    single = {d for d, _ in once}
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert all(sum(r.length for r in own) <= 4096 for own in by_sequence.values())
    pieces = {}
    for r in packed:
        if r.doc_id in single:
            pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for d, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == total[d]

