import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyboard.llm import bestfit, packing
from tallyboard.llm.tokens import WordTokenizer, vocabulary_file

from .conftest import ODD

FILE = vocabulary_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(FILE)


def ids_of(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, 2]


def test_word_memory_gives_the_tokenizers_ids(model):
    odd = ["Don't STOP!!", "a b c", "é ́x İstanbul ŞŞ", "<|endoftext|> x<|startoftext|>y", "12 345,6 ✓✓ 東京", "퟿\x1c\x85 z", "it's 's"]
    memory = WordTokenizer(FILE)
    for text, got in zip(odd, memory.ids([t.encode() for t in odd])):
        assert np.frombuffer(got, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_memory_that_overflows_changes_nothing(model, monkeypatch):
    monkeypatch.setattr("tallyboard.llm.tokens.REMEMBERED_WORDS", 1)
    memory = WordTokenizer(FILE)
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in memory.ids([b"one two", b"three"])] == [
            model.encode(t, add_special_tokens=False).ids for t in ("one two", "three")
        ]


def check_pieces(rows, model, texts, window):
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for doc, text in texts:
        ids = ids_of(model, text)
        at = 0
        for r in sorted(by_doc[doc, len(ids)], key=lambda r: r.start):
            assert r.start == at and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_sequence)


def test_every_id_lies_in_one_piece_and_little_is_padded(small, model):
    texts = [(r.doc_id, r.text) for r in small.collect()]
    rows = packing.pack(small).collect()
    sequences = check_pieces(rows, model, texts, 4096)
    total = sum(len(ids_of(model, t)) for _, t in texts)
    assert sequences <= 1.05 * total / 4096 + 1


def test_many_blocks(small, model):
    texts = [(r.doc_id, r.text) for r in small.collect()]
    rows = packing.pack(small, window=256, block_windows=8).collect()
    sequences = check_pieces(rows, model, texts, 256)
    assert sequences <= 1.15 * sum(r.length for r in rows) / 256


def test_windows_are_nearly_equal_and_their_count_rises_if_needed():
    draw = random.Random(5)
    lengths = np.array([draw.randint(1, 400) for _ in range(800)])
    loads = np.bincount(packing.differencing(lengths, 40), lengths)
    assert loads.max() - loads.min() <= 10
    three = np.array([60, 60, 60])  # 180 in two windows of 100 do not fit
    assert len(set(packing.packed(three, 100).tolist())) == 3


@pytest.mark.parametrize("fine", [False, True])
def test_cuts_lose_nothing(fine):
    for tokens in (1, 7, 4095, 4096, 4097, 50_000):
        assert sum(packing.cuts(tokens, 4096, fine)) == tokens and min(packing.cuts(tokens, 4096, fine)) > 0


def test_odd_rows_and_no_rows(docs, model):
    table = docs([(d, t, 1, "q") for d, t in ODD], ", sequence_id int, length string")
    rows = packing.pack(table).collect()
    assert sum(r.doc_tokens for r in rows) == sum(len(ids_of(model, t)) for _, t in ODD)
    assert len(rows) == len(ODD)
    assert packing.pack(docs([])).count() == 0
    assert bestfit.pack_ids(docs([])).count() == 0


def test_a_very_long_text(docs, model):
    text = " ".join(f"w{i}" for i in range(30_000))
    rows = packing.pack(docs([(1, text)])).collect()
    check_pieces(rows, model, [(1, text)], 4096)


def restored(rows, id_bytes=2):
    found = {}
    for r in rows:
        ids = np.frombuffer(r.ids, f"<u{id_bytes}")
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert not ids[r.n_tokens :].any()
        for i, (doc, start) in enumerate(zip(r.doc_ids, r.doc_starts)):
            found.setdefault(doc, {})[start] = ids[r.cu_seqlens[i] : r.cu_seqlens[i + 1]].tolist()
    return {d: sum((p[s] for s in sorted(p)), []) for d, p in found.items()}


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_matrices_hold_every_document_once(small, model, id_bytes):
    rows = bestfit.pack_ids(small, length=1024, id_bytes=id_bytes, block_sequences=16).collect()
    got = restored(rows, id_bytes)
    for r in small.collect():
        assert got[r.doc_id] == ids_of(model, r.text)
    assert {len(r.ids) for r in rows} == {1024 * id_bytes}


def test_best_fit_takes_the_fullest_that_fits():
    draw = random.Random(1)
    lengths = sorted((draw.randint(1, 100) for _ in range(500)), reverse=True)
    free, expected = [], []
    for n in lengths:
        fits = [(f, i) for i, f in enumerate(free) if f >= n]
        if fits:
            least = min(f for f, _ in fits)
            expected.append(least - n)
            free[next(i for f, i in fits if f == least)] -= n
        else:
            free.append(100 - n)
            expected.append(100 - n)
    at = bestfit.best_fit(lengths, 100)
    left, got = {}, []
    for n, i in zip(lengths, at):
        left[i] = left.get(i, 100) - n
        got.append(left[i])
    assert got == expected and len(left) == len(free)


def test_odd_rows_in_sequences(docs):
    rows = bestfit.pack_ids(docs([(d, t, 0) for d, t in ODD], ", ids int"), length=8).collect()
    assert sum(len(r.doc_ids) for r in rows) == len(ODD)


def test_written_sequences_and_matrices(small, tmp_path, spark):
    packed = bestfit.pack_ids(small, length=512)
    bestfit.write_sequences(packed, str(tmp_path / "ids"))
    back = spark.read.parquet(str(tmp_path / "ids"))
    rows = bestfit.matrices(back, length=512, rows=10).collect()
    assert sum(r.n_rows for r in rows) == back.count()
    assert all(len(r.matrix) == r.n_rows * 512 * 2 for r in rows)
